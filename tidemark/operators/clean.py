"""Outlier removal, bounded imputation and normalisation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.blocks import (
    CELL,
    DEFAULT_KEYS,
    attach,
    carry_back,
    halo,
    micros,
    null_safe_join,
)
from tidemark.operators.quantiles import exact_quantiles, quantile_columns


def present(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """Columns that exist; operators skip the others."""
    return [c for c in columns if c in df.columns]


def iqr_bounds(df: DataFrame, columns: Sequence[str], factor: float = 3.0, keys: Sequence[str] = ()) -> DataFrame:
    """Exact ``lower_<c>`` / ``upper_<c>`` fences, one row per group."""
    columns = present(df, columns)
    q = quantile_columns(exact_quantiles(df, columns, [0.25, 0.75], keys), columns, keys)
    out = [F.col(k) for k in keys]
    for c in columns:
        lo, hi = F.col(f"q_{c}")[0], F.col(f"q_{c}")[1]
        out.append((lo - factor * (hi - lo)).alias(f"lower_{c}"))
        out.append((hi + factor * (hi - lo)).alias(f"upper_{c}"))
    return q.select(*out)


def _outside(c: str) -> Column:
    return F.coalesce((F.col(c) < F.col(f"lower_{c}")) | (F.col(c) > F.col(f"upper_{c}")), F.lit(False))


def remove_outliers_iqr(
    df: DataFrame,
    columns: Sequence[str],
    factor: float = 3.0,
    *,
    keys: Sequence[str] = (),
    fit_on: DataFrame | None = None,
    flags: bool = False,
) -> DataFrame:
    """Values outside the fences become null; ``flags`` keeps a 0/1 column per variable.

    ``fit_on`` takes the fences from another table (for example the training rows).
    """
    columns = present(df, columns)
    joined = attach(df, iqr_bounds(fit_on if fit_on is not None else df, columns, factor, keys), keys)
    out = [
        F.when(~_outside(c), F.col(c)).alias(c) if c in columns else F.col(c) for c in df.columns
    ]
    if flags:
        out += [_outside(c).cast("int").alias(f"{c}_is_outlier") for c in columns]
    return joined.select(*out)


def iqr_report(
    df: DataFrame, columns: Sequence[str], factor: float = 3.0, *, keys: Sequence[str] = ()
) -> DataFrame:
    """``n_outliers``, share over all rows in percent, and the fences, per column."""
    columns = present(df, columns)
    bounds = iqr_bounds(df, columns, factor, keys)
    joined = attach(df.select(*keys, *columns), bounds, keys)
    counted = joined.groupBy(*keys).agg(
        F.count("*").alias("n"),
        *[F.count_if(_outside(c)).alias(f"n_{c}") for c in columns],
        *[F.first(f"lower_{c}").alias(f"lower_{c}") for c in columns],
        *[F.first(f"upper_{c}").alias(f"upper_{c}") for c in columns],
    )
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            F.col(f"n_{c}").alias("n_outliers"),
            (F.col(f"n_{c}") * 100.0 / F.col("n")).alias("pct_outliers"),
            F.col(f"lower_{c}").alias("lower"),
            F.col(f"upper_{c}").alias("upper"),
        )
        for c in columns
    ]
    return counted.select(*keys, F.inline(F.array(*rows)))


def flag_outliers(df: DataFrame, columns: Sequence[str], bounds: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """0/1 flags of the raw values against stored fences (see :func:`iqr_bounds`)."""
    columns = present(df, columns)
    joined = attach(df, bounds, keys)
    return joined.select(*df.columns, *[_outside(c).cast("int").alias(f"{c}_is_outlier") for c in columns])


def remove_outliers_zscore(
    df: DataFrame,
    columns: Sequence[str],
    threshold: float = 5.0,
    *,
    keys: Sequence[str] = (),
    fit_on: DataFrame | None = None,
) -> DataFrame:
    """Values more than ``threshold`` population deviations from the mean become null."""
    columns = present(df, columns)
    aggs = [F.avg(c).alias(f"m_{c}") for c in columns] + [F.stddev_pop(c).alias(f"s_{c}") for c in columns]
    stats = (fit_on if fit_on is not None else df).groupBy(*keys).agg(*aggs)
    joined = attach(df, stats, keys)

    def kept(c: str) -> Column:
        far = (F.col(f"s_{c}") > 0) & (F.abs(F.col(c) - F.col(f"m_{c}")) > threshold * F.col(f"s_{c}"))
        return F.when(~F.coalesce(far, F.lit(False)), F.col(c)).alias(c)

    return joined.select(*[kept(c) if c in columns else F.col(c) for c in df.columns])


def _fill(
    df: DataFrame,
    columns: Sequence[str],
    interp: int,
    ffill: int,
    bfill: int,
    keys: Sequence[str],
    ts: str,
    step: str | None,
    size: int | None,
    cell: str,
) -> DataFrame:
    """Interpolate, then fill forward, then fill backward, each with its own limit.

    Left neighbours are at most ``interp + ffill`` rows away (block halo).  The right
    neighbour of a gap can be any distance away, so each block learns the first value
    behind its end from a one-row-per-block scan.
    """
    keys = list(keys)
    before = interp + ffill
    b = halo(df, keys, ts, before=before, step=step, size=size, cell=cell)
    need_next = bool(interp or bfill)
    rows = b.df

    def known(c: str) -> Column:
        return F.when(
            F.col(c).isNotNull(),
            F.struct(F.col(b.pos).alias("p"), micros(ts).alias("t"), F.col(c).cast("double").alias("v")),
        )

    if need_next:
        # the summary needs each row once: rows in their home block
        home = rows.filter(b.home)
        edges = carry_back(home.drop("__blk"), keys, b.pos, b.size, 0, {f"__e_{c}": known(c) for c in columns})
        rows = null_safe_join(rows, edges, [*keys, "__blk"], "left")
    ahead = b.w_desc.rowsBetween(Window.unboundedPreceding, 0)
    for c in columns:
        if need_next:
            rows = rows.withColumn(f"__n_{c}", F.coalesce(F.last(known(c), True).over(ahead), F.col(f"__e_{c}")))
        if interp:
            rows = rows.withColumn(f"__p_{c}", F.last(known(c), True).over(b.frame(-interp, 0)))
    now = micros(ts)
    for c in columns:
        value = F.col(c).cast("double")
        if interp:
            p, n = F.col(f"__p_{c}"), F.col(f"__n_{c}")
            slope = (n["v"] - p["v"]) * ((now - p["t"]) / (n["t"] - p["t"]))
            value = F.when(F.col(c).isNotNull() | p.isNull(), value).when(n.isNull(), p["v"]).otherwise(p["v"] + slope)
        rows = rows.withColumn(f"__v_{c}", value)
    result = {}
    for c in columns:
        value = F.col(f"__v_{c}")
        if ffill:
            value = F.last(value, True).over(b.frame(-ffill, 0))
        if bfill:
            n = F.col(f"__n_{c}")
            value = F.coalesce(value, F.when(n["p"] - F.col(b.pos) <= bfill, n["v"]))
        result[c] = value
    for c in columns:
        rows = rows.withColumn(f"__f_{c}", result[c])
    done = b.close(rows)
    return done.select(*[F.col(f"__f_{c}").alias(c) if c in result else F.col(c) for c in df.columns])


def interpolate(df, columns, limit=6, *, keys=DEFAULT_KEYS, ts="ts", step=None, size=None, cell=CELL) -> DataFrame:
    """Time-weighted linear interpolation of the first ``limit`` nulls of every gap.

    A trailing gap repeats the last value (same limit); leading nulls stay.
    """
    return _fill(df, present(df, columns), limit, 0, 0, keys, ts, step, size, cell)


def forward_fill(df, columns, limit=24, *, keys=DEFAULT_KEYS, ts="ts", step=None, size=None, cell=CELL) -> DataFrame:
    """Repeat the last value for at most ``limit`` rows."""
    return _fill(df, present(df, columns), 0, limit, 0, keys, ts, step, size, cell)


def backward_fill(df, columns, limit=24, *, keys=DEFAULT_KEYS, ts="ts", step=None, size=None, cell=CELL) -> DataFrame:
    """Use the next value for at most ``limit`` rows before it."""
    return _fill(df, present(df, columns), 0, 0, limit, keys, ts, step, size, cell)


def impute(
    df, columns, max_interp=6, max_fill=24, *, keys=DEFAULT_KEYS, ts="ts", step=None, size=None, cell=CELL
) -> DataFrame:
    """Interpolate, forward fill, backward fill: all three limits in one shuffle."""
    return _fill(df, present(df, columns), max_interp, max_fill, max_fill, keys, ts, step, size, cell)


def null_report(df: DataFrame, columns: Sequence[str], *, keys: Sequence[str] = ()) -> DataFrame:
    """Remaining nulls per column in one aggregate."""
    counted = df.groupBy(*keys).agg(
        F.count("*").alias("n_rows"), *[F.count_if(F.col(c).isNull()).alias(f"k_{c}") for c in columns]
    )
    rows = [
        F.struct(
            F.lit(c).alias("column"), F.col(f"k_{c}").alias("n_null"),
            (F.col(f"k_{c}") * 100.0 / F.col("n_rows")).alias("pct_null"),
        )
        for c in columns
    ]
    return counted.select(*keys, F.inline(F.array(*rows)))


def normalization_stats(df: DataFrame, columns: Sequence[str], *, keys: Sequence[str] = ()) -> DataFrame:
    """Mean, sample deviation, minimum and maximum per column in one aggregate."""
    columns = present(df, columns)
    parts = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    wide = df.groupBy(*keys).agg(*[f(c).alias(f"{n}_{c}") for c in columns for n, f in parts.items()])
    rows = [
        F.struct(F.lit(c).alias("column"), *[F.col(f"{n}_{c}").cast("double").alias(n) for n in parts])
        for c in columns
    ]
    return wide.select(*keys, F.inline(F.array(*rows)))


def normalize(df: DataFrame, columns: Sequence[str], *, keys: Sequence[str] = ()) -> DataFrame:
    """Standardise columns with the statistics above (zero deviation leaves zeros)."""
    columns = present(df, columns)
    aggs = [f(c).alias(f"{n}_{c}") for c in columns for n, f in (("m", F.avg), ("s", F.stddev_samp))]
    joined = attach(df, df.groupBy(*keys).agg(*aggs), keys)

    def scaled(c: str) -> Column:
        centred = F.col(c) - F.col(f"m_{c}")
        return F.when(F.col(f"s_{c}") > 0, centred / F.col(f"s_{c}")).otherwise(centred).alias(c)

    return joined.select(*[scaled(c) if c in columns else F.col(c) for c in df.columns])
