"""Grouped profiles and distribution summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.calendar import cyclic_columns
from tidemark.operators.blocks import attach, micros, null_safe_join, spread_join
from tidemark.operators.quantiles import exact_quantiles, quantile_columns, to_long
from tidemark.operators.timeindex import downsample, head_rows


def mean_profile(df: DataFrame, part: str, columns: Sequence[str], *, ts: str = "ts", keys: Sequence[str] = ()):
    """Mean by hour of day or month of year."""
    unit = {"hour": F.hour, "month": F.month}[part](ts)
    return df.groupBy(*keys, unit.alias(part)).agg(*[F.avg(c).alias(f"mean_{c}") for c in columns])


def bin_edges(low: Column, high: Column) -> tuple[Column, Column]:
    """Histogram range; a constant column is widened by one half on both sides."""
    flat = low == high
    return F.when(flat, low - 0.5).otherwise(low), F.when(flat, high + 0.5).otherwise(high)


def bin_index(value: Column, low: Column, high: Column, bins: int) -> Column:
    """0-based equal-width bin; values outside the range fall in the outer bins."""
    raw = F.floor((value - low) / (high - low) * F.lit(float(bins)))
    return F.least(F.lit(bins - 1).cast("bigint"), F.greatest(F.lit(0).cast("bigint"), raw))


def histogram(df: DataFrame, column: str, bins: int, *, keys: Sequence[str] = ()) -> DataFrame:
    """Counts of ``bins`` equal-width bins per group, empty bins included."""
    keys = list(keys)
    lo, hi = bin_edges(F.min(column).cast("double"), F.max(column).cast("double"))
    bounds = df.groupBy(*keys).agg(lo.alias("__lo"), hi.alias("__hi"))
    values = attach(df.filter(F.col(column).isNotNull()).select(*keys, column), bounds, keys)
    counted = values.groupBy(*keys, bin_index(F.col(column), F.col("__lo"), F.col("__hi"), bins).alias("bin")).agg(
        F.count("*").alias("n")
    )
    width = (F.col("__hi") - F.col("__lo")) / bins
    frame = bounds.filter(F.col("__lo").isNotNull()).select(
        *keys, "__lo", "__hi", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(bins - 1).cast("bigint"))).alias("bin")
    )
    return null_safe_join(frame, counted, [*keys, "bin"], "left").select(
        *keys,
        "bin",
        (F.col("__lo") + F.col("bin") * width).alias("bin_low"),
        (F.col("__lo") + (F.col("bin") + 1) * width).alias("bin_high"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def box_summary(df: DataFrame, columns: Sequence[str], *, keys: Sequence[str] = ()) -> DataFrame:
    """Quartiles and whiskers (extremes within 1.5 IQR of the quartiles) per column."""
    group = [*keys, "column"]
    q = exact_quantiles(df, columns, [0.25, 0.5, 0.75], keys).select(
        *group, F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3")
    )
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    inside = F.col("value").between(F.col("q1") - reach, F.col("q3") + reach)
    return (
        spread_join(to_long(df, keys, columns), q, group)
        .groupBy(*group, "q1", "median", "q3")
        .agg(
            F.min("value").alias("min"),
            F.max("value").alias("max"),
            F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
        )
    )


def correlation_matrix(df: DataFrame, columns: Sequence[str], *, keys: Sequence[str] = ()) -> DataFrame:
    """Pearson correlation of every ordered pair in one aggregate, pairwise non-null."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    wide = df.groupBy(*keys).agg(*[F.corr(a, b).alias(f"{i}") for i, (a, b) in enumerate(pairs)])
    rows = []
    for i, (a, b) in enumerate(pairs):
        for x, y in {(a, b), (b, a)}:
            rows.append(F.struct(F.lit(x).alias("column_a"), F.lit(y).alias("column_b"), F.col(f"{i}").alias("corr")))
    return wide.select(*keys, F.inline(F.array(*rows)))


def daily_correlation(df: DataFrame, target: str, others: Sequence[str], *, ts: str = "ts") -> DataFrame:
    """Correlation of daily means with the target's, highest first."""
    daily = downsample(df, "1 day", {c: F.avg(c) for c in [target, *others]}, keys=(), ts=ts)
    wide = daily.agg(*[F.corr(target, c).alias(c) for c in others])
    rows = [F.struct(F.lit(c).alias("column"), F.col(c).alias("corr")) for c in others]
    return wide.select(F.inline(F.array(*rows))).orderBy(F.col("corr").desc())


def encoding_check(df: DataFrame, part: str = "hour", *, ts: str = "ts") -> DataFrame:
    """Mean sine and cosine encoding per hour or month."""
    unit = {"hour": F.hour, "month": F.month}[part](ts)
    coded = df.select(unit.alias(part), *cyclic_columns(ts))
    return coded.groupBy(part).agg(
        F.avg(f"{part}_sin").alias("mean_sin"), F.avg(f"{part}_cos").alias("mean_cos"), F.count("*").alias("n")
    )


def null_share(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    columns = list(columns or df.columns)
    wide = df.agg(*[F.avg(F.col(c).isNull().cast("int")).alias(c) for c in columns])
    rows = [F.struct(F.lit(c).alias("column"), F.col(c).alias("null_share")) for c in columns]
    return wide.select(F.inline(F.array(*rows)))


def profile(df: DataFrame, *, ts: str = "ts", tie: Sequence[str] = (), sparse: float = 0.10) -> DataFrame:
    """One row: shape, time bounds, step of the first 100 rows, worst null share, types.

    One aggregate over the table plus a top-100 read for the usual step.
    """
    columns = df.columns
    types: dict[str, int] = {}
    for field in df.schema.fields:
        kind = field.dataType.simpleString()
        types[kind] = types.get(kind, 0) + 1
    shares = F.array(*[F.avg(F.col(c).isNull().cast("int")) for c in columns])
    first = head_rows(df.select(ts, *tie), 100, keys=(), ts=ts, tie=tie)
    w = Window.partitionBy().orderBy(ts, *tie)  # at most 100 rows
    step = first.select(((micros(ts) - F.lag(micros(ts)).over(w)) / 1e6).alias("d")).agg(
        F.mode("d", deterministic=True).alias("d")
    )
    out = df.agg(
        F.count("*").alias("n_rows"),
        F.lit(len(columns)).alias("n_columns"),
        F.min(ts).alias("ts_min"),
        F.max(ts).alias("ts_max"),
        F.array_max(shares).alias("max_null_share"),
        F.size(F.filter(shares, lambda s: s > sparse)).alias("n_sparse_columns"),
    )
    kinds = ",".join(f"{k}:{types[k]}" for k in sorted(types))
    return out.withColumn("column_types", F.lit(kinds)).withColumn("step_seconds", step.scalar())


def top_importance(names: Sequence[str], model: DataFrame, n: int = 20) -> DataFrame:
    """Largest entries of an ``importances`` array column, descending."""
    named = F.array(*[F.lit(x) for x in names])
    pairs = model.select(F.posexplode("importances").alias("i", "importance"))
    return pairs.select(named[F.col("i")].alias("feature"), "importance").orderBy(
        F.col("importance").desc(), "feature"
    ).limit(n)
