"""Distribution drift between a reference and a current table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.blocks import DEFAULT_KEYS, attach, spread_join
from tidemark.operators.eda import bin_edges, bin_index
from tidemark.operators.quantiles import rank_in, to_long
from tidemark.operators.timeindex import tail_rows

PSI_LIMIT = 0.25
KS_ALPHA = 0.05
MIN_VALUES = 10
SHARE_LIMIT = 0.20
MAJORITY = 0.5
# Variables whose stability index is always reported.
PRIORITY = (
    "meteo_temperature_2m",
    "meteo_relative_humidity_2m",
    "meteo_wind_speed_10m",
    "meteo_precipitation",
)
DERIVED_MARKS = ("lag", "roll", "diff", "pct", "ewm")


def numeric_common(ref: DataFrame, cur: DataFrame) -> list[str]:
    """Numeric columns both tables have."""
    numbers = {f.name for f in cur.schema.fields if isinstance(f.dataType, T.NumericType)}
    return [f.name for f in ref.schema.fields if isinstance(f.dataType, T.NumericType) and f.name in numbers]


def monitored_columns(df: DataFrame, prefix: str = "meteo_") -> list[str]:
    """Base measurements: the prefix, without engineered columns."""
    return [c for c in df.columns if c.startswith(prefix) and not any(m in c for m in DERIVED_MARKS)]


def drift_windows(
    train: DataFrame, test: DataFrame | None, *, ref_days: int = 30, cur_days: int = 7,
    keys: Sequence[str] = DEFAULT_KEYS, ts: str = "ts",
) -> tuple[DataFrame, DataFrame]:
    """Last ``ref_days`` of training rows against the last ``cur_days`` of test rows."""
    reference = tail_rows(train, ref_days * 24, keys=keys, ts=ts)
    current = tail_rows(test if test is not None else train, cur_days * 24, keys=keys, ts=ts)
    return reference, current


def _sides(ref: DataFrame, cur: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, n_ref, n_cur): distinct values only, copies combined map-side."""
    tagged = (
        to_long(ref, (), columns).withColumn("r", F.lit(1))
        .unionByName(to_long(cur, (), columns).withColumn("r", F.lit(0)))
    )
    return tagged.groupBy("column", "value").agg(
        F.sum("r").alias("n_ref"), F.sum(1 - F.col("r")).alias("n_cur")
    )


def psi(ref: DataFrame, cur: DataFrame, columns: Sequence[str], bins: int = 10) -> DataFrame:
    """Population stability index per column over equal-width bins of the reference.

    The edges of all columns are one row that reaches the rows as a scalar, so the only
    shuffle is the one of the bin counts.  A column without values on a side keeps its row,
    with a null index.
    """
    columns = list(columns)
    ends = [f(F.col(c).cast("double")).alias(f"{n}{i}") for i, c in enumerate(columns) for f, n in ((F.min, "__lo"), (F.max, "__hi"))]
    side = lambda df, r: df.select(*[F.col(c).cast("double").alias(f"__v{i}") for i, c in enumerate(columns)], F.lit(r).alias("r"))
    rows = attach(side(ref, 1).unionByName(side(cur, 0)), ref.agg(*ends))
    cells = [F.struct(F.lit(c).alias("column"), F.col(f"__v{i}").alias("value"), F.col(f"__lo{i}").alias("l"), F.col(f"__hi{i}").alias("h")) for i, c in enumerate(columns)]
    lo, hi = bin_edges(F.col("l"), F.col("h"))
    counted = (
        rows.select("r", F.inline(F.array(*cells))).filter(F.col("value").isNotNull())
        .groupBy("column", bin_index(F.col("value"), lo, hi, bins).alias("bin"))
        .agg(F.sum("r").alias("r"), F.sum(1 - F.col("r")).alias("c"))
    )
    every = ref.sparkSession.range(1).select(F.explode(F.array(*[F.lit(c) for c in columns])).alias("column"))
    counted = every.join(counted, "column", "left").withColumns({c: F.coalesce(c, F.lit(0)) for c in ("r", "c")})
    return psi_from_counts(counted, ["column"])


def psi_from_counts(counted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """PSI from per-bin counts ``r`` (reference) and ``c`` (current)."""
    w = Window.partitionBy(*keys)  # at most one row per bin
    shares = counted.withColumn("n_ref", F.sum("r").over(w)).withColumn("n_cur", F.sum("c").over(w))

    def share(k: str, n: str) -> Column:
        value = F.col(k) / (F.col(n) + F.lit(1e-10))
        return F.when(F.col(k) == 0, 1e-6).otherwise(value)

    a, b = share("r", "n_ref"), share("c", "n_cur")
    term = F.when((F.col("n_ref") > 0) & (F.col("n_cur") > 0), (b - a) * F.log(b / a))
    return shares.groupBy(*keys, "n_ref", "n_cur").agg(F.sum(term).alias("psi"))


def ks_pvalue(d: Column, n: Column, m: Column) -> Column:
    """Asymptotic two-sided p-value of the two-sample Kolmogorov-Smirnov statistic."""
    t2 = d * d * (n * m / (n + m))
    series = F.lit(0.0)
    for k in range(1, 21):
        series = series + F.lit(2.0 if k % 2 else -2.0) * F.exp(F.lit(-2.0 * k * k) * t2)
    return F.when(t2 < 0.04, 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), series)))


def ks(ref: DataFrame, cur: DataFrame, columns: Sequence[str], splits: int = 64, cell: int = 50_000) -> DataFrame:
    """Two-sample KS statistic and asymptotic p-value per column.

    Distinct values are cut into value ranges by approximate quantiles, and each range into
    slices by its own number of distinct values (about ``cell`` each); the counts of the
    lower slices are carried in, so no task sorts more than one slice of one column.
    """
    both = _sides(ref, cur, columns)
    cuts = both.groupBy("column").agg(
        F.sort_array(
            F.array_distinct(F.percentile_approx("value", [i / splits for i in range(1, splits)], 2_000))
        ).alias("cuts"),
        F.sum("n_ref").alias("t_ref"),
        F.sum("n_cur").alias("t_cur"),
    )
    # beyond the distinct cuts the array has no entry, which ends the search
    ranged = rank_in(spread_join(both, cuts, ["column"]), "part", "value", "cuts", splits, inclusive=False).drop("cuts")
    ranged = ranged.filter((F.col("t_ref") > 0) & (F.col("t_cur") > 0))
    ends = ranged.groupBy("column", "part").agg(F.min("value").alias("lo"), F.max("value").alias("hi"), F.count("*").alias("k"))
    slices = F.ceil(F.col("k") / F.lit(cell))
    place = F.floor((F.col("value") - F.col("lo")) / (F.col("hi") - F.col("lo")) * slices)
    sliced = spread_join(ranged, ends, ["column", "part"], salts=4).withColumn(
        "slice", F.when(F.col("hi") > F.col("lo"), F.least(place, slices - 1)).otherwise(0)
    )
    group = ["column", "part", "slice"]
    sizes = sliced.groupBy(*group).agg(F.sum("n_ref").alias("p_ref"), F.sum("n_cur").alias("p_cur"))
    earlier = Window.partitionBy("column").orderBy("part", "slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        *group,
        F.coalesce(F.sum("p_ref").over(earlier), F.lit(0)).alias("o_ref"),
        F.coalesce(F.sum("p_cur").over(earlier), F.lit(0)).alias("o_cur"),
    )
    inside = Window.partitionBy(*group).orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    below_ref = F.col("o_ref") + F.sum("n_ref").over(inside)
    below_cur = F.col("o_cur") + F.sum("n_cur").over(inside)
    gap = F.abs(below_ref / F.col("t_ref") - below_cur / F.col("t_cur"))
    stats = (
        sliced.join(offsets, group)
        .select("column", "t_ref", "t_cur", gap.alias("gap"))
        .groupBy("column", "t_ref", "t_cur")
        .agg(F.max("gap").alias("ks_stat"))
    )
    return stats.select(
        "column", "ks_stat", ks_pvalue(F.col("ks_stat"), F.col("t_ref"), F.col("t_cur")).alias("ks_pvalue")
    )


def column_drift(
    ref: DataFrame, cur: DataFrame, columns: Sequence[str] | None = None
) -> DataFrame:
    """KS and PSI per common numeric column; drifted when KS p < 0.05 or PSI > 0.25.

    Columns with fewer than ten values on a side are never drifted but keep their row.
    """
    columns = list(columns or numeric_common(ref, cur))
    joined = psi(ref, cur, columns).join(ks(ref, cur, columns), "column", "left")
    enough = (F.col("n_ref") >= MIN_VALUES) & (F.col("n_cur") >= MIN_VALUES)
    moved = (F.col("ks_pvalue") < KS_ALPHA) | (F.col("psi") > PSI_LIMIT)
    return joined.select(
        "column", "n_ref", "n_cur", "psi", "ks_stat", "ks_pvalue",
        F.coalesce(enough & moved, F.lit(False)).alias("drifted"),
    )


def drift_summary(per_column: DataFrame, n_total: int, threshold: float = SHARE_LIMIT) -> DataFrame:
    """Dataset row: drifted count and share over all common columns, flags and action.

    ``dataset_drift`` and the action follow ``threshold``, ``majority_drift`` a share of over one half.
    """
    share = F.count_if("drifted") / F.lit(n_total)
    return per_column.agg(F.count_if("drifted").alias("n_drifted"), share.alias("share_drifted")).select(
        "n_drifted",
        F.lit(n_total).cast("bigint").alias("n_total"),
        "share_drifted",
        (F.col("share_drifted") > threshold).alias("dataset_drift"),
        (F.col("share_drifted") > MAJORITY).alias("majority_drift"),
        F.when(F.col("share_drifted") > threshold, "RETRAIN").otherwise("MONITOR").alias("action_required"),
    )


def priority_psi(ref: DataFrame, cur: DataFrame, priority: Sequence[str] = PRIORITY) -> DataFrame:
    """Stability index of the priority columns, or of all common columns when none exists."""
    common = numeric_common(ref, cur)
    chosen = [c for c in priority if c in common] or common
    return psi(ref, cur, chosen)


def quality_report(ref: DataFrame, cur: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null share and basic statistics per column for both sides."""

    def side(df: DataFrame, name: str) -> DataFrame:
        aggs = [F.count("*").alias("n")]
        for c in columns:
            aggs += [
                F.avg(F.col(c).isNull().cast("int")).alias(f"u_{c}"), F.avg(c).alias(f"m_{c}"),
                F.stddev_samp(c).alias(f"s_{c}"), F.min(c).alias(f"l_{c}"), F.max(c).alias(f"h_{c}"),
            ]
        rows = [
            F.struct(
                F.lit(name).alias("side"), F.lit(c).alias("column"), F.col("n").alias("n_rows"),
                F.col(f"u_{c}").alias("null_share"), F.col(f"m_{c}").alias("mean"),
                F.col(f"s_{c}").alias("std"), F.col(f"l_{c}").cast("double").alias("min"),
                F.col(f"h_{c}").cast("double").alias("max"),
            )
            for c in columns
        ]
        return df.agg(*aggs).select(F.inline(F.array(*rows)))

    return side(ref, "reference").unionByName(side(cur, "current"))
