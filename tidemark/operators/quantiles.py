"""Exact quantiles of groups that do not fit one task.

The built-in exact ``percentile`` aggregate keeps every distinct value of a group in one
buffer.  Here a mergeable sketch first brackets each wanted rank; one further pass
counts the values below the bracket and keeps only the distinct values inside it (about
0.2 % of the rows at the default accuracy).  The answer is exact and interpolates
linearly between neighbours, like numpy and SQL ``percentile_cont``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.blocks import spread_join

ACCURACY = 10_000
# Bracket half-widths: the first whose width covers at least three ranks is used, so the
# sketch error (n / ACCURACY + 1 ranks) always fits; tiny groups are taken whole.
MARGINS = (5.0 / ACCURACY, 0.01)


def to_long(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """(keys, column, value) without the missing values."""
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns]
    return (
        df.select(*keys, F.explode(F.array(*pairs)).alias("__kv"))
        .select(*keys, "__kv.column", "__kv.value")
        .filter(F.col("value").isNotNull())
    )


def rank_in(df: DataFrame, name: str, value: str, ends: str, size: int, *, inclusive: bool) -> DataFrame:
    """Number of entries of a sorted array column below (or equal to) a value.

    A binary search written as one projection per halving, so it stays in generated code.
    """
    v, ends_col = F.col(value), F.col(ends)
    out = df.withColumn(name, F.lit(0))
    step = 1 << max(size.bit_length() - 1, 0)
    while step:
        probe = F.col(name) + step
        at = F.get(ends_col, probe - 1)
        low = (at <= v) if inclusive else (at < v)
        out = out.withColumn(name, F.when((probe <= size) & F.coalesce(low, F.lit(False)), probe).otherwise(F.col(name)))
        step >>= 1
    return out


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], keys: Sequence[str] = ()
) -> DataFrame:
    """One row per (keys, column) with ``n`` and the array ``q`` in the order of ``probs``."""
    keys = list(keys)
    group = [*keys, "column"]
    order = sorted(range(len(probs)), key=lambda k: probs[k])
    ps = [float(probs[k]) for k in order]
    clip = lambda p: min(max(p, 0.0), 1.0)
    wanted = sorted({clip(p + s * m) for p in ps for m in MARGINS for s in (-1, 1)})

    def bound(sign: int, open_end: float):
        """Array of bracket ends, one per probability."""
        choice = F.lit([open_end] * len(ps))
        for m in reversed(MARGINS):
            at = [wanted.index(clip(p + sign * m)) for p in ps]
            free = [not 0.0 < p + sign * m < 1.0 for p in ps]
            ends = F.transform(
                F.sequence(F.lit(0), F.lit(len(ps) - 1)),
                lambda k: F.when(F.lit(free)[k], F.lit(open_end)).otherwise(F.col("__s")[F.lit(at)[k]]),
            )
            choice = F.when(F.col("n") * m >= 3, ends).otherwise(choice)
        return choice

    long = to_long(df, keys, columns)
    brackets = (
        long.groupBy(*group)
        .agg(F.count("value").alias("n"), F.percentile_approx("value", wanted, ACCURACY).alias("__s"))
        .select(*group, "n", bound(-1, float("-inf")).alias("lo"), bound(1, float("inf")).alias("hi"))
    )
    # every row is counted once at the first bracket it lies below (k = j) and repeated
    # with its value only for the few brackets that contain it (k < j)
    k = F.col("i")
    every = F.sequence(F.lit(0), F.lit(len(ps) - 1))
    placed = rank_in(spread_join(long, brackets, group), "__j", "value", "lo", len(ps), inclusive=True)
    placed = rank_in(placed, "__h", "value", "hi", len(ps), inclusive=False)
    counted = (
        placed.select(*group, "n", "value", "__j", F.explode(F.sequence(F.least("__h", "__j"), F.col("__j"))).alias("i"))
        .select(*group, "n", "i", F.when(k < F.col("__j"), F.col("value")).alias("v"))
        .groupBy(*group, "n", "i", "v")
        .agg(F.count("*").alias("c"))
        # the counts below apply to their own and every higher bracket
        .withColumn("i", F.explode(F.when(F.col("v").isNotNull(), F.array("i")).otherwise(F.filter(every, lambda x: x >= k))))
    )
    w = Window.partitionBy(*group, "i").orderBy(F.col("v").asc_nulls_first())
    p = F.lit(ps)[F.col("i")]
    rank = F.floor(p * (F.col("n") - 1)) + 1
    frac = p * (F.col("n") - 1) - (rank - 1)
    ranked = counted.withColumn("cum", F.sum("c").over(w.rangeBetween(Window.unboundedPreceding, 0)))
    picked = ranked.groupBy(*group, "i", "n", frac.alias("frac")).agg(
        F.min(F.when(F.col("cum") >= rank, F.col("v"))).alias("a"),
        F.min(F.when(F.col("cum") >= rank + 1, F.col("v"))).alias("b"),
    )
    lower = F.when(F.col("a").isNotNull(), F.col("a")).otherwise(
        F.raise_error(F.lit("quantile rank outside its bracket")).cast("double")
    )
    value = lower + F.when(F.col("frac") > 0, F.col("frac") * (F.col("b") - F.col("a"))).otherwise(0.0)
    asked = F.lit([order.index(k) for k in range(len(probs))])
    out = picked.groupBy(*group, "n").agg(
        F.array_sort(F.collect_list(F.struct("i", value.alias("v")))).alias("__q")
    )
    return out.select(*group, "n", F.transform(asked, lambda k: F.col("__q.v")[k]).alias("q"))


def quantile_columns(stats: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Spread :func:`exact_quantiles` output to one row with ``q_<column>`` arrays."""
    aggs: list[Column] = [
        F.max(F.when(F.col("column") == c, F.col("q"))).alias(f"q_{c}") for c in columns
    ]
    return stats.groupBy(*keys).agg(*aggs)
