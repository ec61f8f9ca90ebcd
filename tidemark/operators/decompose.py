"""Seasonal decompositions and their strength."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.blocks import CELL, DEFAULT_KEYS, attach, halo, null_safe_join, with_position
from tidemark.session import cut


def decompose(
    df: DataFrame, column: str, period: int = 24, *, keys: Sequence[str] = DEFAULT_KEYS, ts: str = "ts",
    size: int | None = None, cell: str | None = CELL,
) -> DataFrame:
    """Classical additive parts: centred moving average, period means, remainder."""
    keys = list(keys)
    half = period // 2
    rows = with_position(df.select(*keys, ts, column), keys, ts, cell=cell, name="__pos")
    b = halo(rows, keys, ts, pos="__pos", before=half, after=half, size=size)
    frame = b.frame(-half, half)
    total = F.sum(column).over(frame)
    if period % 2 == 0:
        total = total - 0.5 * (F.lag(column, half).over(b.w) + F.lead(column, half).over(b.w))
    full = F.count(column).over(frame) == 2 * half + 1
    level = F.when(full, total / F.lit(float(period)))
    trended = b.close(b.df.withColumn("trend", level)).withColumn("__phase", F.col("__pos") % period)
    phases = trended.groupBy(*keys, "__phase").agg(F.avg(F.col(column) - F.col("trend")).alias("__s"))
    grand = phases.groupBy(*keys).agg(F.avg("__s").alias("__g"))
    seasonal = attach(phases, grand, keys).select(*keys, "__phase", (F.col("__s") - F.col("__g")).alias("seasonal"))
    out = null_safe_join(trended, seasonal, [*keys, "__phase"], "left")
    return out.withColumn("resid", F.col(column) - F.col("trend") - F.col("seasonal")).select(
        *keys, ts, column, "trend", "seasonal", "resid"
    )


def strengths(parts: DataFrame, *, keys: Sequence[str] = DEFAULT_KEYS, strong: float = 0.6) -> DataFrame:
    """Seasonal and trend strength: ``max(0, 1 - Var(R) / Var(component + R))``."""
    rows = parts.dropna(subset=["trend", "seasonal", "resid"])
    left = F.var_samp("resid")

    def share(c: str):
        return F.greatest(F.lit(0.0), 1.0 - left / F.var_samp(F.col(c) + F.col("resid")))

    return rows.groupBy(*keys).agg(
        share("seasonal").alias("seasonal_strength"), share("trend").alias("trend_strength")
    ).withColumn("strong_seasonality", F.col("seasonal_strength") > strong).withColumn(
        "strong_trend", F.col("trend_strength") > strong
    )


# ------------------------------------------------------------------ robust STL

MEDIAN_RANKS = 50_000


def _odd(x: float) -> int:
    k = int(np.ceil(x))
    return k if k % 2 else k + 1


def _loess(y: np.ndarray, span: int, weights: np.ndarray, at: np.ndarray, total: int | None = None) -> np.ndarray:
    """Degree-one local regression of equally spaced values, evaluated at ``at``.

    ``total`` is the length of the whole sequence where ``y`` is a part of it.
    """
    n = len(y)
    whole = total or n
    q = min(span, n)
    start = np.clip(np.round(at).astype(int) - (q - 1) // 2, 0, n - q)
    idx = start[:, None] + np.arange(q)[None, :]
    dist = np.abs(idx - at[:, None])
    reach = np.maximum(at - start, start + q - 1 - at) + max(span - n, 0) // 2
    reach = np.maximum(reach, 1e-9)[:, None]
    w = np.where(dist <= 0.999 * reach, (1.0 - (dist / reach) ** 3) ** 3, 0.0)
    w = np.where(dist <= 0.001 * reach, 1.0, w) * weights[idx]
    total_w = w.sum(axis=1)
    flat = total_w <= 0
    w = np.where(flat[:, None], 1.0 / q, w / np.where(flat, 1.0, total_w)[:, None])
    centre = (w * idx).sum(axis=1)
    spread = (w * (idx - centre[:, None]) ** 2).sum(axis=1)
    lean = np.where(np.sqrt(spread) > 0.001 * (whole - 1), (at - centre) / np.where(spread > 0, spread, 1.0), 0.0)
    return (w * (1.0 + lean[:, None] * (idx - centre[:, None])) * y[idx]).sum(axis=1)


def _average(x: np.ndarray, k: int) -> np.ndarray:
    s = np.concatenate([[0.0], np.cumsum(x)])
    return (s[k:] - s[:-k]) / k


def _stl_round(y: np.ndarray, trend: np.ndarray, rho: np.ndarray, period: int, seasonal: int, inner: int, total: int):
    """``inner`` passes of the published iteration from a trend and outlier weights: (trend, seasonal).

    Cycle-subseries smoothing, low-pass, trend smoothing; ``total`` is the length of the series.
    """
    n = len(y)
    trend_span, low_span = _odd(1.5 * period / (1.0 - 1.5 / seasonal)), _odd(period + 1)
    every, season = np.arange(n, dtype=float), np.zeros(n)
    for _ in range(inner):
        detrended = y - trend
        cycle = np.zeros(n + 2 * period)
        for phase in range(period):
            part, w = detrended[phase::period], rho[phase::period]
            points = np.arange(-1, len(part) + 1, dtype=float)
            cycle[phase::period][: len(points)] = _loess(part, seasonal, w, points, -(-total // period))
        low = _average(_average(_average(cycle, period), period), 3)
        low = _loess(low, low_span, np.ones(n), every, total)
        season = cycle[period : period + n] - low
        trend = _loess(y - season, trend_span, rho, every, total)
    return trend, season


def _outlier_weight(resid, cut):
    """Bisquare weight of an absolute remainder, ``cut`` being six medians."""
    near = F.pow(1.0 - F.pow(resid / F.greatest(cut, F.lit(1e-300)), 2), 2)
    return F.when(resid <= 0.001 * cut, 1.0).when(resid <= 0.999 * cut, near).otherwise(0.0)


def stl(
    df: DataFrame, column: str, period: int = 24, *, seasonal: int = 7, robust: bool = True,
    keys: Sequence[str] = DEFAULT_KEYS, ts: str = "ts", block_periods: int = 400, halo_periods: int = 20,
    cell: str | None = CELL, outer: int = 15,
) -> DataFrame:
    """STL of series of any length: the same answer whatever the block size.

    Trend and outlier weights are carried per position.  Each outer round runs the two inner
    passes on position blocks with ``halo_periods`` periods of context on both sides (the passes
    reach about 17 periods), then takes the median remainder of each whole series (a mergeable
    sketch, right to one in ``MEDIAN_RANKS`` ranks) and derives the weights of the next round.  ``robust=False`` is one round of five
    passes, for which the context is widened.  Rounds are written to the shared folder.  A series
    below two periods cannot be decomposed and has null parts.
    """
    keys = list(keys)
    rows = df.select(*keys, ts, F.col(column).cast("double").alias(column)).dropna(subset=[ts, column])
    rows = with_position(rows, keys, ts, cell=cell, name="__pos", total="__n")
    state = rows.withColumns({"trend": F.lit(0.0), "__rho": F.lit(1.0)})
    inner = 2 if robust else 5
    fields = ", ".join(f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in keys)
    schema = (fields + ", " if fields else "") + f"{ts} timestamp_ntz, `{column}` double, __pos long, __n long, trend double, seasonal double"
    size, reach = block_periods * period, halo_periods * period * (1 if robust else 3)

    def one_round(state: DataFrame) -> DataFrame:
        b = halo(state, keys, ts, pos="__pos", before=reach, after=reach, size=size)
        width = b.size  # a block is never shorter than its halo

        def block(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values("__pos")
            y, n = pdf[column].to_numpy(), int(pdf["__n"].iloc[0])
            if n < 2 * period:
                trend = season = np.full(len(y), np.nan)
            else:
                trend, season = _stl_round(y, pdf["trend"].to_numpy(), pdf["__rho"].to_numpy(), period, seasonal, inner, n)
            out = pdf[[*keys, ts, column, "__pos", "__n"]].assign(trend=trend, seasonal=season)
            return out[(pdf["__pos"] // width == pdf["__blk"]).to_numpy()]

        return b.df.groupBy(*b.partition).applyInPandas(block, schema)

    parts = one_round(state)
    for _ in range(outer if robust else 0):
        parts = cut(parts.withColumn("__e", F.abs(F.col(column) - F.col("trend") - F.col("seasonal"))))
        known = parts.filter(~F.isnan("__e"))
        middle = known.groupBy(*keys).agg((6.0 * F.percentile_approx("__e", 0.5, MEDIAN_RANKS)).alias("__cut"))
        weighed = attach(parts, middle, keys)
        weight = F.coalesce(_outlier_weight(F.col("__e"), F.col("__cut")), F.lit(1.0))
        start = F.when(F.col("__n") < 2 * period, 0.0).otherwise(F.col("trend"))
        parts = one_round(weighed.select(*keys, ts, column, "__pos", "__n", start.alias("trend"), weight.alias("__rho")))
    none = F.lit(None).cast("double")
    out = parts.select(*keys, ts, column, *[F.nanvl(c, none).alias(c) for c in ("trend", "seasonal")])
    return out.withColumn("resid", F.col(column) - F.col("trend") - F.col("seasonal"))
