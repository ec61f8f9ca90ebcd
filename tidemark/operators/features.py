"""Lag, rolling, difference, exponentially weighted and sequence features."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.calendar import add_time_features
from tidemark.functions.weather import HUMIDITY, RADIATION, TEMPERATURE, WIND, add_interactions, add_radiation_norm, add_weather_indices
from tidemark.session import cut, prepare
from tidemark.operators.blocks import CELL, DEFAULT_KEYS, Blocked, carry_in, grid_index, halo, null_safe_join, with_position
from tidemark.operators.timeindex import drop_incomplete


def _label(hours: int) -> str:
    """Column label of a row count; one week is written as days."""
    return f"{hours // 24}d" if hours >= 168 and hours % 24 == 0 else f"{hours}h"


def lag_columns(b: Blocked, column: str, lags: Sequence[int]) -> list[Column]:
    return [F.lag(column, k).over(b.w).alias(f"{column}_lag_{k}h") for k in lags]


def rolling_columns(b: Blocked, column: str, windows: Sequence[int]) -> list[Column]:
    """Mean, sample deviation, min, max and range of the last ``w`` rows.

    A value needs at least ``max(1, w // 4)`` non-null rows in its frame.
    """
    out = []
    for w in windows:
        frame, label = b.frame(-(w - 1), 0), _label(w)
        enough = F.count(column).over(frame) >= max(1, w // 4)
        low, high = F.min(column).over(frame), F.max(column).over(frame)
        for name, value in (
            ("mean", F.avg(column).over(frame)),
            ("std", F.stddev_samp(column).over(frame)),
            ("min", low),
            ("max", high),
            ("range", high - low),
        ):
            out.append(F.when(enough, value).alias(f"{column}_roll_{name}_{label}"))
    return out


def diff_columns(b: Blocked, column: str, diffs: Sequence[int], padded: str | None = None) -> list[Column]:
    """``x - x[t-d]`` and the relative change clipped to [-2, 2].

    ``padded`` names the column with nulls repeated forward, which the relative change
    is taken on.  Division by zero is decided by sign, 0/0 is null.
    """
    base = padded or column
    out = []
    for d in diffs:
        old, now = F.lag(base, d).over(b.w), F.col(base)
        ratio = F.when(old != 0, now / old - 1.0).when((old == 0) & (now > 0), 2.0).when((old == 0) & (now < 0), -2.0)
        clipped = F.when(ratio > 2, 2.0).when(ratio < -2, -2.0).otherwise(ratio)
        out.append((F.col(column) - F.lag(column, d).over(b.w)).alias(f"{column}_diff_{_label(d)}"))
        out.append(clipped.alias(f"{column}_pct_{_label(d)}"))
    return out


def add_lags(df, column, lags, *, keys=DEFAULT_KEYS, ts="ts", step=None, size=None, cell=CELL) -> DataFrame:
    """Row-based lags ``<column>_lag_<k>h``; regularise the series first for true hours."""
    b = halo(df, keys, ts, before=max(lags), step=step, size=size, cell=cell)
    return b.close(b.df.select("*", *lag_columns(b, column, lags)))


def add_rolling(df, column, windows=(6, 24, 168), *, keys=DEFAULT_KEYS, ts="ts", step=None, size=None, cell=CELL):
    b = halo(df, keys, ts, before=max(windows) - 1, step=step, size=size, cell=cell)
    return b.close(b.df.select("*", *rolling_columns(b, column, windows)))


def _pad(b: Blocked, column: str, before: int, name: str = "__pad") -> DataFrame:
    home = b.df.filter(b.home).drop("__blk")
    edges = carry_in(home, b.keys, b.pos, b.size, before, {"__pe": F.col(column)})
    past = b.w.rowsBetween(Window.unboundedPreceding, 0)
    rows = null_safe_join(b.df, edges, b.partition, "left")
    return rows.withColumn(name, F.coalesce(F.last(column, True).over(past), F.col("__pe"))).drop("__pe")


def add_differences(
    df, column, diffs=(1, 24, 168), *, keys=DEFAULT_KEYS, ts="ts", step=None, size=None, cell=CELL, pad=True
) -> DataFrame:
    """Differences and clipped relative changes.

    With ``pad`` nulls repeat the last value for the relative change; ``pad=False`` skips
    that pass for a column known to have none.
    """
    b = halo(df, keys, ts, before=max(diffs), step=step, size=size, cell=cell)
    rows = _pad(b, column, max(diffs)) if pad else b.df
    out = rows.select("*", *diff_columns(b, column, diffs, "__pad" if pad else None))
    return b.close(out).drop("__pad")


#: Block number of sums carried in from rows before the first block.
_BEFORE = -(2**62)


def _ewm_rates(spans: Sequence[int], max_block: int | None = None) -> tuple[dict[int, float], int]:
    """Decay rate of every span and the rows of a block, so that no exponent overflows."""
    rates = {w: -math.log(1.0 - 2.0 / (w + 1.0)) for w in spans if w > 1}
    if len(rates) != len(set(spans)):
        raise ValueError("spans must be at least 2 and distinct")
    length = max(1, int(600.0 / max(rates.values())))
    return rates, min(length, max_block) if max_block else length


def _decay(rate: float, age: Column) -> Column:
    return F.exp(F.lit(-rate) * age)


def _ewm_blocks(
    rows: DataFrame, column: str, keys: list[str], rates: Mapping[int, float], length: int, start: DataFrame | None
) -> DataFrame:
    """Per (series, block): weighted sums ``was`` of all rows before it and ``end`` of those and its own, each as of row ``ref``."""
    p = F.col("__pos")
    offset = p - F.col("__blk") * F.lit(length)
    x = F.col(column).cast("double")
    seen = x.isNotNull()
    aggs = [F.max(F.when(seen, p)).alias("ref")]
    for w, rate in rates.items():
        weight = _decay(rate, F.lit(length - 1) - offset)
        aggs += [F.sum(x * weight).alias(f"n_{w}"), F.sum(F.when(seen, weight)).alias(f"d_{w}")]
    state = rows.groupBy(*keys, "__blk").agg(*aggs)
    earlier = Window.partitionBy(*keys).orderBy("__blk").rowsBetween(Window.unboundedPreceding, -1)
    to_ref = (F.col("__blk") + 1) * F.lit(length) - 1 - F.col("ref")
    fields = [F.col("ref")]
    for w, rate in rates.items():
        scale = F.exp(F.lit(rate) * to_ref)
        fields += [(F.col(f"n_{w}") * scale).alias(f"n_{w}"), (F.col(f"d_{w}") * scale).alias(f"d_{w}")]
    own = F.when(F.col("ref").isNotNull(), F.struct(*fields))
    state = state.select(*keys, "__blk", own.alias("own"))
    rounds = 1 + math.ceil(46.0 / min(rates.values()) / length)
    if start is not None:
        sums = F.struct("ref", *[f"{part}_{w}" for w in rates for part in ("n", "d")])
        state = state.unionByName(start.select(*keys, F.lit(_BEFORE).alias("__blk"), sums.alias("own")))
        rounds += 1  # the first block may follow within a few rows
    state = state.withColumn("end", F.col("own"))
    for _ in range(rounds):
        state = state.withColumn("was", F.last("end", True).over(earlier))
        mixed = [F.col("own.ref").alias("ref")]
        for w, rate in rates.items():
            fade = F.coalesce(_decay(rate, F.col("own.ref") - F.col("was.ref")), F.lit(0.0))
            for part in ("n", "d"):
                old = F.coalesce(F.col(f"was.{part}_{w}") * fade, F.lit(0.0))
                mixed.append((F.col(f"own.{part}_{w}") + old).alias(f"{part}_{w}"))
        state = state.withColumn("end", F.when(F.col("own").isNotNull(), F.struct(*mixed)))
    return state.select(*keys, "__blk", F.last("end", True).over(earlier).alias("was"), "end")


def add_ewm(
    df: DataFrame,
    column: str,
    spans: Sequence[int] = (6, 24, 168),
    *,
    keys: Sequence[str] = DEFAULT_KEYS,
    ts: str = "ts",
    step: str | None = None,
    cell: str | None = CELL,
    pos: str | None = None,
    max_block: int | None = None,
    sums: DataFrame | None = None,
) -> DataFrame:
    """Exponentially weighted mean ``<column>_ewm_<w>h`` over the whole past.

    Weights ``(1 - a)^age`` with ``a = 2 / (w + 1)`` and the age in rows; nulls carry no
    weight but still age the others.  Each block keeps the weighted sums of its own rows
    (bounded exponents, so no overflow) plus the state of the blocks before it.  A block
    is long enough that only the last few non-null blocks still matter in double
    precision, so the state needs a short lag over one row per block (``sums``: the result
    of :func:`ewm_sums` where a caller has it already, for the positions ``pos``).
    """
    keys = list(keys)
    rates, length = _ewm_rates(spans, max_block)
    columns = df.columns
    if pos is not None:
        rows = df.withColumn("__pos", F.col(pos))
    elif step is not None:
        rows = df.withColumn("__pos", grid_index(ts, step))
    else:
        rows = with_position(df, keys, ts, cell=cell, name="__pos")
    rows = rows.withColumn("__blk", F.floor(F.col("__pos") / F.lit(length)))
    p = F.col("__pos")
    offset = p - F.col("__blk") * F.lit(length)
    x = F.col(column).cast("double")
    seen = x.isNotNull()
    state = _ewm_blocks(rows, column, keys, rates, length, None) if sums is None else sums
    carry = state.select(*keys, "__blk", "was")

    inside = Window.partitionBy(*keys, "__blk").orderBy("__pos").rowsBetween(Window.unboundedPreceding, 0)
    joined = null_safe_join(rows, carry, [*keys, "__blk"], "left")
    out = [F.col(c) for c in columns]
    for w, rate in rates.items():
        gain = F.exp(F.lit(rate) * offset)
        top, bottom = F.sum(x * gain).over(inside), F.sum(F.when(seen, gain)).over(inside)
        back = _decay(rate, offset)
        old = _decay(rate, p - F.col("was.ref"))
        top = top * back + F.coalesce(F.col(f"was.n_{w}") * old, F.lit(0.0))
        bottom = bottom * back + F.coalesce(F.col(f"was.d_{w}") * old, F.lit(0.0))
        out.append(
            F.coalesce(top / bottom, F.col(f"was.n_{w}") / F.col(f"was.d_{w}")).alias(f"{column}_ewm_{_label(w)}")
        )
    return joined.select(*out)


def ewm_sums(
    df: DataFrame, column: str, spans: Sequence[int], *, keys: Sequence[str] = DEFAULT_KEYS, pos: str, start: DataFrame | None = None
) -> DataFrame:
    """Weighted sums ``n_<w>``, ``d_<w>`` as of row ``ref``, per block of positions: before it (``was``) and at its end (``end``).

    With ``start`` (``ref`` and such sums of earlier rows, one row per series) the series go on from there.
    """
    rates, length = _ewm_rates(spans)
    rows = df.withColumn("__pos", F.col(pos)).withColumn("__blk", F.floor(F.col(pos) / F.lit(length)))
    return _ewm_blocks(rows, column, list(keys), rates, length, start)


def sequences(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    length: int = 48,
    *,
    keys: Sequence[str] = DEFAULT_KEYS,
    ts: str = "ts",
    step: str | None = None,
    size: int | None = None,
) -> DataFrame:
    """Sliding windows: ``length`` earlier rows of the features and the current label."""
    b = halo(df.select(*keys, ts, *dict.fromkeys([*features, label])), keys, ts, before=length, step=step, size=size)
    frame = b.frame(-length, -1)
    vector = F.array(*[F.col(f).cast("double") for f in features])
    rows = b.df.withColumn("window", F.collect_list(vector).over(frame)).withColumn("y", F.col(label))
    return b.close(rows.filter(F.size("window") == length)).select(*keys, ts, "window", "y")


@dataclass(frozen=True)
class FeatureSpec:
    """One description shared by training and scoring, so their columns cannot differ."""

    target: str = TEMPERATURE
    lags: tuple[int, ...] = (1, 2, 3, 6, 12, 24, 48, 72, 168)
    other_lags: tuple[int, ...] = (1, 6, 24)
    other_columns: tuple[str, ...] = (HUMIDITY, WIND, RADIATION)
    windows: tuple[int, ...] = (6, 24, 168)
    diffs: tuple[int, ...] = (1, 24, 168)
    derived: bool = True
    horizon: int | None = 24

    @property
    def target_column(self) -> str:
        return f"target_{self.horizon}h"

    def history(self) -> int:
        """Rows of history the longest feature needs."""
        return max(*self.lags, *self.diffs, *self.windows)

    def for_scoring(self) -> FeatureSpec:
        """The short feature set of the recent-rows job: lags up to 48, windows 6 and 24."""
        return FeatureSpec(
            target=self.target, lags=tuple(k for k in self.lags if k <= 48), other_lags=(), other_columns=(),
            windows=(6, 24), diffs=self.diffs, derived=False, horizon=None,
        )


def build_features(
    df: DataFrame,
    spec: FeatureSpec = FeatureSpec(),
    *,
    keys: Sequence[str] = DEFAULT_KEYS,
    ts: str = "ts",
    step: str | None = None,
    size: int | None = None,
    cell: str | None = CELL,
    drop: bool = True,
    materialize: bool = False,
) -> DataFrame:
    """All features and the lead target; rows with any null are dropped.

    Lags, rolling frames, differences and the target share one block shuffle and sort;
    the exponentially weighted means add one more.  The block summaries read the input
    again: with ``materialize`` it is checkpointed first, otherwise the plan stays lazy.
    """
    prepare(df.sparkSession)
    if step is None:
        df = with_position(df, keys, ts, cell=cell, name="__row")
    else:
        df = df.withColumn("__row", grid_index(ts, step))
    if materialize:
        df = cut(df)
    source = df
    if spec.windows:
        df = add_ewm(df, spec.target, spec.windows, keys=keys, ts=ts, pos="__row")
    before = max(spec.history(), *(spec.other_lags or (0,)))
    b = halo(df, keys, ts, before=before, after=spec.horizon or 0, pos="__row", size=size)
    rows = _pad(b, spec.target, before)
    new = lag_columns(b, spec.target, spec.lags)
    for c in spec.other_columns:
        if c in df.columns:
            new += lag_columns(b, c, spec.other_lags)
    new += rolling_columns(b, spec.target, spec.windows)
    new += diff_columns(b, spec.target, spec.diffs, "__pad")
    if spec.horizon:
        new.append(F.lead(spec.target, spec.horizon).over(b.w).alias(spec.target_column))
    out = b.close(rows.select("*", *new)).drop("__pad", "__row")
    out = add_time_features(out, ts)
    if spec.derived:
        out = add_weather_indices(out)
        if RADIATION in df.columns:
            out = add_radiation_norm(out, fit_on=source)
        out = add_interactions(out)
    return drop_incomplete(out) if drop else out


def feature_columns(df: DataFrame, spec: FeatureSpec, *, keys: Sequence[str] = DEFAULT_KEYS, ts: str = "ts") -> list[str]:
    """Numeric model inputs: everything but keys, time, the raw target and the label."""
    skip = {*keys, ts, spec.target, spec.target_column, "split"}
    return [f.name for f in df.schema.fields if f.name not in skip and f.dataType.typeName() not in ("string", "boolean")]
