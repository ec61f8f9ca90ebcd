"""Distributed primitives for ordered work on series of any length.

``Window.partitionBy(series_id)`` puts a whole series on one task, so a single hot
series stalls a large cluster.  Everything ordered in this package goes through two
building blocks instead:

* :func:`cell_scan` - running sums and last/next non-null values over a whole series.
  Rows are grouped by (series, time cell); one summary row per cell is scanned per
  series and joined back, and the exact per-row answer comes from a window inside the
  cell.  A series is cut into as many equal time cells as its number of rows asks for
  (about ``CELL_ROWS`` each), so tasks hold one cell, never one series, however dense.
* :func:`halo` - bounded row frames (lag, rolling, bounded fill).  Rows are grouped by
  (series, block of ``size`` positions); the rows near a block edge are also copied
  into the neighbouring block, so that every frame is complete inside one block.

The time column must be non-null; a null series key is a key like any other.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_KEYS = ("series_id",)
BLOCK_ROWS = 32_768
CELL = None  # cells by row count
CELL_ROWS = 65_536

_UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3_600, "day": 86_400, "week": 604_800}


def seconds(span: str | int) -> int:
    """``"30 days"`` -> seconds; integers pass through."""
    if isinstance(span, int):
        return span
    match = re.fullmatch(r"\s*(\d+)\s*([a-z]+?)s?\s*", span.lower())
    if not match or match.group(2) not in _UNIT_SECONDS:
        raise ValueError(f"cannot read time span {span!r}")
    return int(match.group(1)) * _UNIT_SECONDS[match.group(2)]


def micros(ts: str | Column) -> Column:
    """Microseconds since 1970 of a timestamp column (session zone must be UTC)."""
    col = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_micros(col.cast("timestamp"))


def from_micros(value: Column) -> Column:
    return F.timestamp_micros(value).cast("timestamp_ntz")


def grid_index(ts: str | Column, step: str | int) -> Column:
    """Position on a regular grid: whole steps since 1970."""
    return F.floor(micros(ts) / F.lit(seconds(step) * 1_000_000))


def cell_scan(
    df: DataFrame,
    keys: Sequence[str],
    order: str | Column,
    *,
    cell: str | int | None = CELL,
    spans: DataFrame | None = None,
    tie: Sequence[str] = (),
    running: Mapping[str, Column] | None = None,
    totals: Mapping[str, Column] | None = None,
    prev: Mapping[str, Column] | None = None,
    nxt: Mapping[str, Column] | None = None,
    exclusive: bool = False,
    numeric: bool = False,
) -> DataFrame:
    """Whole-series ordered scans without a whole-series task.

    ``running`` adds inclusive running sums, ``totals`` per-series sums, ``prev`` the
    last and ``nxt`` the next non-null value of an expression (including the row
    itself unless ``exclusive``).  ``cell`` fixes the width of the cells; by default it follows
    from the number of rows of each series (``spans``: the result of :func:`row_spans` where a caller
    has it already).  ``numeric=True`` orders by a number and ``cell`` is then a width in that number.
    """
    running, totals = dict(running or {}), dict(totals or {})
    prev, nxt = dict(prev or {}), dict(nxt or {})
    keys = list(keys)
    axis = F.col(order) if isinstance(order, str) else order
    position = axis.cast("double") if numeric else micros(axis).cast("double")
    if cell is None:
        spans = row_spans(df, keys, order, numeric=numeric) if spans is None else spans
        rows = spread_join(df, spans, keys) if keys else attach(df, spans)
        place = F.floor((position - F.col("__lo")) / (F.col("__hi") - F.col("__lo")) * F.col("__cells"))
        number = F.when(F.col("__hi") > F.col("__lo"), F.least(place, F.col("__cells") - 1)).otherwise(F.lit(0))
        rows = rows.withColumn("__cell", number).drop("__lo", "__hi", "__cells")
    else:
        width = float(cell) if numeric else float(seconds(cell) * 1_000_000)
        rows = df.withColumn("__cell", F.floor(position / F.lit(width)))
    sort = [axis, *[F.col(t) for t in tie]]
    rank = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(sort)])

    aggs = [F.sum(e).alias(f"__r_{n}") for n, e in running.items()]
    aggs += [F.sum(e).alias(f"__t_{n}") for n, e in totals.items()]
    aggs += [
        F.max_by(e, F.when(e.isNotNull(), rank)).alias(f"__p_{n}") for n, e in prev.items()
    ]
    aggs += [
        F.min_by(e, F.when(e.isNotNull(), rank)).alias(f"__n_{n}") for n, e in nxt.items()
    ]
    cells = rows.groupBy(*keys, "__cell").agg(*aggs)

    up = Window.partitionBy(*keys).orderBy("__cell")
    down = Window.partitionBy(*keys).orderBy(F.col("__cell").desc())
    whole = Window.partitionBy(*keys)
    earlier = up.rowsBetween(Window.unboundedPreceding, -1)
    later = down.rowsBetween(Window.unboundedPreceding, -1)
    carried = [*[F.col(k) for k in keys], F.col("__cell")]
    carried += [F.sum(f"__r_{n}").over(earlier).alias(f"__r_{n}") for n in running]
    carried += [F.sum(f"__t_{n}").over(whole).alias(f"__t_{n}") for n in totals]
    carried += [F.last(f"__p_{n}", True).over(earlier).alias(f"__p_{n}") for n in prev]
    carried += [F.last(f"__n_{n}", True).over(later).alias(f"__n_{n}") for n in nxt]
    carry = cells.select(*carried)

    joined = null_safe_join(rows, carry, [*keys, "__cell"], "left")
    inside = Window.partitionBy(*keys, "__cell").orderBy(*sort)
    backwards = Window.partitionBy(*keys, "__cell").orderBy(*[c.desc() for c in sort])
    edge = -1 if exclusive else 0
    past = inside.rowsBetween(Window.unboundedPreceding, edge)
    ahead = backwards.rowsBetween(Window.unboundedPreceding, edge)
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)

    out = [F.col(c) for c in df.columns]
    for n, e in running.items():
        out.append((F.coalesce(f"__r_{n}", F.lit(0)) + F.coalesce(F.sum(e).over(upto), F.lit(0))).alias(n))
    out += [F.col(f"__t_{n}").alias(n) for n in totals]
    out += [F.coalesce(F.last(e, True).over(past), F.col(f"__p_{n}")).alias(n) for n, e in prev.items()]
    out += [F.coalesce(F.last(e, True).over(ahead), F.col(f"__n_{n}")).alias(n) for n, e in nxt.items()]
    return joined.select(*out)


def row_spans(df: DataFrame, keys: Sequence[str], order: str | Column, *, numeric: bool = False) -> DataFrame:
    """Per series: first and last position and the number of cells for its rows."""
    axis = F.col(order) if isinstance(order, str) else order
    position = axis.cast("double") if numeric else micros(axis).cast("double")
    return df.groupBy(*keys).agg(
        F.min(position).alias("__lo"), F.max(position).alias("__hi"), F.ceil(F.count("*") / F.lit(CELL_ROWS)).alias("__cells")
    )


def with_position(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    *,
    tie: Sequence[str] = (),
    cell: str | int | None = CELL,
    name: str = "pos",
    total: str | None = None,
) -> DataFrame:
    """0-based row number inside the series (and optionally the series length)."""
    one = F.lit(1).cast("bigint")
    out = cell_scan(
        df, keys, ts, cell=cell, tie=tie, running={name: one}, totals={total: one} if total else None
    )
    return out.withColumn(name, F.col(name) - 1)


class Blocked:
    """Rows spread over position blocks with copied edges; see :func:`halo`."""

    def __init__(self, df: DataFrame, keys: Sequence[str], pos: str, size: int, columns: list[str], own_pos: bool):
        self.df = df
        self.keys = list(keys)
        self.pos = pos
        self.size = size
        self._columns = columns
        self._own_pos = own_pos
        self.partition = [*self.keys, "__blk"]
        self.w = Window.partitionBy(*self.partition).orderBy(pos)
        self.w_desc = Window.partitionBy(*self.partition).orderBy(F.col(pos).desc())

    def frame(self, start: int, end: int):
        return self.w.rowsBetween(start, end)

    @property
    def home(self) -> Column:
        return F.floor(F.col(self.pos) / F.lit(self.size)) == F.col("__blk")

    def close(self, df: DataFrame) -> DataFrame:
        """Keep each row once, in the block that owns it."""
        extra = ["__blk"] + ([self.pos] if self._own_pos else [])
        return df.filter(self.home).drop(*extra)


def halo(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    *,
    before: int = 0,
    after: int = 0,
    step: str | int | None = None,
    pos: str | None = None,
    size: int | None = None,
    tie: Sequence[str] = (),
    cell: str | int | None = CELL,
) -> Blocked:
    """Spread rows over blocks so that frames of ``before``/``after`` rows are complete.

    With ``step`` the series is known to sit on a regular grid without holes and the
    position is plain time arithmetic (no extra pass).  With ``pos`` an existing row
    number is used.  Otherwise the row number comes from :func:`with_position`.
    """
    size = max(size or BLOCK_ROWS, before + after, 1)
    own = pos is None
    columns = list(df.columns)
    if pos is None:
        pos = "__pos"
        if step is not None:
            df = df.withColumn(pos, grid_index(ts, step))
        else:
            df = with_position(df, keys, ts, tie=tie, cell=cell, name=pos)
    p, n = F.col(pos), F.lit(size)
    if before or after:
        first, last = F.floor((p - after) / n), F.floor((p + before) / n)
        df = df.withColumn("__blk", F.explode(F.sequence(first, last)))
    else:
        df = df.withColumn("__blk", F.floor(p / n))
    return Blocked(df, keys, pos, size, columns, own)


def _block_carry(df, keys, pos, size, shift, named, pick, down):
    block = F.floor((F.col(pos) + shift) / F.lit(size))
    edges = (
        df.withColumn("__blk", block)
        .groupBy(*keys, "__blk")
        .agg(*[pick(e, F.when(e.isNotNull(), F.col(pos))).alias(n) for n, e in named.items()])
    )
    order = F.col("__blk").desc() if down else F.col("__blk")
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return edges.select(*keys, "__blk", *[F.last(n, True).over(w).alias(n) for n in named])


def carry_in(df: DataFrame, keys: Sequence[str], pos: str, size: int, before: int, named: Mapping[str, Column]):
    """Per block: last non-null value of each expression before the block's first row.

    One row per block, so the per-series scan is smaller than the data by the block
    size.  ``before`` is the block's front halo.
    """
    return _block_carry(df, list(keys), pos, size, before, dict(named), F.max_by, False)


def carry_back(df: DataFrame, keys: Sequence[str], pos: str, size: int, after: int, named: Mapping[str, Column]):
    """Per block: first non-null value of each expression behind the block's last row."""
    return _block_carry(df, list(keys), pos, size, -after, dict(named), F.min_by, True)


def spread_join(rows: DataFrame, stats: DataFrame, on: Sequence[str], salts: int = 32) -> DataFrame:
    """Inner join of many rows to the one row of their key in ``stats``; null keys are equal.

    The small side is repeated ``salts`` times and the rows are dealt over the copies, so that
    no key, not even one that holds all rows, is joined on one task.
    """
    dealt = rows.withColumn("__salt", F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int"))
    copies = stats.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return null_safe_join(dealt, copies, [*on, "__salt"]).drop("__salt")


def null_safe_join(rows: DataFrame, stats: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join (inner or left) on columns of equal names, with null equal to null."""
    renamed = stats.withColumnsRenamed({k: f"__on{i}" for i, k in enumerate(on)})
    fits = [F.col(k).eqNullSafe(F.col(f"__on{i}")) for i, k in enumerate(on)]
    return rows.join(renamed, fits, how).drop(*[f"__on{i}" for i in range(len(on))])


def attach(df: DataFrame, stats: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Add per-series statistics to rows; without keys, one scalar subquery (no join)."""
    if keys:
        return null_safe_join(df, stats, list(keys), "left")
    return df.withColumn("__st", stats.select(F.struct("*")).scalar()).select(*df.columns, "__st.*")
