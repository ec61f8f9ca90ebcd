"""Time-index operators: dedupe, grids, resampling, as-of joins, windows, splits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.blocks import (
    CELL,
    DEFAULT_KEYS,
    attach,
    cell_scan,
    row_spans,
    from_micros,
    grid_index,
    halo,
    micros,
    seconds,
    spread_join,
    with_position,
)


def dedupe(
    df: DataFrame,
    *,
    keys: Sequence[str] = DEFAULT_KEYS,
    ts: str = "ts",
    order: Sequence[str],
    keep: str = "first",
) -> DataFrame:
    """One row per (series, time): the first or the last in ``order``.

    An aggregate rather than ``row_number``: copies are combined before the shuffle, so
    a key with a huge number of copies never lands on one task whole.
    """
    pick = F.min_by if keep == "first" else F.max_by
    rank = F.struct(*order)
    rest = [c for c in df.columns if c not in (*keys, ts)]
    best = df.groupBy(*keys, ts).agg(pick(F.struct(*rest), rank).alias("__row"))
    return best.select(*keys, ts, "__row.*").select(*df.columns)


def sort_for_write(df: DataFrame, *, keys: Sequence[str] = DEFAULT_KEYS, ts: str = "ts") -> DataFrame:
    """Chronological order for a sink: range partitions, each sorted (no single task)."""
    return df.repartitionByRange(*keys, ts).sortWithinPartitions(*keys, ts)


def downsample(
    df: DataFrame,
    step: str,
    aggs: Mapping[str, Column],
    *,
    keys: Sequence[str] = DEFAULT_KEYS,
    ts: str = "ts",
) -> DataFrame:
    """Tumbling aggregate on calendar-aligned steps (hour, day, ...); empty steps stay absent."""
    width = seconds(step) * 1_000_000
    bucket = from_micros(grid_index(ts, step) * F.lit(width))
    return df.groupBy(*keys, bucket.alias("__b")).agg(*[e.alias(n) for n, e in aggs.items()]).withColumnRenamed(
        "__b", ts
    )


def regularize(
    df: DataFrame, step: str, *, keys: Sequence[str] = DEFAULT_KEYS, ts: str = "ts", cell: str | None = CELL
) -> DataFrame:
    """Insert the missing grid rows of each series between its first and last row.

    Every row writes itself and the hole behind it, so no grid table and no join of the
    dense grid is needed.  Inserted rows carry nulls and ``is_filled = true``.
    """
    width = F.lit(seconds(step) * 1_000_000)
    following = cell_scan(df, keys, ts, cell=cell, nxt={"__next": F.col(ts)}, exclusive=True)
    start = micros(ts)
    stop = F.coalesce(micros("__next") - width, start)
    grown = following.withColumn("__at", F.explode(F.sequence(start, F.greatest(start, stop), width)))
    own = F.col("__at") == micros(ts)
    rest = [c for c in df.columns if c not in (*keys, ts)]
    return grown.select(
        *keys,
        from_micros(F.col("__at")).alias(ts),
        *[F.when(own, F.col(c)).alias(c) for c in rest],
        (~own).alias("is_filled"),
    )


def missing_times(df: DataFrame, step: str, *, keys: Sequence[str] = DEFAULT_KEYS, ts: str = "ts") -> DataFrame:
    """The absent grid times of each series."""
    return regularize(df.select(*keys, ts), step, keys=keys, ts=ts).filter("is_filled").select(*keys, ts)


def continuity(
    df: DataFrame,
    step: str = "1 hour",
    *,
    keys: Sequence[str] = DEFAULT_KEYS,
    ts: str = "ts",
    warn_pct: float = 5.0,
) -> DataFrame:
    """Expected and present rows, and the missing share in percent (never negative)."""
    span = (micros(F.max(ts)) - micros(F.min(ts))) / F.lit(seconds(step) * 1_000_000)
    found = df.groupBy(*keys).agg(F.count(ts).alias("n_rows"), (F.floor(span) + 1).alias("n_expected"))
    pct = F.greatest(F.lit(0.0), (F.col("n_expected") - F.col("n_rows")) * 100.0 / F.col("n_expected"))
    return found.withColumn("missing_pct", pct).withColumn("warn", F.col("missing_pct") > warn_pct)


def gaps(df: DataFrame, *, keys: Sequence[str] = DEFAULT_KEYS, ts: str = "ts", cell: str | None = CELL) -> DataFrame:
    """Largest distance in hours between neighbouring rows of a series.

    Needs no row window: per cell only the inner gaps (a window inside the cell) and the
    cell's end points matter; the end points are scanned over the cells.
    """
    following = cell_scan(df.select(*keys, ts), keys, ts, cell=cell, nxt={"__next": F.col(ts)}, exclusive=True)
    hours = (micros("__next") - micros(ts)) / F.lit(3_600_000_000)
    return following.groupBy(*keys).agg(F.max(hours).alias("max_gap_hours"))


def upsample_ffill(
    df: DataFrame,
    step: str = "1 hour",
    limit: int = 24,
    *,
    keys: Sequence[str] = DEFAULT_KEYS,
    ts: str = "ts",
    dense: bool = True,
    cell: str | None = CELL,
) -> DataFrame:
    """Coarse rows onto a finer grid, repeating each row at most ``limit`` times.

    The grid ends at the last source row.  Holes longer than the limit stay null; with
    ``dense=False`` those null rows are not produced at all.
    """
    width = seconds(step) * 1_000_000
    following = cell_scan(df, keys, ts, cell=cell, nxt={"__next": F.col(ts)}, exclusive=True)
    start = micros(ts)
    stop = F.greatest(start, F.coalesce(micros("__next") - F.lit(width), start))
    if not dense:
        stop = F.least(stop, start + F.lit(width * limit))
    grown = following.withColumn("__at", F.explode(F.sequence(start, stop, F.lit(width))))
    near = F.col("__at") <= start + F.lit(width * limit)
    rest = [c for c in df.columns if c not in (*keys, ts)]
    return grown.select(
        *keys, from_micros(F.col("__at")).alias(ts), *[F.when(near, F.col(c)).alias(c) for c in rest]
    )


def _tagged(left: DataFrame, right: DataFrame, keys: Sequence[str], ts: str, values: Sequence[str]) -> DataFrame:
    payload = [c for c in left.columns if c not in (*keys, ts)]
    l_rows = left.select(
        *keys, ts, F.lit(0).alias("__side"), F.struct(*(payload or [F.lit(1).alias("x")])).alias("__left"),
        F.lit(None).cast(right.select(F.struct(*values)).schema[0].dataType).alias("__right"),
    )
    r_rows = right.select(
        *keys, ts, F.lit(1).alias("__side"),
        F.lit(None).cast(l_rows.schema["__left"].dataType).alias("__left"), F.struct(*values).alias("__right"),
    )
    return l_rows.unionByName(r_rows)


def asof_backward(
    left: DataFrame,
    right: DataFrame,
    values: Sequence[str],
    *,
    keys: Sequence[str] = DEFAULT_KEYS,
    ts: str = "ts",
    limit: int | None = None,
    step: str | None = None,
    cell: str | None = CELL,
) -> DataFrame:
    """Attach to every left row the right row at the same time or the last one before.

    At most ``limit`` left rows after a right row take its value (an exact match does not
    count).  A right row whose value is null still wins over older rows.  The right side
    must be unique per (series, time).  With ``step`` the left side is known to be a full
    grid and the row limit becomes arithmetic; otherwise left rows are counted.
    """
    payload = [c for c in left.columns if c not in (*keys, ts)]
    both = _tagged(left, right, keys, ts, values)
    counted = limit is not None and step is None
    spans = row_spans(both, keys, ts) if cell is None else None
    if counted:
        both = cell_scan(
            both, keys, ts, tie=["__side"], cell=cell, spans=spans,
            running={"__seen": F.when(F.col("__side") == 0, 1).otherwise(0).cast("bigint")},
        )
    mark = [F.col(ts).alias("t"), F.col("__right").alias("r")]
    if counted:
        mark.append(F.col("__seen").alias("k"))
    match = F.when(F.col("__side") == 1, F.struct(*mark))
    # left rows sort before right rows of the same time: `prev` is strictly earlier and
    # `nxt` is an exact match when its time is equal
    found = cell_scan(both, keys, ts, tie=["__side"], cell=cell, spans=spans, prev={"__prev": match}, nxt={"__nxt": match})
    exact = F.col("__nxt.t") == F.col(ts)
    if limit is None:
        near = F.lit(True)
    elif counted:
        near = F.col("__seen") - F.col("__prev.k") <= limit
    else:
        near = grid_index(ts, step) - grid_index(F.col("__prev.t"), step) <= limit
    hit = F.when(exact, F.col("__nxt")).when(near, F.col("__prev"))
    rows = found.filter(F.col("__side") == 0).withColumn("__hit", hit)
    return rows.select(
        *keys, ts, *[F.col(f"__left.{c}").alias(c) for c in payload],
        *[F.col(f"__hit.r.{v}").alias(v) for v in values],
        F.col("__hit.t").alias("matched_ts"),
    )


def asof_nearest(
    left: DataFrame,
    right: DataFrame,
    values: Sequence[str],
    *,
    keys: Sequence[str] = DEFAULT_KEYS,
    ts: str = "ts",
    cell: str | None = CELL,
) -> DataFrame:
    """Attach the right row nearest in time; on a tie the later one wins."""
    payload = [c for c in left.columns if c not in (*keys, ts)]
    both = _tagged(left, right, keys, ts, values)
    match = F.when(F.col("__side") == 1, F.struct(F.col(ts).alias("t"), F.col("__right").alias("r")))
    found = cell_scan(both, keys, ts, tie=["__side"], cell=cell, prev={"__prev": match}, nxt={"__nxt": match})
    behind = micros(ts) - micros(F.col("__prev.t"))
    ahead = micros(F.col("__nxt.t")) - micros(ts)
    hit = F.when(F.col("__nxt").isNull(), F.col("__prev")).when(
        F.col("__prev").isNotNull() & (behind < ahead), F.col("__prev")
    ).otherwise(F.col("__nxt"))
    rows = found.filter(F.col("__side") == 0).withColumn("__hit", hit)
    return rows.select(
        *keys, ts, *[F.col(f"__left.{c}").alias(c) for c in payload],
        *[F.col(f"__hit.r.{v}").alias(v) for v in values],
        F.col("__hit.t").alias("matched_ts"),
    )


def left_align(
    left: DataFrame, right: DataFrame | None, *, keys: Sequence[str] = DEFAULT_KEYS, ts: str = "ts"
) -> DataFrame:
    """Left equi-join on time; without a right table the left side passes through.

    No broadcast hint: adaptive execution broadcasts the right side from its measured size.
    """
    if right is None:
        return left
    return left.join(right, [*keys, ts], "left")


def outer_concat(
    df: DataFrame, name: str, names: Sequence[str], values: Sequence[str], *, ts: str = "ts"
) -> DataFrame:
    """Long bars -> one wide row per time, ``<name>_<value>`` columns (outer in time).

    ``names`` is given by the caller so that no extra job discovers the pivot values.
    """
    aggs = [
        F.first(F.when(F.col(name) == n, F.col(v)), ignorenulls=True).alias(f"{n}_{v}")
        for n in names
        for v in values
    ]
    return df.groupBy(ts).agg(*aggs)


def trailing_window(
    df: DataFrame, hours: int, *, keys: Sequence[str] = DEFAULT_KEYS, ts: str = "ts"
) -> DataFrame:
    """Rows with ``ts >= max(ts) - hours`` of their series (inclusive)."""
    newest = df.groupBy(*keys).agg((F.max(ts) - F.expr(f"INTERVAL {int(hours)} HOURS")).alias("__cut"))
    rows = spread_join(df, newest, list(keys)) if keys else attach(df, newest)
    return rows.filter(F.col(ts) >= F.col("__cut")).drop("__cut")


def tail_rows(
    df: DataFrame, n: int, *, keys: Sequence[str] = DEFAULT_KEYS, ts: str = "ts", tie: Sequence[str] = ()
) -> DataFrame:
    """Last ``n`` rows per series; Spark prunes to ``n`` per task before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(F.col(ts).desc(), *[F.col(t).desc() for t in tie])
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= n).drop("__rn")


def head_rows(
    df: DataFrame, n: int, *, keys: Sequence[str] = DEFAULT_KEYS, ts: str = "ts", tie: Sequence[str] = ()
) -> DataFrame:
    """First ``n`` rows per series, pruned the same way."""
    w = Window.partitionBy(*keys).orderBy(F.col(ts), *[F.col(t) for t in tie])
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= n).drop("__rn")


def recent_slice(df: DataFrame, now: Column, hours: int, *, ts: str = "ts") -> DataFrame:
    """Rows of the last ``hours`` before ``now``; a plain range filter that prunes partitions."""
    return df.filter((F.col(ts) >= now - F.expr(f"INTERVAL {int(hours)} HOURS")) & (F.col(ts) <= now))


def lead_target(
    df: DataFrame,
    column: str,
    horizon: int,
    *,
    name: str | None = None,
    keys: Sequence[str] = DEFAULT_KEYS,
    ts: str = "ts",
    step: str | None = None,
    size: int | None = None,
) -> DataFrame:
    """Value ``horizon`` rows ahead as the training target."""
    b = halo(df, keys, ts, after=horizon, step=step, size=size)
    return b.close(b.df.withColumn(name or f"target_{horizon}h", F.lead(column, horizon).over(b.w)))


def drop_incomplete(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a null in any (or the given) column, as one condition per column.

    ``dropna`` is one condition over all columns; below the projection that made them it holds every
    feature's expression at once, and the optimizer then doubles its constraints with each feature.
    """
    return df.filter(reduce(and_, [F.col(f"`{c}`").isNotNull() for c in columns or df.columns]))


def drop_report(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """How many rows :func:`drop_incomplete` removes, in one pass."""
    incomplete = F.lit(False)
    for c in columns:
        incomplete = incomplete | F.col(c).isNull()
    return df.agg(
        F.count("*").alias("n_before"),
        F.count_if(~incomplete).alias("n_after"),
        F.count_if(incomplete).alias("n_dropped"),
        (F.avg(incomplete.cast("int")) * 100.0).alias("dropped_pct"),
    )


def temporal_split(
    df: DataFrame,
    train_ratio: float = 0.8,
    val_ratio: float = 0.1,
    *,
    keys: Sequence[str] = DEFAULT_KEYS,
    ts: str = "ts",
    tie: Sequence[str] = (),
    cell: str | None = CELL,
) -> DataFrame:
    """Label rows train / val / test by their rank in time; never shuffled.

    Boundaries are ``int(n * train)`` and ``int(n * (train + val))``.
    """
    ranked = with_position(df, keys, ts, tie=tie, cell=cell, name="__pos", total="__n")
    first = F.floor(F.col("__n") * F.lit(train_ratio))
    second = F.floor(F.col("__n") * F.lit(train_ratio + val_ratio))
    label = F.when(F.col("__pos") < first, "train").when(F.col("__pos") < second, "val").otherwise("test")
    return ranked.withColumn("split", label).drop("__pos", "__n")


def split_integrity(df: DataFrame, *, keys: Sequence[str] = DEFAULT_KEYS, ts: str = "ts") -> DataFrame:
    """Strict time order between the splits, from the split bounds alone."""

    def edge(pick, name: str) -> Column:
        return pick(F.when(F.col("split") == name, F.col(ts)))

    return df.groupBy(*keys).agg(
        (edge(F.max, "train") < edge(F.min, "val")).alias("train_before_val"),
        (edge(F.max, "val") < edge(F.min, "test")).alias("val_before_test"),
        F.count_if(F.col("split") == "train").alias("n_train"),
        F.count_if(F.col("split") == "val").alias("n_val"),
        F.count_if(F.col("split") == "test").alias("n_test"),
    )


def year_chunks(df: DataFrame, date: str) -> DataFrame:
    """Calendar-year work list covering the date range of a table: ``[chunk_start, chunk_end]``.

    A range whose last chunk would start on its end date is not extended by it.
    """
    bounds = df.agg(F.min(F.to_date(date)).alias("lo"), F.max(F.to_date(date)).alias("hi"))
    years = bounds.select("lo", "hi", F.explode(F.sequence(F.year("lo"), F.year("hi"))).alias("y"))
    start = F.greatest(F.col("lo"), F.make_date(F.col("y"), F.lit(1), F.lit(1)))
    stop = F.least(F.col("hi"), F.make_date(F.col("y"), F.lit(12), F.lit(31)))
    return years.select(start.alias("chunk_start"), stop.alias("chunk_end"), "hi").filter(
        F.col("chunk_start") < F.col("hi")
    ).drop("hi")


def union_chunks(*chunks: DataFrame) -> DataFrame:
    """Bag union by column name; order is a property of windows, not of tables."""
    out = chunks[0]
    for chunk in chunks[1:]:
        out = out.unionByName(chunk)
    return out
