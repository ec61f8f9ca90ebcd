"""Structured Streaming counterparts of ingest, resampling, metrics, scoring and drift.

Watermarks need the zoned timestamp type, so streams carry ``TIMESTAMP`` in a UTC session;
sinks cast back to ``TIMESTAMP_NTZ``.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.metrics import EPS
from tidemark.operators.blocks import CELL_ROWS, DEFAULT_KEYS, halo, micros, null_safe_join, seconds, spread_join
from tidemark.operators.eda import bin_index
from tidemark.operators.features import _label, add_ewm, ewm_sums, lag_columns
from tidemark.session import new_dir


def read_stream(spark: SparkSession, path: str, schema, *, glob: str | None = None, fmt: str = "parquet") -> DataFrame:
    reader = spark.readStream.schema(schema).format(fmt)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path)


def watermarked(df: DataFrame, ts: str = "ts", delay: str = "2 days") -> DataFrame:
    return df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)


def deduplicated(df: DataFrame, *, keys: Sequence[str] = DEFAULT_KEYS, ts: str = "ts", delay: str = "2 days") -> DataFrame:
    """Rows once per (series, time) within the watermark."""
    return watermarked(df, ts, delay).dropDuplicatesWithinWatermark([*keys, ts])


def resample(
    df: DataFrame, width: str, aggs: dict, *, keys: Sequence[str] = DEFAULT_KEYS, ts: str = "ts", delay: str = "2 days"
) -> DataFrame:
    """Tumbling aggregate, emitted when the watermark passes the window."""
    grouped = watermarked(df, ts, delay).groupBy(*keys, F.window(ts, width).alias("w"))
    return grouped.agg(*[e.alias(n) for n, e in aggs.items()]).select(
        *keys, F.col("w.start").cast("timestamp_ntz").alias(ts), *aggs
    )


def live_metrics(
    df: DataFrame, *, width: str = "72 hours", slide: str = "1 hour", keys: Sequence[str] = DEFAULT_KEYS,
    ts: str = "ts", delay: str = "1 hour",
) -> DataFrame:
    """Sliding rmse, mae, mape and bias of scored rows.

    Rows are first summed per slide; only those sums are repeated into the overlapping
    windows (72 copies of an hourly row, not of every event).
    """
    err = F.col("predicted") - F.col("actual")
    rows = watermarked(df.dropna(subset=["predicted", "actual"]), ts, delay)
    hourly = rows.groupBy(*keys, F.window(ts, slide).alias("h")).agg(
        F.count("*").alias("n"), F.sum(err).alias("e"), F.sum(err * err).alias("ee"), F.sum(F.abs(err)).alias("ae"),
        F.sum(F.abs(err) / (F.abs("actual") + EPS)).alias("pe"),
    )
    wide = hourly.groupBy(*keys, F.window(F.window_time("h"), width, slide).alias("w")).agg(
        *[F.sum(c).alias(c) for c in ("n", "e", "ee", "ae", "pe")]
    )
    n = F.col("n")
    return wide.select(
        *keys, F.col("w.start").cast("timestamp_ntz").alias("window_start"),
        F.col("w.end").cast("timestamp_ntz").alias("window_end"), "n",
        F.sqrt(F.col("ee") / n).alias("rmse"), (F.col("ae") / n).alias("mae"),
        (F.col("pe") / n * 100.0).alias("mape"), (F.col("e") / n).alias("bias"),
    )


def match_truth(
    predictions: DataFrame, actuals: DataFrame, *, keys: Sequence[str] = DEFAULT_KEYS, horizon_hours: int = 24,
    slack_hours: int = 1, delay: str = "2 days",
) -> DataFrame:
    """Stream-stream join of predictions with the truth arriving ``horizon`` later."""
    p = watermarked(predictions, "ts", delay).alias("p")
    a = watermarked(actuals.withColumnRenamed("ts", "actual_ts"), "actual_ts", delay).alias("a")
    cond = F.col("a.actual_ts").between(
        F.col("p.ts") + F.expr(f"INTERVAL {horizon_hours - slack_hours} HOURS"),
        F.col("p.ts") + F.expr(f"INTERVAL {horizon_hours + slack_hours} HOURS"),
    )
    for k in keys:
        cond = cond & (F.col(f"p.{k}") == F.col(f"a.{k}"))
    return p.join(a, cond, "inner").select(
        *[F.col(f"p.{k}") for k in keys], F.col("p.ts").cast("timestamp_ntz").alias("ts"), "p.predicted",
        F.col("a.actual_ts").cast("timestamp_ntz").alias("actual_ts"), "a.actual",
    )


def drift_counts(
    df: DataFrame, column: str, low: float, high: float, *, bins: int = 10, width: str = "1 day", ts: str = "ts",
    keys: Sequence[str] = (), delay: str = "1 hour",
) -> DataFrame:
    """Counts per window and fixed reference bin; the index is computed over these counts."""
    rows = watermarked(df, ts, delay).withColumn("bin", bin_index(F.col(column), F.lit(low), F.lit(high), bins))
    return rows.groupBy(*keys, F.window(ts, width).alias("w"), "bin").agg(F.count("*").alias("c")).select(
        *keys, F.col("w.start").cast("timestamp_ntz").alias(ts), "bin", "c"
    )


#: Rows of one range of a sorted batch.
RANGE_ROWS = 2 * CELL_ROWS


def _kept(df: DataFrame, path: str) -> DataFrame:
    """``df`` as a table: computed once, and of a known size to the joins that read it."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _in_order(rows: DataFrame, order: Sequence[str], count: int, folder: str, spark: SparkSession) -> DataFrame:
    """Rows written sorted, in ranges of about ``RANGE_ROWS``, and read back with their place ``__pos`` in the order.

    Ranges are cut by all columns of the order, so a long series or one tied time is many tasks.
    """
    parts = max(1, math.ceil(count / RANGE_ROWS))
    ordered = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    ordered.withColumn("__at", F.monotonically_increasing_id()).write.mode("overwrite").parquet(f"{folder}/ready")
    placed = spark.read.parquet(f"{folder}/ready").withColumn("__part", F.shiftright("__at", 33))
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("__n").over(earlier), F.lit(0)) - F.shiftleft("__part", 33)
    starts = placed.groupBy("__part").agg(F.count("*").alias("__n")).select("__part", shift.alias("__shift"))
    # broadcast: one row per range
    placed = placed.join(F.broadcast(_kept(starts, f"{folder}/starts")), "__part")
    return placed.withColumn("__pos", F.col("__at") + F.col("__shift")).drop("__at", "__part", "__shift")


def online_features(
    df: DataFrame, column: str, path: str, checkpoint: str, *, keys: Sequence[str] = DEFAULT_KEYS, ts: str = "ts",
    tie: Sequence[str] = (), lags: Sequence[int] = (1, 24, 168), windows: Sequence[int] = (6, 24),
    spans: Sequence[int] = (6, 24, 168), delay: str = "1 hour",
):
    """Lag, rolling and exponentially weighted features per series in event-time order.

    Rows wait until they lie ``delay`` behind the newest time of all series, are then taken in the
    order of time, ``tie`` and value, and leave once with their features, into one folder of ``path``
    per batch; a replayed batch overwrites its own.  Rows that arrive behind the mark of the batch
    before are dropped, rows without a time too; NaN counts as missing.

    State is tables below ``checkpoint``: the waiting rows, and per series its newest values (as far
    as the longest lag or window looks back) and its weighted sums.  A batch is sorted over ranges and
    worked on in blocks of positions, so neither it nor a series has to fit into a task.
    """
    keys, spark = list(keys), df.sparkSession
    folder = f"{checkpoint}/features"
    keep = max(1, *lags, *[w - 1 for w in windows])
    order = [*keys, *dict.fromkeys([ts, *tie, column])]
    parts = [f"{part}_{s}" for s in spans for part in ("n", "d")]
    value = F.col(column).cast("double")
    number = F.when(~F.isnan(value), value).alias(column)
    source = df.select(*[number if c == column else F.col(ts).cast("timestamp_ntz").alias(ts) if c == ts else c for c in order])

    def features(new: DataFrame, context: DataFrame | None, sums: DataFrame | None) -> DataFrame:
        rows = new
        if spans:
            rows = add_ewm(rows, column, spans, keys=keys, ts=ts, pos="__pos", sums=sums)
            rows = rows.withColumnsRenamed({f"{column}_ewm_{_label(s)}": f"{column}_ewm_{s}h" for s in spans})
        if context is not None:
            rows = rows.unionByName(context, allowMissingColumns=True)
        b = halo(rows, keys, ts, before=keep, pos="__pos")
        means = [
            F.when(F.count(column).over(f) >= max(1, w // 4), F.avg(column).over(f)).alias(f"{column}_roll_mean_{w}h")
            for w, f in ((w, b.frame(1 - w, 0)) for w in windows)
        ]
        out = b.close(b.df.select("*", *lag_columns(b, column, lags), *means)).filter("__new")
        names = [f"{column}_lag_{k}h" for k in lags] + [f"{column}_roll_mean_{w}h" for w in windows]
        return out.select(*keys, ts, column, *names, *[f"{column}_ewm_{s}h" for s in spans])

    def carried(new: DataFrame, context: DataFrame | None, sums: DataFrame | None, ends: DataFrame) -> DataFrame:
        rows = new if context is None else new.unionByName(context)
        tail = spread_join(rows.select(*keys, column, "__pos"), ends.select(*keys, "__last"), keys)
        tail = tail.withColumn("__back", F.col("__last") - F.col("__pos")).filter(F.col("__back") < keep)
        newest = F.sort_array(F.collect_list(F.struct("__back", column)))
        out = tail.groupBy(*keys).agg(F.transform(newest, lambda r: r[column]).alias("recent"))
        if sums is not None:
            done = sums.filter("end IS NOT NULL").groupBy(*keys).agg(F.max_by("end", "__blk").alias("end"))
            age = (F.col("__last") - F.col("end.ref")).alias("age")
            done = null_safe_join(done, ends, keys).select(*keys, age, *[F.col(f"end.{c}").alias(c) for c in parts])
            out = null_safe_join(out, done, keys, "left")
        return out

    def one(batch: DataFrame, batch_id: int) -> None:
        was, here = (f"{folder}/{i % 2}" for i in (batch_id - 1, batch_id))
        batch, mark, known = batch.filter(F.col(ts).isNotNull()), None, None
        if batch_id:
            mark, known = spark.read.parquet(f"{was}/mark").first()["mark"], spark.read.parquet(f"{was}/carry")
            if mark is not None:
                batch = batch.filter(micros(ts) > mark)
            batch = batch.unionByName(batch.sparkSession.read.schema(batch.schema).parquet(f"{was}/waiting"))
        count, top = batch.agg(F.count("*"), F.max(micros(ts))).first()
        if top is not None:
            reached = top // 1000 * 1000 - seconds(delay) * 1_000_000  # whole milliseconds, as watermarks are
            mark = reached if mark is None else max(mark, reached)
        ready = F.lit(False) if mark is None else micros(ts) <= mark
        batch.filter(~ready).write.mode("overwrite").parquet(f"{here}/waiting")

        rows = _in_order(batch.filter(ready), order, count, folder, spark)
        new = rows.select(*keys, ts, column, "__pos", F.lit(True).alias("__new"))
        ends = new.groupBy(*keys).agg(F.min("__pos").alias("__first"), F.max("__pos").alias("__last"))
        ends = _kept(ends, f"{folder}/ends")
        context = start = sums = None
        if known is not None:
            again = null_safe_join(known, ends, keys)
            context = again.select(*keys, "__first", F.posexplode("recent").alias("__i", column)).select(
                *keys, F.lit(None).cast("timestamp_ntz").alias(ts), column,
                (F.col("__first") - 1 - F.col("__i")).alias("__pos"), F.lit(False).alias("__new"),
            )
            if spans:
                ref = (F.col("__first") - 1 - F.col("age")).alias("ref")
                start = again.filter("age IS NOT NULL").select(*keys, ref, *parts)
        if spans:
            sums = _kept(ewm_sums(new, column, spans, keys=keys, pos="__pos", start=start), f"{folder}/sums")
        features(new, context, sums).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        carry = carried(new, context, sums, ends)
        if known is not None:
            idle = null_safe_join(known, ends, keys, "left").filter("__last IS NULL")
            carry = carry.unionByName(idle.select(*carry.columns))
        carry.write.mode("overwrite").parquet(f"{here}/carry")
        spark.range(1).select(F.lit(mark).cast("bigint").alias("mark")).write.mode("overwrite").parquet(f"{here}/mark")

    return source.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def score_batches(df: DataFrame, score: Callable[[DataFrame], DataFrame], path: str, checkpoint: str):
    """Micro-batch scoring; a replayed batch overwrites its own folder."""

    def one(batch: DataFrame, batch_id: int) -> None:
        score(batch).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return df.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def run_available(df: DataFrame, path: str | None = None, checkpoint: str | None = None, mode: str = "append") -> DataFrame:
    """Drain what has arrived into a Parquet table and read it back."""
    spark = df.sparkSession
    path = path or new_dir(spark, "stream-out")
    checkpoint = checkpoint or new_dir(spark, "stream-state")
    job = (
        df.writeStream.format("parquet").outputMode(mode).option("path", path)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    job.awaitTermination()
    return spark.read.schema(df.schema).parquet(path)
