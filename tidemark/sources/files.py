"""Readers and writers for measurements, market bars, predictions, reports and models."""

from __future__ import annotations

import json
import re
import warnings
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.boosting import BoostedModel


def read_table(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Parquet scan; a given schema skips footer inference."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path)


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    """Snappy Parquet, optionally partitioned (one writer task per partition value set)."""
    writer = df.write.mode(mode).option("compression", "snappy")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def hourly_schema(variables: Sequence[str], keys: Sequence[str] = ()) -> str:
    arrays = ", ".join(["time: array<string>", *[f"`{v}`: array<double>" for v in variables]])
    return ", ".join([*[f"`{k}` string" for k in keys], f"hourly struct<{arrays}>"])


def parse_hourly(
    documents: DataFrame, variables: Sequence[str], *, prefix: str = "meteo_", keys: Sequence[str] = (), ts: str = "ts"
) -> tuple[DataFrame, DataFrame]:
    """Column-oriented documents -> rows, and the documents without any hours.

    Works on batch and streaming input: one ``inline`` over the zipped arrays.
    """
    empty = F.coalesce(F.size("hourly.time"), F.lit(0)) <= 0
    zipped = F.arrays_zip(F.col("hourly.time").alias("time"), *[F.col(f"hourly.{v}").alias(v) for v in variables])
    rows = documents.filter(~empty).select(*keys, F.inline(zipped))
    parsed = rows.select(
        *keys, F.to_timestamp_ntz("time").alias(ts), *[F.nanvl(v, F.lit(None).cast("double")).alias(f"{prefix}{v}") for v in variables]
    )
    return parsed, documents.filter(empty)


def read_hourly_json(
    spark: SparkSession, path: str, variables: Sequence[str], *, prefix: str = "meteo_", keys: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    documents = spark.read.schema(hourly_schema(variables, keys)).json(path)
    return parse_hourly(documents, variables, prefix=prefix, keys=keys)


def clean_ticker(ticker: Column) -> Column:
    """Column-safe ticker: no caret, dots to underscores, lower case."""
    return F.lower(F.translate(F.replace(ticker, F.lit("^"), F.lit("")), ".", "_"))


BAR_FIELDS = ("open", "high", "low", "close", "volume")


def read_market_csv(spark: SparkSession, path: str, *, ts: str = "ts") -> DataFrame:
    """Daily bars in long form; rows without a ticker are skipped, field names are lower case."""
    schema = "ticker string, ts timestamp_ntz, " + ", ".join(f"{f} double" for f in BAR_FIELDS)
    bars = spark.read.schema(schema).option("header", True).csv(path)
    ticker = clean_ticker(F.trim("ticker"))
    return bars.filter(F.length(F.coalesce(F.trim("ticker"), F.lit(""))) > 0).select(
        ticker.alias("ticker"), F.col("ts").alias(ts), *BAR_FIELDS
    )


def latest_predictions(spark: SparkSession, path: str, files: int = 7, *, skip_unreadable: bool = False) -> DataFrame:
    """Rows of the ``files`` newest batches written by :func:`write_predictions`.

    Batches are told apart by their partition column ``file``; older ones are not read.
    ``file_no`` is 0 for the oldest batch kept.  An unreadable batch is an error, or with
    ``skip_unreadable`` is left out with a warning that names it.
    """
    stored = spark.read.parquet(path)
    names = sorted({m[1] for f in stored.inputFiles() if (m := re.search(r"/file=([^/]+)/", f))})[-files:]
    places = {n: f"{path.rstrip('/')}/file={n}" for n in names}
    if skip_unreadable:
        for name, place in list(places.items()):
            try:
                spark.read.schema(stored.drop("file").schema).parquet(place).write.format("noop").mode("overwrite").save()
            except (PySparkException, Py4JJavaError) as error:
                warnings.warn(f"prediction batch {name} cannot be read: {str(error)[:200]}", stacklevel=2)
                del places[name]
    rows = spark.read.option("basePath", path).schema(stored.schema).parquet(*places.values()) if places else stored.limit(0)
    number = F.array_position(F.array(*[F.lit(n) for n in places]) if places else F.array(F.lit("")), F.col("file").cast("string")) - 1
    return rows.withColumn("file_no", number.cast("int"))


def write_predictions(df: DataFrame, path: str, *, stamp: str = "file") -> None:
    """One folder per batch name, so a reader can pick batches from the listing."""
    df.write.mode("overwrite").partitionBy(stamp).parquet(path)


def write_report(report: DataFrame, path: str) -> None:
    """Append a report (one JSON object per row) with its time."""
    report.withColumn("run_ts", F.current_timestamp()).write.mode("append").json(path)


def write_text(lines: DataFrame, path: str, *, order: str = "line_no", line: str = "line") -> None:
    """Text exposition: a handful of lines, written in order as one file."""
    lines.orderBy(order).select(line).coalesce(1).write.mode("overwrite").text(path)


def save_model(model: PipelineModel | BoostedModel, metadata: dict, path: str, spark: SparkSession) -> None:
    """Model folder plus one JSON row (parameters, metrics, feature names, horizon)."""
    if isinstance(model, BoostedModel):
        model.save(spark, f"{path}/model")
        metadata = {**metadata, "learner": "boosted"}
    else:
        model.write().overwrite().save(f"{path}/model")
    spark.createDataFrame([(json.dumps(metadata),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/metadata")


def load_model(path: str, spark: SparkSession, fallback: str | None = None) -> tuple[PipelineModel | BoostedModel, dict]:
    """Load a bundle; where the first place has none, the fallback is tried.  A broken bundle is an error."""
    for place in (path, fallback):
        if place is None:
            continue
        try:
            metadata = json.loads(spark.read.text(f"{place}/metadata").first().value)
        except AnalysisException as exc:
            if exc.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        kind = BoostedModel.load if metadata.pop("learner", None) == "boosted" else lambda _, folder: PipelineModel.load(folder)
        return kind(spark, f"{place}/model"), metadata
    raise FileNotFoundError(path)


def load_baseline(spark: SparkSession, path: str, metrics: Sequence[str] = ("rmse", "mae", "mape", "r2")) -> DataFrame:
    """One row with the test metrics stored with a model by :func:`save_model`; absent ones are null."""
    stored = json.loads(spark.read.text(f"{path}/metadata").first().value).get("metrics") or {}
    row = [None if stored.get(m) is None else float(stored[m]) for m in metrics]
    return spark.createDataFrame([row], ", ".join(f"{m} double" for m in metrics))


def log_run(spark: SparkSession, path: str, run_id: str, params: dict, metrics: dict) -> None:
    """Append one experiment row."""
    row = [(run_id, {k: str(v) for k, v in params.items()}, {k: float(v) for k, v in metrics.items()})]
    df = spark.createDataFrame(row, "run_id string, params map<string,string>, metrics map<string,double>")
    df.withColumn("run_ts", F.current_timestamp()).write.mode("append").parquet(path)


def best_logged_run(spark: SparkSession, path: str, metric: str = "rmse") -> DataFrame:
    runs = spark.read.parquet(path).withColumn("__m", F.try_element_at("metrics", F.lit(metric)))
    return runs.filter(F.col("__m").isNotNull()).agg(
        F.min_by(F.struct("run_id", "params", "metrics", "run_ts"), "__m").alias("r")
    ).select("r.*")


def load_splits(spark: SparkSession, path: str) -> DataFrame:
    """Feature table partitioned by ``split``; all three parts must be there."""
    table = spark.read.parquet(path)
    found = {m[1] for f in table.inputFiles() if (m := re.search(r"/split=([^/]+)/", f))}
    missing = {"train", "val", "test"} - found
    if missing:
        raise FileNotFoundError(f"missing splits: {sorted(missing)}")
    return table
