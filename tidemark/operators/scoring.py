"""Scoring of feature tables and of request tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAX_BATCH = 168
DEFAULT_RMSE = 1.5
# Upper bounds (seconds) of the latency histogram.
LATENCY_BUCKETS = (0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0)


def with_band(df: DataFrame, prediction: str = "predicted", width: float = 3.0) -> DataFrame:
    """Symmetric band ``lower`` / ``upper`` around a prediction column."""
    return df.withColumn("lower", F.col(prediction) - width).withColumn("upper", F.col(prediction) + width)


def manifest_columns(features: str, names: Sequence[str]) -> list[Column]:
    """Model inputs from a feature map: manifest order, absent -> 0.0, extras ignored."""
    return [F.coalesce(F.try_element_at(features, F.lit(n)), F.lit(0.0)).alias(n) for n in names]


def linear_prediction(weights: Mapping[str, float], intercept: float) -> Column:
    out = F.lit(float(intercept))
    for name, weight in weights.items():
        out = out + F.lit(float(weight)) * F.col(name)
    return out


def score_requests(
    requests: DataFrame,
    names: Sequence[str],
    predict,
    *,
    features: str = "features",
    test_rmse: float | None = None,
) -> DataFrame:
    """Score rows holding a feature map.

    ``predict`` is a column expression over the manifest columns or a fitted model with
    ``transform`` (its ``prediction`` column is used).  Results are rounded to three
    places; the band is two test errors wide.
    """
    keep = [c for c in requests.columns if c != features]
    wide = requests.select(*keep, *manifest_columns(features, names))
    if isinstance(predict, Column):
        scored = wide.withColumn("__p", predict)
    else:
        scored = predict.transform(wide).withColumn("__p", F.col("prediction"))
    margin = F.lit(2.0 * (DEFAULT_RMSE if test_rmse is None else test_rmse))
    p = F.col("__p")
    return scored.select(
        *keep,
        F.round(p, 3).alias("predicted"),
        F.round(p - margin, 3).alias("lower"),
        F.round(p + margin, 3).alias("upper"),
    )


def check_requests(requests: DataFrame, *, time: str = "datetime_utc", payload: str = "payload") -> DataFrame:
    """Parse raw requests: ``ts``, ``features`` and ``valid`` (readable time, numeric map)."""
    parsed = requests.withColumn("ts", F.expr(f"try_to_timestamp({time})").cast("timestamp_ntz")).withColumn(
        "features", F.from_json(payload, "map<string,double>", {"mode": "PERMISSIVE"})
    )
    return parsed.withColumn("valid", F.col("ts").isNotNull() & F.col("features").isNotNull())


def collect_batches(rows: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str], limit: int = MAX_BATCH) -> DataFrame:
    """Requests per key as arrays of at most ``limit``; longer ones continue in further batches.

    Rows are dealt to batches by their number in ``order``, so no list outgrows the limit.
    """
    number = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1
    dealt = rows.withColumn("batch_no", F.floor(number / F.lit(limit)))
    return dealt.groupBy(*keys, "batch_no").agg(F.collect_list(F.struct(*columns)).alias("requests"))


def explode_batches(batches: DataFrame, requests: str = "requests") -> tuple[DataFrame, DataFrame]:
    """Requests of the batches holding 1..168 of them, and the rejected batches."""
    good = F.size(requests).between(1, MAX_BATCH)
    rest = [c for c in batches.columns if c != requests]
    accepted = batches.filter(good).select(*rest, F.posexplode(requests).alias("request_no", "request"))
    return accepted, batches.filter(~F.coalesce(good, F.lit(False)))


def request_counts(log: DataFrame) -> DataFrame:
    """Requests by endpoint and status."""
    return log.groupBy("endpoint", "status").agg(F.count("*").alias("n_requests"))


def latency_histogram(log: DataFrame, seconds: str, *, keys: Sequence[str] = ("endpoint",)) -> DataFrame:
    """Cumulative latency buckets (``le`` inclusive, +Inf last) in one aggregate."""
    wide = log.groupBy(*keys).agg(
        F.count(seconds).alias("all"),
        *[F.count_if(F.col(seconds) <= b).alias(f"b{i}") for i, b in enumerate(LATENCY_BUCKETS)],
    )
    rows = [F.struct(F.lit(str(b)).alias("le"), F.col(f"b{i}").alias("n")) for i, b in enumerate(LATENCY_BUCKETS)]
    rows.append(F.struct(F.lit("+Inf").alias("le"), F.col("all").alias("n")))
    return wide.select(*keys, F.inline(F.array(*rows)))
