"""Queries over the file sources: files are written from the tables and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.timeindex import dedupe
from tidemark.plans.registry import Tables, query, rounded, with_cte
from tidemark.session import new_dir
from tidemark.sources import files


@query(with_cte("h") + "SELECT series_id, ts, round(value, 6) AS meteo_value FROM h")
def q_json_ingest(t: Tables) -> DataFrame:
    # one column-oriented document per series and day, as a collector would land them
    day = F.date_trunc("day", "ts")
    hours = F.array_sort(F.collect_list(F.struct(F.date_format("ts", "yyyy-MM-dd'T'HH:mm").alias("time"), "value")))
    documents = t.hourly().groupBy("series_id", day.alias("d")).agg(hours.alias("h")).select(
        "series_id", F.struct(F.col("h.time").alias("time"), F.col("h.value").alias("value")).alias("hourly")
    )
    path = new_dir(t.spark, "hourly-json")
    documents.write.json(path)
    rows, _ = files.read_hourly_json(t.spark, path, ["value"], keys=["series_id"])
    return rounded(rows, "meteo_value")


@query(with_cte("d") + "SELECT ticker || '_pa' AS ticker, ts, open, high, low, close, volume FROM d")
def q_market_ingest(t: Tables) -> DataFrame:
    path = new_dir(t.spark, "bars-csv")
    bars = t.bars().select(F.concat(F.lit("^"), F.upper("ticker"), F.lit(".PA")).alias("ticker"), "ts", *files.BAR_FIELDS)
    bars.write.option("header", True).csv(path)
    return files.read_market_csv(t.spark, path)


@query(with_cte("h", "g", more="nv AS (SELECT series_id, ts, lag(value, 24) OVER (PARTITION BY series_id ORDER BY ts) AS predicted FROM g)") + """,
pr AS (SELECT *, strftime(ts, '%Y%m%d') AS stamp FROM nv WHERE predicted IS NOT NULL),
k AS (SELECT stamp, dense_rank() OVER (ORDER BY stamp DESC) AS r FROM (SELECT DISTINCT stamp FROM pr))
SELECT series_id, ts, round(predicted, 6) AS predicted, 'predictions_' || pr.stamp AS file FROM pr JOIN k ON k.stamp = pr.stamp WHERE r <= 7""")
def q_latest_files(t: Tables) -> DataFrame:
    from tidemark.plans.forecast_queries import naive

    path = new_dir(t.spark, "predictions")
    stamp = F.concat(F.lit("predictions_"), F.date_format("ts", "yyyyMMdd"))
    files.write_predictions(naive(t).dropna(subset=["predicted"]).select("series_id", "ts", "predicted", stamp.alias("file")), path)
    rows = files.latest_predictions(t.spark, path)
    latest = dedupe(rows, order=["file_no"], keep="last")
    return rounded(latest.select("series_id", "ts", "predicted", "file"), "predicted")
