"""Streaming queries: the events table is drained once and the sink table returned."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import scoring
from tidemark.operators.drift import psi_from_counts
from tidemark.plans.registry import Tables, query, rounded
from tidemark.session import new_dir
from tidemark.streaming import streams


def event_stream(t: Tables) -> DataFrame:
    schema = t.events().schema
    return streams.read_stream(t.spark, t.sf_dir, schema, glob="events.parquet").withColumnRenamed("event_type", "series_id")


@query("SELECT event_type AS series_id, ts, event_id, value FROM events")
def q_stream_dedupe(t: Tables) -> DataFrame:
    e = event_stream(t).select("series_id", "ts", "event_id", "value")
    out = streams.run_available(streams.deduplicated(e.unionByName(e)))
    return out.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query("""SELECT event_type AS series_id, date_trunc('day', ts) AS ts, round(avg(value), 6) AS value, count(*) AS n FROM events
GROUP BY 1, 2 HAVING date_trunc('day', any_value(ts)) + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR""")
def q_stream_resample(t: Tables) -> DataFrame:
    daily = streams.resample(event_stream(t), "1 day", {"value": F.avg("value"), "n": F.count("*")}, delay="1 hour")
    return rounded(streams.run_available(daily), "value")


_MS = "date_trunc('milliseconds', (SELECT max(ts) FROM events))"


@query(f"""WITH e AS (SELECT event_type AS series_id, date_trunc('hour', ts) AS h, count(*) AS n, sum(50 - value) AS e, sum(pow(50 - value, 2)) AS ee, sum(abs(50 - value)) AS ae,
sum(abs(50 - value) / (abs(value) + 1e-8)) AS pe FROM events GROUP BY 1, 2),
x AS (SELECT *, unnest(generate_series(h - INTERVAL 71 HOUR, h, INTERVAL 1 HOUR)) AS window_start FROM e WHERE h + INTERVAL 1 HOUR <= {_MS} - INTERVAL 1 HOUR)
SELECT series_id, window_start, window_start + INTERVAL 72 HOUR AS window_end, sum(n)::BIGINT AS n, round(sqrt(sum(ee) / sum(n)) + 3e-9, 6) AS rmse, round(sum(ae) / sum(n) + 3e-9, 6) AS mae,
round(sum(pe) / sum(n) * 100 + 3e-9, 6) AS mape, round(sum(e) / sum(n) + 3e-9, 6) AS bias FROM x GROUP BY 1, 2 HAVING window_start + INTERVAL 72 HOUR <= {_MS} - INTERVAL 1 HOUR""")
def q_stream_live_metrics(t: Tables) -> DataFrame:
    scored = event_stream(t).select("series_id", "ts", F.lit(50.0).alias("predicted"), F.col("value").alias("actual"))
    return rounded(streams.run_available(streams.live_metrics(scored)), "rmse", "mae", "mape", "bias", nudge=True)


@query("""SELECT p.user_id, p.ts, p.value AS predicted, a.ts AS actual_ts, a.value AS actual FROM events p JOIN events a ON a.user_id = p.user_id
AND a.ts BETWEEN p.ts + INTERVAL 23 HOUR AND p.ts + INTERVAL 25 HOUR WHERE p.event_type = 'view' AND a.event_type = 'purchase'""")
def q_stream_match_truth(t: Tables) -> DataFrame:
    e = event_stream(t)
    predictions = e.filter("series_id = 'view'").select("user_id", "ts", F.col("value").alias("predicted"))
    actuals = e.filter("series_id = 'purchase'").select("user_id", "ts", F.col("value").alias("actual"))
    return streams.run_available(streams.match_truth(predictions, actuals, keys=["user_id"]))


@query(f"""WITH n AS (SELECT event_type AS series_id, ts, value, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS rn FROM events),
f AS (SELECT series_id, ts, value, lag(value, 1) OVER w AS value_lag_1h, lag(value, 24) OVER w AS value_lag_24h,
CASE WHEN count(value) OVER (PARTITION BY series_id ORDER BY rn ROWS BETWEEN 23 PRECEDING AND CURRENT ROW) >= 6 THEN avg(value) OVER (PARTITION BY series_id ORDER BY rn ROWS BETWEEN 23 PRECEDING AND CURRENT ROW) END AS m24 FROM n WINDOW w AS (PARTITION BY series_id ORDER BY rn))
SELECT series_id, ts, value, value_lag_1h, value_lag_24h, round(m24 + 3e-9, 6) AS value_roll_mean_24h FROM f WHERE ts <= {_MS} - INTERVAL 1 HOUR""")
def q_stream_features(t: Tables) -> DataFrame:
    path, state = new_dir(t.spark, "features"), new_dir(t.spark, "features-state")
    job = streams.online_features(event_stream(t), "value", path, state, tie=["event_id"], lags=(1, 24), windows=(24,), spans=(6,))
    job.awaitTermination()
    out = t.spark.read.parquet(path).drop("batch_id", "value_ewm_6h")
    return rounded(out, "value_roll_mean_24h", nudge=True)


@query("""SELECT event_id, round(1.5::DOUBLE + 0.25::DOUBLE * coalesce((json_extract(props, '$.k'))::DOUBLE, 0.0), 3) AS predicted FROM events""")
def q_stream_score(t: Tables) -> DataFrame:
    path, state = new_dir(t.spark, "scored"), new_dir(t.spark, "scored-state")
    names = ["k"]
    model = scoring.linear_prediction({"k": 0.25}, 1.5)

    def score(batch: DataFrame) -> DataFrame:
        rows = batch.select("event_id", F.from_json("props", "map<string,double>").alias("features"))
        return scoring.score_requests(rows, names, model)

    streams.score_batches(event_stream(t), score, path, state).awaitTermination()
    return t.spark.read.parquet(path).select("event_id", "predicted")


_BIN = "least(9, greatest(0, floor(value / 50.0))) AS bin"


@query(f"""WITH r AS (SELECT {_BIN}, count(*) AS r FROM events GROUP BY 1), c AS (SELECT date_trunc('day', ts) AS ts, {_BIN}, count(*) AS c FROM events GROUP BY 1, 2),
d AS (SELECT DISTINCT ts FROM c WHERE ts + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR),
j AS (SELECT d.ts, r.bin, r.r, coalesce(c.c, 0) AS c, sum(r.r) OVER (PARTITION BY d.ts) AS nr, sum(coalesce(c.c, 0)) OVER (PARTITION BY d.ts) AS nc FROM d, r LEFT JOIN c ON c.ts = d.ts AND c.bin = r.bin),
s AS (SELECT *, CASE WHEN r = 0 THEN 1e-6 ELSE r / (nr + 1e-10) END AS a, CASE WHEN c = 0 THEN 1e-6 ELSE c / (nc + 1e-10) END AS b FROM j)
SELECT ts, any_value(nc)::BIGINT AS n_cur, round(sum((b - a) * ln(b / a)), 6) AS psi FROM s GROUP BY 1""")
def q_stream_drift(t: Tables) -> DataFrame:
    counts = streams.run_available(streams.drift_counts(event_stream(t), "value", 0.0, 500.0))
    from tidemark.operators.eda import bin_index

    ref = t.events().groupBy(bin_index(F.col("value"), F.lit(0.0), F.lit(500.0), 10).alias("bin")).agg(F.count("*").alias("r"))
    # ten reference bins per day: give every day all bins, so that empty ones count
    days = counts.groupBy("ts").agg(F.collect_list(F.struct("bin", "c")).alias("have"))
    bins = ref.agg(F.collect_list(F.struct("bin", "r")).alias("ref")).select("ref").scalar()
    full = days.withColumn("ref", bins).select("ts", "have", F.inline("ref"))
    c = F.filter("have", lambda h: h["bin"] == F.col("bin"))
    joined = full.withColumn("c", F.coalesce(F.try_element_at(c, F.lit(1))["c"], F.lit(0)))
    return rounded(psi_from_counts(joined, ["ts"]).select("ts", "n_cur", "psi"), "psi")
