"""Queries over baselines, metrics, drift, monitoring and scoring."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.metrics import regression_metrics
from tidemark.operators import baselines, clean, drift, eda, features, monitor, quality, scoring
from tidemark.operators import timeindex as ti
from tidemark.plans.registry import CTE, Tables, query, rounded, with_cte
from tidemark.session import cut

_M = ("rmse", "mae", "mape", "smape", "r2")


def _metric_sql(y: str = "actual", p: str = "predicted") -> str:
    both = f"FILTER ({y} IS NOT NULL AND {p} IS NOT NULL)"
    return f"""round(sqrt(avg(pow({y} - {p}, 2)) {both}), 6) AS rmse, round(avg(abs({y} - {p})) {both}, 6) AS mae,
round(avg(abs({y} - {p}) / (abs({y}) + 1e-8)) {both} * 100, 6) AS mape,
round(avg(2 * abs({y} - {p}) / (abs({y}) + abs({p}) + 1e-8)) {both} * 100, 6) AS smape,
round(1 - sum(pow({y} - {p}, 2)) {both} / (var_pop({y}) {both} * count(*) {both} + 1e-8), 6) AS r2, count(*) {both} AS n"""


_NAIVE = "nv AS (SELECT series_id, ts, value AS actual, lag(value, 24) OVER (PARTITION BY series_id ORDER BY ts) AS predicted FROM g)"


def naive(t: Tables) -> DataFrame:
    rows = baselines.seasonal_naive(t.grid(), "value", 24, step="1 hour")
    return rows.select("series_id", "ts", "actual", "predicted")


@query(with_cte("h", "g", more=_NAIVE) + "SELECT series_id, ts, round(actual, 6) AS actual, round(predicted, 6) AS predicted FROM nv")
def q_naive(t: Tables) -> DataFrame:
    return rounded(naive(t), "actual", "predicted")


@query(with_cte("h", "g", more=_NAIVE) + f"SELECT series_id, {_metric_sql()} FROM nv GROUP BY 1")
def q_metrics(t: Tables) -> DataFrame:
    return rounded(regression_metrics(naive(t), keys=["series_id"]), *_M)


_SPLIT = """sp AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY ts) - 1 AS pos, count(*) OVER (PARTITION BY series_id) AS n FROM h),
sl AS (SELECT *, CASE WHEN pos < floor(n * 0.8::DOUBLE) THEN 'train' WHEN pos < floor(n * (0.8::DOUBLE + 0.1::DOUBLE)) THEN 'val' ELSE 'test' END AS split FROM sp),
mb AS (SELECT sl.series_id, ts, value AS actual, m AS predicted FROM sl JOIN (SELECT series_id, avg(value) AS m FROM sl WHERE split = 'train' GROUP BY 1) x ON x.series_id = sl.series_id WHERE split <> 'train')"""


@query(with_cte("h", more=_SPLIT) + f"SELECT series_id, {_metric_sql()} FROM mb GROUP BY 1")
def q_mean_baseline(t: Tables) -> DataFrame:
    scored = baselines.mean_baseline(ti.temporal_split(t.hourly()), "value")
    return rounded(regression_metrics(scored, keys=["series_id"]), *_M)


_COMPARE = f"""cm AS (SELECT 'seasonal_naive' AS model, {_metric_sql()} FROM nv UNION ALL SELECT 'mean', {_metric_sql()} FROM mb)"""


@query(with_cte("h", "g", more=",\n".join([_NAIVE, _SPLIT, _COMPARE])) + """SELECT *, round((SELECT rmse FROM cm WHERE model = 'seasonal_naive') * 0 + ((SELECT rmse FROM cm WHERE model = 'seasonal_naive') - rmse) / (SELECT rmse FROM cm WHERE model = 'seasonal_naive') * 100, 3) AS improvement_pct FROM cm""")
def q_compare(t: Tables) -> DataFrame:
    mean = baselines.mean_baseline(ti.temporal_split(t.hourly()), "value")
    out = baselines.compare({"seasonal_naive": naive(t), "mean": mean}, baseline="seasonal_naive")
    return rounded(rounded(out, *_M), "improvement_pct", digits=3)


_SUITE = f"""su AS (SELECT 'naive_1' AS model, series_id, {_metric_sql()} FROM (SELECT series_id, value AS actual, lag(value, 1) OVER (PARTITION BY series_id ORDER BY ts) AS predicted FROM g) GROUP BY 2
UNION ALL SELECT 'naive_24', series_id, {_metric_sql()} FROM (SELECT series_id, value AS actual, lag(value, 24) OVER (PARTITION BY series_id ORDER BY ts) AS predicted FROM g) GROUP BY 2
UNION ALL SELECT 'naive_168', series_id, {_metric_sql()} FROM (SELECT series_id, value AS actual, lag(value, 168) OVER (PARTITION BY series_id ORDER BY ts) AS predicted FROM g) GROUP BY 2)"""


@query(with_cte("h", "g", more=_SUITE) + "SELECT series_id, model, rmse, mae FROM su QUALIFY row_number() OVER (PARTITION BY series_id ORDER BY rmse, model) = 1")
def q_best_run(t: Tables) -> DataFrame:
    grid, runs = t.grid(), None
    for season in (1, 24, 168):
        scored = baselines.seasonal_naive(grid, "value", season, step="1 hour")
        row = regression_metrics(scored, keys=["series_id"]).withColumn("model", F.lit(f"naive_{season}"))
        runs = row if runs is None else runs.unionByName(row)
    best = baselines.best_run(rounded(runs, *_M), keys=["series_id"])
    return best.select("series_id", "model", "rmse", "mae")


_WF = f"""wp AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY ts) - 1 AS pos, count(*) OVER (PARTITION BY series_id) AS n FROM h),
wf AS (SELECT f, series_id, n, n // 6 AS sz, n - (5 - f) * (n // 6) AS st FROM (SELECT DISTINCT series_id, n FROM wp), (SELECT unnest(generate_series(0, 4)) AS f)),
wm AS (SELECT wf.series_id, f, avg(value) AS predicted FROM wf JOIN wp ON wp.series_id = wf.series_id AND pos < st - 24 GROUP BY 1, 2),
ws AS (SELECT wf.series_id, wf.f + 1 AS fold, value AS actual, wm.predicted FROM wf JOIN wp ON wp.series_id = wf.series_id AND pos >= st AND pos < st + sz JOIN wm ON wm.series_id = wf.series_id AND wm.f = wf.f),
wr AS (SELECT series_id, fold, {_metric_sql()} FROM ws GROUP BY 1, 2)"""


@query(with_cte("h", more=_WF) + "SELECT series_id, fold, rmse, mae, r2, n FROM wr")
def q_walk_forward(t: Tables) -> DataFrame:
    per_fold = baselines.walk_forward_metrics(baselines.walk_forward_mean(t.hourly(), "value"))
    return rounded(per_fold.select("series_id", "fold", "rmse", "mae", "r2", "n"), "rmse", "mae", "r2")


@query(with_cte("h", more=_WF) + """SELECT series_id, round(avg(rmse), 5) AS cv_rmse_mean, round(stddev_samp(rmse), 5) AS cv_rmse_std, round(avg(mae), 5) AS cv_mae_mean,
round(avg(r2), 5) AS cv_r2_mean, count(*) AS n_folds FROM wr GROUP BY 1""")
def q_walk_forward_summary(t: Tables) -> DataFrame:
    per_fold = rounded(baselines.walk_forward_metrics(baselines.walk_forward_mean(t.hourly(), "value")), *_M)
    out = baselines.walk_forward_summary(per_fold)
    return rounded(out, "cv_rmse_mean", "cv_rmse_std", "cv_mae_mean", "cv_r2_mean", digits=5)


@query(with_cte("h", "g", more=_NAIVE) + f"SELECT *, rmse <= 60 AND mape <= 1000 AND r2 >= -1 AS gate_passed FROM (SELECT series_id, {_metric_sql()} FROM nv GROUP BY 1)")
def q_gate(t: Tables) -> DataFrame:
    metrics = rounded(regression_metrics(naive(t), keys=["series_id"]), *_M)
    return quality.production_gate(metrics, max_rmse=60.0, max_mape=1000.0, min_r2=-1.0)


_RES = "rs AS (SELECT series_id, ts, actual - predicted AS resid FROM nv WHERE actual IS NOT NULL AND predicted IS NOT NULL)"


@query(with_cte("h", "g", more=_NAIVE + ",\n" + _RES) + """SELECT f.bin::BIGINT AS bin, round(lo + f.bin * (hi - lo) / 50, 5) AS bin_low, coalesce(c.n, 0) AS n
FROM (SELECT min(resid) AS lo, max(resid) AS hi, unnest(generate_series(0, 49)) AS bin FROM rs) f
LEFT JOIN (SELECT least(49, greatest(0, floor((resid - lo) / (hi - lo) * 50)))::BIGINT AS bin, count(*) AS n FROM rs, (SELECT min(resid) AS lo, max(resid) AS hi FROM rs) GROUP BY 1) c ON c.bin = f.bin""")
def q_residual_hist(t: Tables) -> DataFrame:
    resid = naive(t).dropna().select((F.col("actual") - F.col("predicted")).alias("resid"))
    return rounded(eda.histogram(resid, "resid", 50), "bin_low", digits=5).select("bin", "bin_low", "n")


_QQ = [i / 200 for i in range(201)]


@query(with_cte("h", "g", more=_NAIVE + ",\n" + _RES) + f"""SELECT i::INT AS i, round(-3 + 6 * i / 200.0, 6) AS theoretical, round(q[i + 1] + 3e-9, 6) AS residual
FROM (SELECT unnest(generate_series(0, 200)) AS i, (SELECT quantile_cont(resid, [{', '.join(f'{p}' for p in _QQ)}]) FROM rs) AS q)""")
def q_residual_qq(t: Tables) -> DataFrame:
    from tidemark.operators.quantiles import exact_quantiles

    resid = naive(t).dropna().select((F.col("actual") - F.col("predicted")).alias("resid"))
    q = exact_quantiles(resid, ["resid"], _QQ)
    rows = q.select(F.posexplode("q").alias("i", "residual"))
    return rows.select("i", F.round(-3 + 6 * F.col("i") / 200.0, 6).alias("theoretical"), F.round(F.col("residual") + 3e-9, 6).alias("residual"))


@query(with_cte("h", "g", more=_NAIVE) + """SELECT series_id, ts, round(actual, 6) AS actual, round(predicted, 6) AS predicted, round(predicted - 3, 6) AS lower, round(predicted + 3, 6) AS upper FROM nv
WHERE predicted IS NOT NULL QUALIFY row_number() OVER (PARTITION BY series_id ORDER BY ts DESC) <= 336""")
def q_band(t: Tables) -> DataFrame:
    rows = ti.tail_rows(naive(t).dropna(subset=["predicted"]), 336)
    return rounded(scoring.with_band(rows), "actual", "predicted", "lower", "upper")


# ---------------------------------------------------------------- drift

_DRIFT_COLS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
_SIDES = "rf AS (SELECT * FROM lineitem WHERE l_shipdate < TIMESTAMP '1999-01-01'), cu AS (SELECT * FROM lineitem WHERE l_shipdate >= TIMESTAMP '1999-01-01')"


def _psi_sql(c: str) -> str:
    side = lambda t: f"(SELECT bin, count(*) AS n FROM (SELECT least(9, greatest(0, floor(({c} - lo) / (hi - lo) * 10))) AS bin FROM {t}, (SELECT min({c}) AS lo, max({c}) AS hi FROM rf)) GROUP BY 1)"
    sh = lambda x, t: f"CASE WHEN coalesce({x}.n, 0) = 0 THEN 1e-6 ELSE {x}.n / ((SELECT count(*) FROM {t}) + 1e-10) END"
    return f"""SELECT '{c}' AS "column", (SELECT count(*) FROM rf) AS n_ref, (SELECT count(*) FROM cu) AS n_cur,
sum(({sh('y', 'cu')} - {sh('x', 'rf')}) * ln(({sh('y', 'cu')}) / ({sh('x', 'rf')}))) AS psi FROM {side('rf')} x FULL JOIN {side('cu')} y ON x.bin = y.bin"""


def _ks_sql(c: str) -> str:
    return f"""SELECT '{c}' AS "column", max(abs(fr - fc)) AS ks_stat FROM (SELECT sum(r) OVER w / (SELECT count(*) FROM rf) AS fr, sum(k) OVER w / (SELECT count(*) FROM cu) AS fc
FROM (SELECT {c} AS v, sum(r) AS r, sum(1 - r) AS k FROM (SELECT {c}, 1 AS r FROM rf UNION ALL SELECT {c}, 0 FROM cu) GROUP BY 1) WINDOW w AS (ORDER BY v))"""


_KS_P = "CASE WHEN t2 < 0.04 THEN 1.0 ELSE greatest(0.0, least(1.0, " + " + ".join(
    f"({2.0 if k % 2 else -2.0}) * exp({-2.0 * k * k} * t2)" for k in range(1, 21)) + ")) END"
_PSI = "ps AS (" + " UNION ALL ".join(_psi_sql(c) for c in _DRIFT_COLS) + ")"
_KS = "ks AS (" + " UNION ALL ".join(_ks_sql(c) for c in _DRIFT_COLS) + ")"
_KSP = f"""kp AS (SELECT "column", ks_stat, ({_KS_P})::DOUBLE AS ks_pvalue FROM (SELECT *, ks_stat * ks_stat * ((SELECT count(*) FROM rf)::DOUBLE * (SELECT count(*) FROM cu) / ((SELECT count(*) FROM rf) + (SELECT count(*) FROM cu))) AS t2 FROM ks))"""
_DRIFT = f"WITH {_SIDES},\n{_PSI},\n{_KS},\n{_KSP},\n" + """dr AS (SELECT ps.*, ks_stat, ks_pvalue, ks_pvalue < 0.05 OR psi > 0.25 AS drifted FROM ps JOIN kp ON kp."column" = ps."column")
"""


def sides(t: Tables) -> tuple[DataFrame, DataFrame]:
    rows = t.read("lineitem").select("l_shipdate", *_DRIFT_COLS)
    cut = F.lit("1999-01-01").cast("timestamp_ntz")
    return (
        rows.filter(F.col("l_shipdate") < cut).select(*_DRIFT_COLS),
        rows.filter(F.col("l_shipdate") >= cut).select(*_DRIFT_COLS),
    )


@query(f"WITH {_SIDES},\n{_PSI}\n" + 'SELECT "column", n_ref, n_cur, round(psi, 8) AS psi FROM ps')
def q_psi(t: Tables) -> DataFrame:
    return rounded(drift.psi(*sides(t), _DRIFT_COLS), "psi", digits=8)


@query(f"WITH {_SIDES},\n{_KS},\n{_KSP}\n" + 'SELECT "column", round(ks_stat, 8) AS ks_stat, round(ks_pvalue, 6) AS ks_pvalue FROM kp')
def q_ks(t: Tables) -> DataFrame:
    return rounded(rounded(drift.ks(*sides(t), _DRIFT_COLS), "ks_stat", digits=8), "ks_pvalue")


@query(_DRIFT + 'SELECT "column", n_ref, n_cur, round(psi, 6) AS psi, round(ks_stat, 6) AS ks_stat, round(ks_pvalue, 6) AS ks_pvalue, drifted FROM dr')
def q_drift_columns(t: Tables) -> DataFrame:
    return rounded(drift.column_drift(*sides(t)), "psi", "ks_stat", "ks_pvalue")


@query(_DRIFT + """SELECT count(*) FILTER (drifted) AS n_drifted, 4::BIGINT AS n_total, count(*) FILTER (drifted) / 4.0 AS share_drifted, count(*) FILTER (drifted) / 4.0 > 0.2 AS dataset_drift, count(*) FILTER (drifted) / 4.0 > 0.5 AS majority_drift,
CASE WHEN count(*) FILTER (drifted) / 4.0 > 0.2 THEN 'RETRAIN' ELSE 'MONITOR' END AS action_required FROM dr""")
def q_drift_summary(t: Tables) -> DataFrame:
    ref, cur = sides(t)
    return drift.drift_summary(drift.column_drift(ref, cur), len(drift.numeric_common(ref, cur)))


@query(f"WITH {_SIDES}\n" + " UNION ALL ".join(
    f"""SELECT '{n}' AS side, '{c}' AS "column", count(*) AS n_rows, avg(({c} IS NULL)::INT) AS null_share, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, min({c}) AS min, max({c}) AS max FROM {s}"""
    for s, n in (("rf", "reference"), ("cu", "current")) for c in _DRIFT_COLS))
def q_missing(t: Tables) -> DataFrame:
    return rounded(drift.quality_report(*sides(t), _DRIFT_COLS), "mean", "std", digits=4)


@query(with_cte("h", more=_SPLIT) + """SELECT series_id, ts, round(value, 6) AS value, 'reference' AS side FROM sl WHERE split = 'train' QUALIFY row_number() OVER (PARTITION BY series_id ORDER BY ts DESC) <= 720
UNION ALL SELECT series_id, ts, round(value, 6), 'current' FROM sl WHERE split = 'test' QUALIFY row_number() OVER (PARTITION BY series_id ORDER BY ts DESC) <= 168""")
def q_drift_windows(t: Tables) -> DataFrame:
    s = ti.temporal_split(t.hourly())
    ref, cur = drift.drift_windows(s.filter("split = 'train'"), s.filter("split = 'test'"))
    tag = lambda df, side: df.select("series_id", "ts", F.round("value", 6).alias("value"), F.lit(side).alias("side"))
    return tag(ref, "reference").unionByName(tag(cur, "current"))


# ---------------------------------------------------------------- live performance

_TRUTH = """lp AS (SELECT series_id, ts, predicted FROM nv WHERE predicted IS NOT NULL),
av AS (SELECT series_id, ts AS ats, actual FROM nv WHERE actual IS NOT NULL),
pb AS (SELECT lp.*, av.ats AS bt, av.actual AS ba FROM lp ASOF LEFT JOIN av ON lp.series_id = av.series_id AND lp.ts >= av.ats),
pa AS (SELECT pb.*, av.ats AS nt, av.actual AS na FROM pb ASOF LEFT JOIN av ON pb.series_id = av.series_id AND pb.ts <= av.ats),
lt AS (SELECT series_id, ts, predicted, CASE WHEN nt IS NULL OR (bt IS NOT NULL AND epoch_us(ts) - epoch_us(bt) < epoch_us(nt) - epoch_us(ts)) THEN ba ELSE na END AS actual FROM pa)"""
_LIVE = """lw AS (SELECT *, max(ts) OVER (PARTITION BY series_id) AS mx FROM lt WHERE actual IS NOT NULL AND predicted IS NOT NULL),
lm AS (SELECT series_id, round(sqrt(avg(pow(predicted - actual, 2))), 6) AS rmse, round(avg(abs(predicted - actual)), 6) AS mae, round(avg(abs(predicted - actual) / (abs(actual) + 1e-8)) * 100, 6) AS mape,
round(avg(predicted - actual), 6) AS bias, count(*) AS n_predictions, min(ts) AS window_start, max(ts) AS window_end FROM lw WHERE ts >= mx - INTERVAL 72 HOUR GROUP BY 1 HAVING count(*) >= 10)"""


def with_truth(t: Tables) -> DataFrame:
    scored = naive(t)
    predictions = scored.dropna(subset=["predicted"]).select("series_id", "ts", "predicted", F.lit(0).alias("file_no"))
    actuals = scored.dropna(subset=["actual"]).select("series_id", "ts", F.col("actual").alias("value"))
    return monitor.attach_truth(predictions, actuals, "value", order=["file_no"])


def live(t: Tables) -> DataFrame:
    return rounded(monitor.rolling_metrics(with_truth(t)), "rmse", "mae", "mape", "bias")


@query(with_cte("h", "g", more=_NAIVE + ",\n" + _TRUTH) + "SELECT series_id, ts, round(predicted, 6) AS predicted, round(actual, 6) AS actual FROM lt")
def q_truth_subset(t: Tables) -> DataFrame:
    return rounded(with_truth(t).select("series_id", "ts", "predicted", "actual"), "predicted", "actual")


@query(with_cte("h", "g", more=",\n".join([_NAIVE, _TRUTH, _LIVE])) + "SELECT * FROM lm")
def q_live_metrics(t: Tables) -> DataFrame:
    return live(t)


_DEG = f"""bm AS (SELECT series_id, {_metric_sql()} FROM nv GROUP BY 1),
dj AS (SELECT bm.series_id, (lm.rmse - bm.rmse) / (bm.rmse + 1e-8) AS rmse_rise, lm.mape - bm.mape AS mape_rise, lm.bias, lm.rmse IS NULL AS none FROM bm LEFT JOIN lm ON lm.series_id = bm.series_id),
da AS (SELECT *, coalesce(rmse_rise > 0.1, false) AS alert_rmse, coalesce(mape_rise > 5, false) AS alert_mape, coalesce(abs(bias) > 2, false) AS alert_bias FROM dj),
dn AS (SELECT series_id, round(rmse_rise, 5) AS rmse_rise, round(mape_rise, 5) AS mape_rise, bias, alert_rmse, alert_mape, alert_bias, (alert_rmse::INT + alert_mape::INT + alert_bias::INT) AS n_alerts, none FROM da),
dg AS (SELECT * EXCLUDE (none), CASE WHEN none THEN 'no_data' WHEN n_alerts >= 2 THEN 'RETRAIN' WHEN n_alerts = 1 THEN 'MONITOR' ELSE 'OK' END AS action FROM dn)"""


def degraded(t: Tables) -> DataFrame:
    base = rounded(regression_metrics(naive(t), keys=["series_id"]), *_M)
    return rounded(monitor.degradation(live(t), base, rmse_rise=0.1), "rmse_rise", "mape_rise", digits=5)


@query(with_cte("h", "g", more=",\n".join([_NAIVE, _TRUTH, _LIVE, _DEG])) + "SELECT * FROM dg")
def q_degradation(t: Tables) -> DataFrame:
    return degraded(t)


@query(with_cte("h", "g", more=",\n".join([_NAIVE, _TRUTH, _LIVE, _DEG])) + "SELECT action, count(*) AS n_series FROM dg GROUP BY 1")
def q_action(t: Tables) -> DataFrame:
    return degraded(t).groupBy("action").agg(F.count("*").alias("n_series"))


_PROM = "".join(
    f"{' UNION ALL ' if i else ''}SELECT {3 * i} AS line_no, '# HELP {n} {d}' AS line UNION ALL SELECT {3 * i + 1}, '# TYPE {n} gauge' UNION ALL "
    f"SELECT {3 * i + 2}, '{n}{{series_id=\"' || series_id || '\"}} ' || printf('{f}', coalesce({c}, 0)::DOUBLE) FROM pm"
    for i, (n, d, c, f) in enumerate(monitor.GAUGES)
)


@query(with_cte("h", "g", more=",\n".join([_NAIVE, _TRUTH, _LIVE, _DEG, "pm AS (SELECT lm.*, dg.n_alerts FROM lm JOIN dg ON dg.series_id = lm.series_id)"])) + _PROM)
def q_prometheus(t: Tables) -> DataFrame:
    joined = live(t).join(degraded(t).select("series_id", "n_alerts"), "series_id")
    return monitor.prometheus_lines(joined, keys=["series_id"])


# ---------------------------------------------------------------- scoring

_REQ = """rq AS (SELECT event_id, (json_extract(props, '$.k'))::DOUBLE AS k, value FROM events),
sc AS (SELECT event_id, 1.5::DOUBLE + 0.25::DOUBLE * coalesce(k, 0.0) + 0.0137001::DOUBLE * value AS p FROM rq)"""


def requests(t: Tables) -> DataFrame:
    parsed = F.from_json("props", "map<string,double>")
    features = F.map_concat(parsed, F.create_map(F.lit("value"), F.col("value")))
    return t.events().select("event_id", "event_type", "user_id", "ts", features.alias("features"))


@query(f"WITH {_REQ} SELECT event_id, round(p, 3) AS predicted, round(p - 3.0, 3) AS lower, round(p + 3.0, 3) AS upper FROM sc")
def q_score_map(t: Tables) -> DataFrame:
    weights = {"k": 0.25, "value": 0.0137001, "absent_feature": 5.0}
    model = scoring.linear_prediction(weights, 1.5)
    return scoring.score_requests(requests(t).select("event_id", "features"), list(weights), model)


@query(f"""WITH {_REQ}
SELECT e.user_id, e.event_id, round(p, 3) AS predicted FROM events e JOIN sc ON sc.event_id = e.event_id""")
def q_score_batch(t: Tables) -> DataFrame:
    rows = requests(t).withColumn("day", F.to_date("ts"))
    accepted, _ = scoring.explode_batches(scoring.collect_batches(rows, ["user_id", "day"], ["ts", "event_id"], ["event_id", "features"]))
    rows = accepted.select("user_id", "request.event_id", "request.features")
    weights = {"k": 0.25, "value": 0.0137001}
    out = scoring.score_requests(rows, list(weights), scoring.linear_prediction(weights, 1.5))
    return out.select("user_id", "event_id", "predicted")


@query("""SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE ts END AS ts, event_type <> 'error' AND user_id % 7 <> 0 AS valid FROM events""")
def q_request_check(t: Tables) -> DataFrame:
    # error events get an unreadable time, every seventh user a non-numeric payload
    raw = t.events().select(
        "event_id",
        F.when(F.col("event_type") == "error", "not-a-time").otherwise(F.col("ts").cast("string")).alias("datetime_utc"),
        F.when(F.col("user_id") % 7 == 0, "broken{").otherwise(F.col("props")).alias("payload"),
    )
    return scoring.check_requests(raw).select("event_id", "ts", "valid")


@query("""WITH lg AS (SELECT event_type AS endpoint, value / 100.0 AS s FROM events)
SELECT endpoint, le, n FROM (SELECT endpoint, """ + ", ".join(f"count(*) FILTER (s <= {b}) AS \"{b}\"" for b in scoring.LATENCY_BUCKETS) + """, count(*) AS "+Inf" FROM lg GROUP BY 1)
UNPIVOT (n FOR le IN (COLUMNS(* EXCLUDE endpoint)))""")
def q_latency_buckets(t: Tables) -> DataFrame:
    log = t.events().select(F.col("event_type").alias("endpoint"), (F.col("value") / 100.0).alias("s"))
    return scoring.latency_histogram(log, "s")


@query("SELECT event_type AS endpoint, (CASE WHEN value > 300 THEN 500 ELSE 200 END)::INT AS status, count(*) AS n_requests FROM events GROUP BY 1, 2")
def q_request_counts(t: Tables) -> DataFrame:
    log = t.events().select(
        F.col("event_type").alias("endpoint"), F.when(F.col("value") > 300, 500).otherwise(200).alias("status")
    )
    return scoring.request_counts(log)


# ---------------------------------------------------------------- flagship

_FLAG = """ff AS (SELECT *, last_value(iv IGNORE NULLS) OVER (PARTITION BY series_id ORDER BY rn ROWS BETWEEN 24 PRECEDING AND CURRENT ROW) AS fv FROM it),
im AS (SELECT *, first_value(fv IGNORE NULLS) OVER (PARTITION BY series_id ORDER BY rn ROWS BETWEEN CURRENT ROW AND 24 FOLLOWING) AS bv FROM ff),
fa AS (SELECT series_id, ts, bv, lag(bv, 24) OVER w AS l24, lag(bv, 168) OVER w AS l168, CASE WHEN count(bv) OVER (PARTITION BY series_id ORDER BY rn ROWS BETWEEN 23 PRECEDING AND CURRENT ROW) >= 6 THEN avg(bv) OVER (PARTITION BY series_id ORDER BY rn ROWS BETWEEN 23 PRECEDING AND CURRENT ROW) END AS m24,
lead(bv, 24) OVER w AS target FROM im WINDOW w AS (PARTITION BY series_id ORDER BY rn)),
fb AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY ts) - 1 AS pos, count(*) OVER (PARTITION BY series_id) AS n FROM fa WHERE bv IS NOT NULL AND l24 IS NOT NULL AND l168 IS NOT NULL AND m24 IS NOT NULL AND target IS NOT NULL),
fc AS (SELECT series_id, CASE WHEN pos < floor(n * 0.8::DOUBLE) THEN 'train' WHEN pos < floor(n * (0.8::DOUBLE + 0.1::DOUBLE)) THEN 'val' ELSE 'test' END AS split, target AS actual, bv AS predicted FROM fb)"""


@query(with_cte("h", "g", more=",\n".join(["gg AS (SELECT series_id, ts, value FROM g)", CTE["nb"], CTE["nb_interp"], _FLAG])) + f"SELECT series_id, split, {_metric_sql()} FROM fc GROUP BY 1, 2")
def q_flagship(t: Tables) -> DataFrame:
    """Impute, build features, split in time and score the last value as the 24 h forecast."""
    filled = clean.impute(t.grid(), ["value"], step="1 hour")
    spec = features.FeatureSpec(target="value", lags=(24, 168), windows=(24,), diffs=(24,), derived=False)
    b_cols = ["value", "value_lag_24h", "value_lag_168h", "value_roll_mean_24h", "target_24h"]
    table = ti.drop_incomplete(features.build_features(filled, spec, step="1 hour", drop=False), b_cols)
    split = ti.temporal_split(table)
    scored = split.select("series_id", "split", F.col("target_24h").alias("actual"), F.col("value").alias("predicted"))
    return rounded(regression_metrics(scored, keys=["series_id", "split"]), *_M)
