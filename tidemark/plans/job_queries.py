"""Queries over whole-job compositions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.plans import jobs
from tidemark.plans.registry import Tables, query, rounded, with_cte


def _fill_sql(c: str) -> str:
    """CTE chain imputing column ``c`` of ``zc`` (limits 6 / 24 / 24) as ``f_<c>``."""
    part = "PARTITION BY series_id ORDER BY rn"
    return f"""a_{c} AS (SELECT series_id, ts, rn, {c} AS v, max(CASE WHEN {c} IS NOT NULL THEN rn END) OVER ({part} ROWS UNBOUNDED PRECEDING) AS pr,
min(CASE WHEN {c} IS NOT NULL THEN rn END) OVER ({part} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nr FROM zc),
b_{c} AS (SELECT a.series_id, a.rn, CASE WHEN a.v IS NOT NULL THEN a.v WHEN a.pr IS NULL OR a.rn - a.pr > 6 THEN NULL WHEN a.nr IS NULL THEN p.v
ELSE p.v + (q.v - p.v) * ((a.rn - a.pr)::DOUBLE / (a.nr - a.pr)) END AS v FROM a_{c} a LEFT JOIN a_{c} p ON p.series_id = a.series_id AND p.rn = a.pr LEFT JOIN a_{c} q ON q.series_id = a.series_id AND q.rn = a.nr),
c_{c} AS (SELECT series_id, rn, last_value(v IGNORE NULLS) OVER ({part} ROWS BETWEEN 24 PRECEDING AND CURRENT ROW) AS v FROM b_{c}),
f_{c} AS (SELECT series_id, rn, first_value(v IGNORE NULLS) OVER ({part} ROWS BETWEEN CURRENT ROW AND 24 FOLLOWING) AS v FROM c_{c})"""


_PRE = """ux AS (SELECT ticker, ts, close, lead(ts) OVER (PARTITION BY ticker ORDER BY ts) AS nx FROM d WHERE dayofweek(ts) BETWEEN 1 AND 5),
uy AS (SELECT ticker, ts AS src, close, unnest(generate_series(ts, coalesce(nx - INTERVAL 1 HOUR, ts), INTERVAL 1 HOUR)) AS ts FROM ux),
up AS (SELECT ticker, ts, CASE WHEN ts <= src + INTERVAL 24 HOUR THEN close END AS close FROM uy),
jn AS (SELECT g.series_id, g.ts, g.value AS meteo_value, CASE WHEN epoch(g.ts) - epoch(up.ts) <= 24 * 3600 THEN up.close END AS fin_close FROM g ASOF LEFT JOIN up ON up.ticker = g.series_id AND g.ts >= up.ts),
bd AS (SELECT quantile_cont(meteo_value, 0.25) AS m1, quantile_cont(meteo_value, 0.75) AS m3, quantile_cont(fin_close, 0.25) AS c1, quantile_cont(fin_close, 0.75) AS c3 FROM jn),
iq AS (SELECT series_id, ts, CASE WHEN meteo_value BETWEEN m1 - 1.5 * (m3 - m1) AND m3 + 1.5 * (m3 - m1) THEN meteo_value END AS meteo_value,
CASE WHEN fin_close BETWEEN c1 - 1.5 * (c3 - c1) AND c3 + 1.5 * (c3 - c1) THEN fin_close END AS fin_close,
coalesce(meteo_value NOT BETWEEN m1 - 1.5 * (m3 - m1) AND m3 + 1.5 * (m3 - m1), false)::INT AS meteo_value_is_outlier,
coalesce(fin_close NOT BETWEEN c1 - 1.5 * (c3 - c1) AND c3 + 1.5 * (c3 - c1), false)::INT AS fin_close_is_outlier FROM jn, bd),
zs AS (SELECT avg(meteo_value) AS ma, stddev_pop(meteo_value) AS ms, avg(fin_close) AS ca, stddev_pop(fin_close) AS cs FROM iq),
zc AS (SELECT series_id, ts, row_number() OVER (PARTITION BY series_id ORDER BY ts) AS rn, CASE WHEN abs(meteo_value - ma) <= 2 * ms THEN meteo_value END AS meteo_value,
CASE WHEN abs(fin_close - ca) <= 2 * cs THEN fin_close END AS fin_close, meteo_value_is_outlier, fin_close_is_outlier FROM iq, zs)"""


@query(with_cte("h", "g", "d", more=",\n".join([_PRE, _fill_sql("meteo_value"), _fill_sql("fin_close")])) + """SELECT zc.series_id, zc.ts, round(m.v + 3e-9, 6) AS meteo_value, round(c.v + 3e-9, 6) AS fin_close, meteo_value_is_outlier, fin_close_is_outlier
FROM zc JOIN f_meteo_value m ON m.series_id = zc.series_id AND m.rn = zc.rn JOIN f_fin_close c ON c.series_id = zc.series_id AND c.rn = zc.rn""")
def q_preprocess(t: Tables) -> DataFrame:
    market = t.bars().filter(F.weekday("ts") < 5).select(F.col("ticker").alias("series_id"), "ts", F.col("close").alias("fin_close"))
    weather = t.grid().withColumnRenamed("value", "meteo_value")
    out = jobs.preprocess(weather, market, market_values=["fin_close"], iqr_factor=1.5, z_threshold=2.0)
    return rounded(out, "meteo_value", "fin_close", nudge=True)
