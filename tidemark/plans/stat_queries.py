"""Queries over the statistical tests and decompositions."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import decompose as dc
from tidemark.operators import stats
from tidemark.plans.registry import Tables, query, rounded, with_cte

_CEN = "cn AS (SELECT series_id, ts, value - avg(value) OVER (PARTITION BY series_id) AS e, count(*) OVER (PARTITION BY series_id) AS n FROM h)"


def _lag_sums(lags: int) -> str:
    parts = ", ".join(f"lag(e, {k}) OVER w AS e{k}" for k in range(1, lags + 1))
    sums = " UNION ALL ".join(f"SELECT series_id, any_value(n) AS n, {k} AS lag, sum(e * e{k}) / sum(e * e) AS r FROM lg GROUP BY 1" for k in range(1, lags + 1))
    return f"lg AS (SELECT *, {parts} FROM cn WINDOW w AS (PARTITION BY series_id ORDER BY ts)),\nac AS ({sums})"


@query(with_cte("h", more=_CEN + ",\n" + _lag_sums(72)) + "SELECT series_id, lag, round(r, 8) AS acf, round(1.96 / sqrt(n), 8) AS bound, abs(r) > 1.96 / sqrt(n) AS significant FROM ac")
def q_acf(t: Tables) -> DataFrame:
    return rounded(stats.acf(t.hourly(), "value"), "acf", "bound", digits=8)


@query()
def q_pacf(t: Tables) -> DataFrame:
    return rounded(stats.pacf(t.hourly(), "value"), "pacf", "bound")


@query()
def q_pacf_order(t: Tables) -> DataFrame:
    return stats.order_suggestion(t.hourly(), "value")


@query(with_cte("h", more=_CEN + ",\n" + _lag_sums(40)) + " UNION ALL ".join(
    f"SELECT series_id, {h} AS lag, round(any_value(n) * (any_value(n) + 2) * sum(r * r / (n - lag)), 6) AS lb_stat FROM ac WHERE lag <= {h} GROUP BY 1" for h in (10, 20, 40)))
def q_ljungbox_stat(t: Tables) -> DataFrame:
    return rounded(stats.ljung_box(t.hourly(), "value").drop("lb_pvalue"), "lb_stat")


def _chi2_sql(x: str, degrees: int) -> str:
    terms = [f"pow({x} / 2, {i}) / {math.factorial(i)}::DOUBLE" for i in range(degrees // 2)]
    return f"exp(-{x} / 2) * ({' + '.join(terms)})"


@query(with_cte("h", more=_CEN + ",\n" + _lag_sums(40)) + " UNION ALL ".join(
    f"SELECT series_id, {h} AS lag, round(x, 6) AS lb_stat, round({_chi2_sql('x', h)}, 6) AS lb_pvalue FROM (SELECT series_id, any_value(n) * (any_value(n) + 2) * sum(r * r / (n - lag)) AS x FROM ac WHERE lag <= {h} GROUP BY 1)" for h in (10, 20, 40)))
def q_ljungbox(t: Tables) -> DataFrame:
    return rounded(stats.ljung_box(t.hourly(), "value"), "lb_stat", "lb_pvalue")


@query(with_cte("h") + """, x AS (SELECT series_id, value, value - lag(value) OVER (PARTITION BY series_id ORDER BY ts) AS d FROM h),
y AS (SELECT series_id, sum(d * d) / sum(value * value) AS dw FROM x GROUP BY 1)
SELECT series_id, round(dw, 8) AS durbin_watson, dw > 1.5 AND dw < 2.5 AS dw_ok FROM y""")
def q_durbin_watson(t: Tables) -> DataFrame:
    return rounded(stats.durbin_watson(t.hourly(), "value"), "durbin_watson", digits=8)


@query(with_cte("h") + """, m AS (SELECT series_id, avg(value) AS mu FROM h GROUP BY 1),
c AS (SELECT h.series_id, count(*) AS n, avg(pow(value - mu, 2)) AS m2, avg(pow(value - mu, 3)) AS m3, avg(pow(value - mu, 4)) AS m4 FROM h JOIN m ON m.series_id = h.series_id GROUP BY 1),
s AS (SELECT series_id, n, m3 / pow(m2, 1.5) AS skew, m4 / (m2 * m2) - 3 AS kurt FROM c)
SELECT series_id, n, round(skew, 6) AS skew, round(kurt, 6) AS kurt, round(n / 6.0 * (skew * skew + kurt * kurt / 4), 4) AS jb_stat, round(exp(-n / 12.0 * (skew * skew + kurt * kurt / 4)), 6) AS jb_pvalue FROM s""")
def q_jarque_bera(t: Tables) -> DataFrame:
    out = rounded(stats.jarque_bera(t.hourly(), "value"), "skew", "kurt", "jb_pvalue")
    return rounded(out, "jb_stat", digits=4)


_DEC = """dp AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY ts) - 1 AS pos FROM h),
dt AS (SELECT *, CASE WHEN count(value) OVER f = 25 THEN (sum(value) OVER f - 0.5 * (lag(value, 12) OVER w + lead(value, 12) OVER w)) / 24 END AS trend FROM dp
WINDOW w AS (PARTITION BY series_id ORDER BY pos), f AS (PARTITION BY series_id ORDER BY pos ROWS BETWEEN 12 PRECEDING AND 12 FOLLOWING)),
ds AS (SELECT series_id, pos % 24 AS phase, avg(value - trend) AS s FROM dt GROUP BY 1, 2),
dg AS (SELECT *, s - avg(s) OVER (PARTITION BY series_id) AS seasonal FROM ds),
de AS (SELECT dt.series_id, dt.ts, value, trend, seasonal, value - trend - seasonal AS resid FROM dt JOIN dg ON dg.series_id = dt.series_id AND dg.phase = dt.pos % 24)"""


@query(with_cte("h", more=_DEC) + "SELECT series_id, ts, round(value + 3e-9, 6) AS value, round(trend + 3e-9, 6) AS trend, round(seasonal + 3e-9, 6) AS seasonal, round(resid + 3e-9, 6) AS resid FROM de")
def q_decompose(t: Tables) -> DataFrame:
    return rounded(dc.decompose(t.hourly(), "value", 24), "value", "trend", "seasonal", "resid", nudge=True)


@query(with_cte("h", more=_DEC) + """, ss AS (SELECT series_id, greatest(0.0, 1 - var_samp(resid) / var_samp(seasonal + resid)) AS fs, greatest(0.0, 1 - var_samp(resid) / var_samp(trend + resid)) AS ft FROM de WHERE trend IS NOT NULL GROUP BY 1)
SELECT series_id, round(fs, 6) AS seasonal_strength, round(ft, 6) AS trend_strength, fs > 0.6 AS strong_seasonality, ft > 0.6 AS strong_trend FROM ss""")
def q_strength(t: Tables) -> DataFrame:
    return rounded(dc.strengths(dc.decompose(t.hourly(), "value", 24)), "seasonal_strength", "trend_strength")


@query()
def q_stl(t: Tables) -> DataFrame:
    return rounded(dc.stl(t.hourly(), "value", 24), "trend", "seasonal", "resid", digits=5)


@query()
def q_adf(t: Tables) -> DataFrame:
    return rounded(stats.adf(t.hourly(), "value"), "adf_stat", "adf_pval")


@query(with_cte("h") + """, e0 AS (SELECT series_id, ts, value - avg(value) OVER (PARTITION BY series_id) AS e, row_number() OVER (PARTITION BY series_id ORDER BY ts) AS rn,
count(*) OVER (PARTITION BY series_id) AS n FROM h),
es AS (SELECT *, sum(e) OVER (PARTITION BY series_id ORDER BY rn ROWS UNBOUNDED PRECEDING) AS s FROM e0),
et AS (SELECT series_id, any_value(n) AS n, sum(s * s) / pow(any_value(n), 2) AS eta, sum(e * e) AS g0, floor(pow(any_value(n), 2.0 / 9.0)) AS cov FROM es GROUP BY 1),
gk AS (SELECT a.series_id, a.rn - b.rn AS k, sum(a.e * b.e) AS g FROM e0 a JOIN e0 b ON a.series_id = b.series_id AND a.rn - b.rn BETWEEN 1 AND 60 GROUP BY 1, 2),
rt AS (SELECT et.series_id, any_value(n) AS n, any_value(eta) AS eta, any_value(g0) AS g0,
sum(k * 2 * g / n) FILTER (k <= cov) / (any_value(g0) / any_value(n) + sum(2 * g / n) FILTER (k <= cov)) AS ratio FROM et JOIN gk ON gk.series_id = et.series_id GROUP BY 1),
lg AS (SELECT *, least(floor(1.1447 * pow(ratio * ratio, 1.0 / 3.0) * pow(n, 1.0 / 3.0)), n - 1) AS lags FROM rt),
st AS (SELECT lg.series_id, any_value(lags) AS lags, any_value(eta) / ((any_value(g0) + 2 * coalesce(sum(g * (1 - k / (lags + 1.0))) FILTER (k <= lags), 0)) / any_value(n)) AS stat FROM lg JOIN gk ON gk.series_id = lg.series_id GROUP BY 1),
pv AS (SELECT *, CASE WHEN stat <= 0.347 THEN 0.1 WHEN stat <= 0.463 THEN 0.1 - 0.05 * (stat - 0.347) / 0.116 WHEN stat <= 0.574 THEN 0.05 - 0.025 * (stat - 0.463) / 0.111
WHEN stat <= 0.739 THEN 0.025 - 0.015 * (stat - 0.574) / 0.165 ELSE 0.01 END AS p FROM st)
SELECT series_id, round(stat, 6) AS kpss_stat, lags::INT AS kpss_lags, round(p, 6) AS kpss_pval, p > 0.05 AS stationary_kpss FROM pv""")
def q_kpss(t: Tables) -> DataFrame:
    return rounded(stats.kpss(t.hourly(), "value"), "kpss_stat", "kpss_pval")


@query()
def q_verdict(t: Tables) -> DataFrame:
    return rounded(stats.stationarity(t.daily(), "value"), "adf_stat", "adf_pval", "kpss_stat", "kpss_pval", digits=5)


@query()
def q_granger(t: Tables) -> DataFrame:
    wide = t.daily().withColumn("mean_price", F.col("value") / F.col("n"))
    return rounded(stats.granger(wide, "value", ["n", "mean_price"], 12), "min_pvalue")


@query()
def q_shapiro(t: Tables) -> DataFrame:
    return rounded(stats.shapiro(t.hourly(), "value"), "shapiro_w", "shapiro_pval")


@query()
def q_residual_tests(t: Tables) -> DataFrame:
    from tidemark.plans.forecast_queries import naive

    resid = naive(t).dropna().withColumn("resid", F.col("actual") - F.col("predicted"))
    out = stats.residual_tests(resid, "resid")
    return rounded(out, "ljung_box_pmin", "shapiro_w", "shapiro_pval", "durbin_watson")


@query()
def q_battery(t: Tables) -> DataFrame:
    """Verdict, lag orders and weekly strengths per daily series in one row."""
    from tidemark.plans import jobs

    wide = t.daily().withColumn("mean_price", F.col("value") / F.col("n"))
    out = jobs.statistics_report(wide, "value", ["n", "mean_price"], max_lag=12, periods=(7,))
    row = out["stationarity"].select("series_id", "adf_stat", "kpss_stat", "conclusion", "differencing_recommended")
    row = row.join(out["orders"], "series_id").join(out["strength_7"], "series_id")
    return rounded(row, "adf_stat", "kpss_stat", "seasonal_strength", "trend_strength", digits=5)
