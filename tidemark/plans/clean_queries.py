"""Queries over validation, cleaning and imputation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import clean, quality
from tidemark.plans.registry import Tables, query, rounded, with_cte

_RULES = quality.WEATHER_RULES


def _rule_sql() -> str:
    have = ("meteo_temperature_2m", "meteo_relative_humidity_2m", "meteo_wind_speed_10m", "meteo_shortwave_radiation")
    parts = []
    for r in _RULES:
        ok = r.column in have
        parts.append(f"SELECT 'column_exists_{r.column}' AS check_name, {ok} AS passed, {float(ok)} AS observed, 1.0 AS threshold, true AS critical")
        if not ok:
            continue
        share = f"(SELECT avg(({r.column} BETWEEN {r.low} AND {r.high})::INT) FROM l)"
        nulls = f"(SELECT avg(({r.column} IS NULL)::INT) FROM l)"
        parts.append(f"SELECT 'numeric_{r.column}', true, 1.0, 1.0, false")
        parts.append(f"SELECT 'range_{r.column}', {share} >= 0.99, round({share}, 6), 0.99, false")
        parts.append(f"SELECT 'nulls_{r.column}', {nulls} <= {r.max_null}, round({nulls}, 6), {r.max_null}, false")
    copies = "(SELECT coalesce(sum(c - 1), 0) FROM (SELECT count(*) AS c FROM l GROUP BY ts) WHERE c > 1)"
    parts.append(f"SELECT 'index_unique', {copies} = 0, {copies}, 0.0, true")
    parts.append("SELECT 'index_datetime', true, 1.0, 1.0, true")
    days = "(SELECT (epoch(max(ts)) - epoch(min(ts)))::BIGINT // 86400 FROM l)"
    parts.append(f"SELECT 'coverage_days', {days} >= 365, {days}, 365.0, false")
    gap = "(SELECT max(d) / 3600.0 FROM (SELECT epoch(ts) - lag(epoch(ts)) OVER (ORDER BY ts) AS d FROM l))"
    parts.append(f"SELECT 'max_gap_hours', {gap} <= 24, round({gap}, 6), 24.0, false")
    back = "(SELECT count(*) FROM (SELECT k, ts, max(ts) OVER (ORDER BY k ROWS BETWEEN 1 PRECEDING AND 1 PRECEDING) AS b FROM (SELECT l_orderkey * 1000 + l_linenumber AS k, ts FROM l)) WHERE ts < b)"
    parts.append(f"SELECT 'index_monotonic', {back} = 0, {back}, 0.0, true")
    return "SELECT check_name, passed, observed::DOUBLE AS observed, threshold::DOUBLE AS threshold, critical FROM (" + " UNION ALL ".join(parts) + ")"


@query(with_cte("l") + """, k AS (SELECT o_orderkey AS k, o_orderdate AS ts, lag(o_orderdate) OVER (ORDER BY o_orderkey) AS b FROM orders)
SELECT 'index_monotonic' AS check_name, (SELECT count(*) FROM k WHERE ts < b) = 0 AS passed, (SELECT count(*) FROM k WHERE ts < b)::DOUBLE AS observed, 0.0::DOUBLE AS threshold, true AS critical""")
def q_validate_monotonic(t: Tables) -> DataFrame:
    return quality.time_monotonic(t.read("orders"), "o_orderkey", ts="o_orderdate")


def _weather_report_sql() -> str:
    text = _rule_sql()
    i = text.index(" UNION ALL SELECT 'index_monotonic'")
    return with_cte("l") + text[:i] + ")"


@query(_weather_report_sql())
def q_validate_weather(t: Tables) -> DataFrame:
    return rounded(quality.validate_weather(t.weather()), "observed")


@query(with_cte("d") + """SELECT 'data_not_empty' AS check_name, count(*) > 0 AS passed, count(*)::DOUBLE AS observed, 0.0::DOUBLE AS threshold, true AS critical FROM d
UNION ALL SELECT 'close_positive_close', avg((close > 0)::INT) >= 0.99, round(avg((close > 0)::INT), 6), 0.99, false FROM d
UNION ALL SELECT 'close_no_nulls_close', avg((close IS NULL)::INT) < 0.2, round(avg((close IS NULL)::INT), 6), 0.2, false FROM d
UNION ALL SELECT 'index_unique', count(*) = count(DISTINCT (ticker, ts)), (count(*) - count(DISTINCT (ticker, ts)))::DOUBLE, 0.0, true FROM d""")
def q_validate_market(t: Tables) -> DataFrame:
    return rounded(quality.validate_market(t.bars(), keys=["ticker"]), "observed")


_L4 = ["meteo_temperature_2m", "meteo_relative_humidity_2m", "meteo_wind_speed_10m", "meteo_shortwave_radiation"]


def _fences(factor: float, table: str = "l", columns=tuple(_L4)) -> str:
    cols = ", ".join(
        f"quantile_cont({c}, 0.25) - {factor} * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS lo_{c}, "
        f"quantile_cont({c}, 0.75) + {factor} * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS hi_{c}"
        for c in columns
    )
    return f"fx AS (SELECT {cols} FROM {table})"


@query(with_cte("l", more=_fences(0.3)) + "SELECT l_orderkey, l_linenumber, " + ", ".join(
    f"CASE WHEN {c} BETWEEN lo_{c} AND hi_{c} THEN round({c}, 6) END AS {c}" for c in _L4) + " FROM l, fx")
def q_outlier_iqr(t: Tables) -> DataFrame:
    cleaned = clean.remove_outliers_iqr(t.weather(), _L4, factor=0.3)
    return rounded(cleaned.select("l_orderkey", "l_linenumber", *_L4), *_L4)


@query(with_cte("h", more=_fences(1.5, "h", ("value",))) + """SELECT 'value' AS "column", count(*) FILTER (value < lo_value OR value > hi_value) AS n_outliers,
round(count(*) FILTER (value < lo_value OR value > hi_value) * 100.0 / count(*), 6) AS pct_outliers, round(any_value(lo_value), 6) AS lower, round(any_value(hi_value), 6) AS upper FROM h, fx""")
def q_outlier_report(t: Tables) -> DataFrame:
    return rounded(clean.iqr_report(t.hourly(), ["value"], 1.5), "pct_outliers", "lower", "upper")


@query(with_cte("h") + """, b AS (SELECT series_id, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM h GROUP BY 1)
SELECT h.series_id, h.ts, round(value, 6) AS value, (value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1))::INT AS value_is_outlier
FROM h JOIN b ON b.series_id = h.series_id""")
def q_outlier_flags(t: Tables) -> DataFrame:
    h = t.hourly()
    bounds = clean.iqr_bounds(h, ["value"], 1.5, keys=["series_id"])
    return rounded(clean.flag_outliers(h, ["value"], bounds, keys=["series_id"]), "value")


@query("""WITH s AS (SELECT avg(value) AS m, stddev_pop(value) AS d FROM events)
SELECT event_id, CASE WHEN abs(value - m) <= 2.5 * d THEN value END AS value FROM events, s""")
def q_outlier_zscore(t: Tables) -> DataFrame:
    return clean.remove_outliers_zscore(t.events().select("event_id", "value"), ["value"], threshold=2.5)


@query(with_cte("h", "g", "gg", "nb", "nb_interp") + "SELECT series_id, ts, round(iv, 6) AS value FROM it")
def q_interp(t: Tables) -> DataFrame:
    return rounded(clean.interpolate(t.gappy(), ["value"], 6, step="1 hour"), "value")


@query(with_cte("h", "g", "gg", "nb") + "SELECT series_id, ts, round(CASE WHEN rn - pr <= 24 THEN pv END, 6) AS value FROM nb")
def q_ffill(t: Tables) -> DataFrame:
    return rounded(clean.forward_fill(t.gappy(), ["value"], 24, step="1 hour"), "value")


@query(with_cte("h", "g", "gg", "nb") + "SELECT series_id, ts, round(CASE WHEN nr - rn <= 24 THEN nv END, 6) AS value FROM nb")
def q_bfill(t: Tables) -> DataFrame:
    return rounded(clean.backward_fill(t.gappy(), ["value"], 24, step="1 hour"), "value")


_IMPUTED = """ff AS (SELECT *, last_value(iv IGNORE NULLS) OVER (PARTITION BY series_id ORDER BY rn ROWS BETWEEN 24 PRECEDING AND CURRENT ROW) AS fv FROM it),
im AS (SELECT *, first_value(fv IGNORE NULLS) OVER (PARTITION BY series_id ORDER BY rn ROWS BETWEEN CURRENT ROW AND 24 FOLLOWING) AS bv FROM ff)"""


@query(with_cte("h", "g", "gg", "nb", "nb_interp", more=_IMPUTED) + "SELECT series_id, ts, round(bv, 6) AS value FROM im")
def q_impute(t: Tables) -> DataFrame:
    return rounded(clean.impute(t.gappy(), ["value"], step="1 hour"), "value")


@query(with_cte("h", "g", "gg", "nb", "nb_interp", more=_IMPUTED) + """SELECT series_id, 'value' AS "column", count(*) FILTER (bv IS NULL) AS n_null,
round(count(*) FILTER (bv IS NULL) * 100.0 / count(*), 6) AS pct_null FROM im GROUP BY 1""")
def q_null_report(t: Tables) -> DataFrame:
    imputed = clean.impute(t.gappy(), ["value"], step="1 hour")
    return rounded(clean.null_report(imputed, ["value"], keys=["series_id"]), "pct_null")


@query(with_cte("l") + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, round(min({c}), 6) AS min, round(max({c}), 6) AS max FROM l"""
    for c in _L4))
def q_norm_stats(t: Tables) -> DataFrame:
    return rounded(clean.normalization_stats(t.weather(), _L4), "mean", "std", "min", "max")


@query(with_cte("h") + """, s AS (SELECT series_id, avg(value) AS m, stddev_samp(value) AS d FROM h GROUP BY 1)
SELECT h.series_id, h.ts, round((value - m) / d, 6) AS value FROM h JOIN s ON s.series_id = h.series_id""")
def q_normalize(t: Tables) -> DataFrame:
    return rounded(clean.normalize(t.hourly(), ["value"], keys=["series_id"]), "value")
