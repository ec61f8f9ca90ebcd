"""Queries over calendar, lag, rolling, weighted and weather features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import calendar, weather
from tidemark.operators import features as fe
from tidemark.plans.registry import Tables, query, rounded, with_cte
from tidemark.session import cut

_CYC = {
    "hour": "hour(ts) / 24.0", "dow": "(isodow(ts) - 1) / 7.0", "month": "month(ts) / 12.0", "doy": "dayofyear(ts) / 365.25",
}
_CYC_SQL = ", ".join(
    f"round({f}(2 * pi() * ({e})::DOUBLE), 6) + 0.0 AS {n}_{f}" for n, e in _CYC.items() for f in ("sin", "cos")
)
_CYC_NAMES = [f"{n}_{f}" for n in _CYC for f in ("sin", "cos")]


@query(f"SELECT event_id, {_CYC_SQL} FROM events")
def q_cyclic(t: Tables) -> DataFrame:
    out = rounded(t.events().select("event_id", *calendar.cyclic_columns()), *_CYC_NAMES)
    # adding zero turns -0.0 into 0.0 on both sides
    return out.withColumns({c: F.col(c) + 0.0 for c in _CYC_NAMES})


@query("""SELECT event_id, (isodow(ts) >= 6)::INT AS is_weekend, (hour(ts) BETWEEN 6 AND 19)::INT AS is_daytime,
(hour(ts) BETWEEN 6 AND 11)::INT AS is_morning, (hour(ts) BETWEEN 12 AND 17)::INT AS is_afternoon FROM events""")
def q_calendar(t: Tables) -> DataFrame:
    return t.events().select("event_id", *calendar.flag_columns())


@query("SELECT o_orderkey, CASE WHEN month(o_orderdate) IN (12, 1, 2) THEN 0 WHEN month(o_orderdate) <= 5 THEN 1 WHEN month(o_orderdate) <= 8 THEN 2 ELSE 3 END AS season FROM orders")
def q_season(t: Tables) -> DataFrame:
    return t.read("orders").select("o_orderkey", calendar.season_column("o_orderdate"))


_LAGS = (1, 2, 3, 6, 12, 24, 48, 72, 168)


@query(with_cte("h") + "SELECT series_id, ts, " + ", ".join(f"round(lag(value, {k}) OVER w, 6) AS value_lag_{k}h" for k in _LAGS) + " FROM h WINDOW w AS (PARTITION BY series_id ORDER BY ts)")
def q_lag(t: Tables) -> DataFrame:
    out = fe.add_lags(t.hourly(), "value", _LAGS).drop("value")
    return rounded(out, *[f"value_lag_{k}h" for k in _LAGS])


def _roll_sql(source: str) -> str:
    cols = []
    for w in (6, 24, 168):
        label, mp = fe._label(w), max(1, w // 4)
        frame = f"OVER (PARTITION BY series_id ORDER BY ts ROWS BETWEEN {w - 1} PRECEDING AND CURRENT ROW)"
        for name, f in (("mean", "avg(value) {}"), ("std", "stddev_samp(value) {}"), ("min", "min(value) {}"), ("max", "max(value) {}"), ("range", "max(value) {} - min(value) {}")):
            cols.append(f"round(CASE WHEN count(value) {frame} >= {mp} THEN {f.replace('{}', frame)} END + 3e-9, 6) AS value_roll_{name}_{label}")
    return f"SELECT series_id, ts, {', '.join(cols)} FROM {source}"


@query(with_cte("h", "g", "gg") + _roll_sql("gg"))
def q_rolling(t: Tables) -> DataFrame:
    out = fe.add_rolling(t.gappy(), "value", step="1 hour").drop("value")
    return rounded(out, *[c for c in out.columns if "_roll_" in c], nudge=True)


@query(with_cte("h", "g", "gg", more="pd AS (SELECT *, last_value(value IGNORE NULLS) OVER (PARTITION BY series_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS p FROM gg)") + "SELECT series_id, ts, " + ", ".join(
    f"round(value - lag(value, {d}) OVER w, 6) AS value_diff_{fe._label(d)}, "
    f"round(CASE WHEN lag(p, {d}) OVER w IS NULL OR p IS NULL THEN NULL WHEN lag(p, {d}) OVER w = 0 THEN CASE WHEN p > 0 THEN 2 WHEN p < 0 THEN -2 END "
    f"ELSE greatest(-2.0, least(2.0, p / lag(p, {d}) OVER w - 1)) END, 6) AS value_pct_{fe._label(d)}"
    for d in (1, 24, 168)) + " FROM pd WINDOW w AS (PARTITION BY series_id ORDER BY ts)")
def q_diff_pct(t: Tables) -> DataFrame:
    out = fe.add_differences(t.gappy(), "value", step="1 hour").drop("value")
    return rounded(out, *[c for c in out.columns if "value_" in c])


_EWM_SQL = ", ".join(
    f"round(sum(b.value * pow(1 - 2.0::DOUBLE / {w + 1}, a.rn - b.rn)) / sum(pow(1 - 2.0::DOUBLE / {w + 1}, a.rn - b.rn)), 6) AS value_ewm_{fe._label(w)}"
    for w in (6, 24, 168)
)


@query(with_cte("h", "g", "gg", more="n AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY ts) AS rn FROM gg)") + f"""SELECT a.series_id, a.ts, {_EWM_SQL}
FROM n a LEFT JOIN n b ON b.series_id = a.series_id AND b.rn <= a.rn AND b.value IS NOT NULL GROUP BY 1, 2""")
def q_ewm(t: Tables) -> DataFrame:
    out = fe.add_ewm(t.gappy(), "value", step="1 hour").drop("value")
    return rounded(out, *[c for c in out.columns if "_ewm_" in c])


_T, _RH, _W, _R = "meteo_temperature_2m", "meteo_relative_humidity_2m", "meteo_wind_speed_10m", "meteo_shortwave_radiation"
_HUM = f"({_T} + 0.5555::DOUBLE * ({_RH} / 100.0 * 6.112::DOUBLE * exp(17.67::DOUBLE * {_T} / ({_T} + 243.5::DOUBLE)) - 10))"
_CHILL = f"(CASE WHEN {_T} < 10 AND {_W} > 1.3 THEN 13.12::DOUBLE + 0.6215::DOUBLE * {_T} - 11.37::DOUBLE * pow({_W} * 3.6::DOUBLE, 0.16::DOUBLE) + 0.3965::DOUBLE * {_T} * pow({_W} * 3.6::DOUBLE, 0.16::DOUBLE) ELSE {_T} END)"


@query(with_cte("l") + f"SELECT l_orderkey, l_linenumber, round({_HUM}, 6) AS humidex FROM l")
def q_humidex(t: Tables) -> DataFrame:
    return t.weather().select("l_orderkey", "l_linenumber", F.round(weather.humidex(F.col(_T), F.col(_RH)), 6).alias("humidex"))


@query(with_cte("l") + f"SELECT l_orderkey, l_linenumber, round({_CHILL}, 6) AS windchill FROM l")
def q_windchill(t: Tables) -> DataFrame:
    return t.weather().select("l_orderkey", "l_linenumber", F.round(weather.windchill(F.col(_T), F.col(_W)), 6).alias("windchill"))


@query(with_cte("l") + f"SELECT l_orderkey, l_linenumber, round(CASE WHEN {_T} > 27 THEN {_HUM} WHEN {_T} < 10 THEN {_CHILL} ELSE {_T} END, 6) AS apparent FROM l")
def q_apparent(t: Tables) -> DataFrame:
    value = weather.apparent(F.col(_T), F.col(_RH), F.col(_W))
    return t.weather().select("l_orderkey", "l_linenumber", F.round(value, 6).alias("apparent"))


@query(with_cte("l") + f"SELECT l_orderkey, l_linenumber, round(least(1.0, greatest(0.0, {_R} / ((SELECT quantile_cont({_R}, 0.999) FROM l) + 1e-8))), 6) AS meteo_radiation_norm FROM l")
def q_radnorm(t: Tables) -> DataFrame:
    out = weather.add_radiation_norm(t.weather().select("l_orderkey", "l_linenumber", _R)).drop(_R)
    return rounded(out, "meteo_radiation_norm")


@query(with_cte("l") + f"""SELECT l_orderkey, l_linenumber, round({_T} * {_RH} / 100, 6) AS interaction_temp_x_hum, round({_T} * {_W}, 6) AS interaction_temp_x_wind,
round({_R} * (1 - meteo_cloudcover / 100), 6) AS interaction_rad_x_cloud FROM l""")
def q_interactions(t: Tables) -> DataFrame:
    names = ["interaction_temp_x_hum", "interaction_temp_x_wind", "interaction_rad_x_cloud"]
    return rounded(weather.add_interactions(t.weather()).select("l_orderkey", "l_linenumber", *names), *names)


@query(with_cte("h") + """, s AS (SELECT series_id, ts, value AS y, count(*) OVER w AS k, list(value) OVER w AS win FROM h WINDOW w AS (PARTITION BY series_id ORDER BY ts ROWS BETWEEN 48 PRECEDING AND 1 PRECEDING))
SELECT series_id, ts, round(y, 6) AS y, round(list_sum(win), 4) AS window_sum, round(win[1], 6) AS first_value, round(win[48], 6) AS last_value FROM s WHERE k = 48""")
def q_sequences(t: Tables) -> DataFrame:
    s = fe.sequences(t.hourly(), ["value"], "value", 48)
    flat = F.transform("window", lambda v: v[0])
    return s.select(
        "series_id", "ts", F.round("y", 6).alias("y"),
        F.round(F.aggregate(flat, F.lit(0.0), lambda a, v: a + v), 4).alias("window_sum"),
        F.round(flat[0], 6).alias("first_value"), F.round(flat[47], 6).alias("last_value"),
    )


_FULL_EWM = """n AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY ts) AS rn FROM h),
ew AS (SELECT a.series_id, a.ts, {cols} FROM n a JOIN n b ON b.series_id = a.series_id AND b.rn <= a.rn GROUP BY 1, 2)"""


def _features_sql(lags, windows, diffs, horizon) -> str:
    ewm = ", ".join(
        f"sum(b.value * pow(1 - 2.0::DOUBLE / {w + 1}, a.rn - b.rn)) / sum(pow(1 - 2.0::DOUBLE / {w + 1}, a.rn - b.rn)) AS value_ewm_{fe._label(w)}"
        for w in windows
    )
    cols = [f"lag(value, {k}) OVER w AS value_lag_{k}h" for k in lags]
    for n in windows:
        frame = f"OVER (PARTITION BY series_id ORDER BY ts ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
        for name, f in (("mean", "avg(value) {}"), ("std", "stddev_samp(value) {}"), ("min", "min(value) {}"), ("max", "max(value) {}"), ("range", "max(value) {} - min(value) {}")):
            cols.append(f"CASE WHEN count(value) {frame} >= {max(1, n // 4)} THEN {f.replace('{}', frame)} END AS value_roll_{name}_{fe._label(n)}")
    for d in diffs:
        old = f"lag(value, {d}) OVER w"
        cols.append(f"value - {old} AS value_diff_{fe._label(d)}")
        cols.append(f"CASE WHEN {old} IS NOT NULL THEN greatest(-2.0, least(2.0, value / {old} - 1)) END AS value_pct_{fe._label(d)}")
    if horizon:
        cols.append(f"lead(value, {horizon}) OVER w AS target_{horizon}h")
    names = [c.rsplit(" AS ", 1)[1] for c in cols]
    whole = " AND ".join(f"{n} IS NOT NULL" for n in names)
    picked = ", ".join(f"round({n} + 3e-9, 6) AS {n}" for n in [*names, *[f"value_ewm_{fe._label(w)}" for w in windows]])
    return (
        with_cte("h", more=_FULL_EWM.format(cols=ewm))
        + f", ft AS (SELECT series_id, ts, value, {', '.join(cols)} FROM h WINDOW w AS (PARTITION BY series_id ORDER BY ts))\n"
        + f"SELECT ft.series_id, ft.ts, round(value + 3e-9, 6) AS value, {picked}, {_CYC_SQL.replace('(ts)', '(ft.ts)')}, (isodow(ft.ts) >= 6)::INT AS is_weekend, "
        + "(hour(ft.ts) BETWEEN 6 AND 19)::INT AS is_daytime, (hour(ft.ts) BETWEEN 6 AND 11)::INT AS is_morning, (hour(ft.ts) BETWEEN 12 AND 17)::INT AS is_afternoon, "
        + "CASE WHEN month(ft.ts) IN (12, 1, 2) THEN 0 WHEN month(ft.ts) <= 5 THEN 1 WHEN month(ft.ts) <= 8 THEN 2 ELSE 3 END AS season "
        + f"FROM ft JOIN ew ON ew.series_id = ft.series_id AND ew.ts = ft.ts WHERE {whole}"
    )


def _tidy(df: DataFrame) -> DataFrame:
    out = rounded(df, *[c for c in df.columns if c.startswith(("value", "target"))], nudge=True)
    return out.withColumns({c: F.round(c, 6) + 0.0 for c in _CYC_NAMES})


@query(_features_sql(_LAGS, (6, 24, 168), (1, 24, 168), 24))
def q_features_full(t: Tables) -> DataFrame:
    return _tidy(fe.build_features(cut(t.hourly()), fe.FeatureSpec(target="value")))


@query(_features_sql((1, 2, 3, 6, 12, 24, 48), (6, 24), (1, 24, 168), None))
def q_inference_features(t: Tables) -> DataFrame:
    return _tidy(fe.build_features(cut(t.hourly()), fe.FeatureSpec(target="value").for_scoring()))
