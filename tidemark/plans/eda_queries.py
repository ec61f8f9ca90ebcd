"""Queries over grouped profiles and distribution summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import eda
from tidemark.operators.timeindex import left_align, outer_concat
from tidemark.plans.registry import Tables, query, rounded, with_cte


@query("SELECT hour(ts) AS hour, round(avg(value), 6) AS mean_value FROM events GROUP BY 1")
def q_profile_hour(t: Tables) -> DataFrame:
    return rounded(eda.mean_profile(t.events(), "hour", ["value"]), "mean_value")


@query("SELECT month(o_orderdate) AS month, round(avg(o_totalprice), 4) AS mean_o_totalprice FROM orders GROUP BY 1")
def q_profile_month(t: Tables) -> DataFrame:
    return rounded(eda.mean_profile(t.read("orders"), "month", ["o_totalprice"], ts="o_orderdate"), "mean_o_totalprice", digits=4)


def _hist_sql(table: str, column: str, bins: int) -> str:
    return f"""SELECT f.bin::BIGINT AS bin, round(lo + f.bin * (hi - lo) / {bins}, 5) AS bin_low, round(lo + (f.bin + 1) * (hi - lo) / {bins}, 5) AS bin_high, coalesce(c.n, 0) AS n
FROM (SELECT min({column}) AS lo, max({column}) AS hi, unnest(generate_series(0, {bins - 1})) AS bin FROM {table}) f
LEFT JOIN (SELECT least({bins - 1}, greatest(0, floor(({column} - lo) / (hi - lo) * {bins})))::BIGINT AS bin, count(*) AS n FROM {table}, (SELECT min({column}) AS lo, max({column}) AS hi FROM {table}) GROUP BY 1) c ON c.bin = f.bin"""


@query(_hist_sql("events", "value", 60))
def q_hist(t: Tables) -> DataFrame:
    return rounded(eda.histogram(t.events(), "value", 60), "bin_low", "bin_high", digits=5)


def _box_sql(column: str) -> str:
    return f"""SELECT '{column}' AS "column", round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3, min({column}) AS min, max({column}) AS max,
min({column}) FILTER ({column} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_low,
max({column}) FILTER ({column} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_high
FROM lineitem, (SELECT quantile_cont({column}, 0.25) AS q1, quantile_cont({column}, 0.5) AS median, quantile_cont({column}, 0.75) AS q3 FROM lineitem) GROUP BY ALL"""


@query(_box_sql("l_extendedprice") + " UNION ALL " + _box_sql("l_quantity"))
def q_box(t: Tables) -> DataFrame:
    return rounded(eda.box_summary(t.read("lineitem"), ["l_extendedprice", "l_quantity"]), "q1", "median", "q3")


_CORR = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query(" UNION ALL ".join(
    f"SELECT '{a}' AS column_a, '{b}' AS column_b, round(corr({a}, {b}), 6) AS corr FROM lineitem" for a in _CORR for b in _CORR))
def q_corr(t: Tables) -> DataFrame:
    return rounded(eda.correlation_matrix(t.read("lineitem"), _CORR), "corr")


_TICKERS = ("click", "error", "purchase", "signup", "view")


@query(with_cte("d") + """, dm AS (SELECT date_trunc('day', ts) AS ts, avg(value) AS value FROM events GROUP BY 1)
SELECT ticker || '_close' AS "column", round(corr(value, close), 6) AS corr FROM dm JOIN d ON d.ts = dm.ts GROUP BY 1""")
def q_corr_daily(t: Tables) -> DataFrame:
    names = list(_TICKERS)
    closes = outer_concat(t.bars(), "ticker", names, ["close"])
    # bars sit at midnight; events align on their day
    day = F.date_trunc("day", "ts").cast("timestamp_ntz")
    daily = left_align(t.events().select(day.alias("ts"), "value").groupBy("ts").agg(F.avg("value").alias("value")), closes, keys=())
    return rounded(eda.daily_correlation(daily, "value", [f"{n}_close" for n in names]), "corr")


@query("""SELECT hour(ts) AS hour, round(avg(sin(2 * pi() * hour(ts) / 24.0::DOUBLE)), 6) + 0.0 AS mean_sin, round(avg(cos(2 * pi() * hour(ts) / 24.0::DOUBLE)), 6) + 0.0 AS mean_cos, count(*) AS n FROM events GROUP BY 1""")
def q_encoding_check(t: Tables) -> DataFrame:
    out = rounded(eda.encoding_check(t.events()), "mean_sin", "mean_cos")
    return out.withColumns({c: F.col(c) + 0.0 for c in ("mean_sin", "mean_cos")})
