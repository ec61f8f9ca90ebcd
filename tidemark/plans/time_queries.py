"""Queries over the time-index and source operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import timeindex as ti
from tidemark.operators.eda import null_share, profile
from tidemark.plans.registry import Tables, query, rounded, with_cte


@query(with_cte("h") + "SELECT series_id, ts, round(value, 6) AS value FROM h")
def q_resample_hourly(t: Tables) -> DataFrame:
    return rounded(t.hourly(), "value")


@query("SELECT event_type AS series_id, date_trunc('day', ts) AS ts, round(avg(value), 6) AS value, count(*) AS n FROM events GROUP BY 1, 2")
def q_resample_daily(t: Tables) -> DataFrame:
    e = t.events().withColumnRenamed("event_type", "series_id")
    return rounded(ti.downsample(e, "1 day", {"value": F.avg("value"), "n": F.count("*")}), "value")


@query("""SELECT o_custkey, o_orderdate, o_orderkey, o_totalprice FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey) = 1""")
def q_dedupe_first(t: Tables) -> DataFrame:
    o = t.read("orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_totalprice")
    return ti.dedupe(o, keys=["o_custkey"], ts="o_orderdate", order=["o_orderkey"])


@query("""SELECT o_custkey, o_orderdate, o_orderkey, o_totalprice FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey DESC) = 1""")
def q_dedupe_last(t: Tables) -> DataFrame:
    o = t.read("orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_totalprice")
    return ti.dedupe(o, keys=["o_custkey"], ts="o_orderdate", order=["o_orderkey"], keep="last")


@query(with_cte("h", "g") + "SELECT series_id, ts FROM g WHERE value IS NULL")
def q_grid_missing(t: Tables) -> DataFrame:
    return ti.missing_times(t.hourly(), "1 hour")


@query("""WITH w AS (SELECT event_type AS series_id, epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY event_type ORDER BY ts) AS d FROM events)
SELECT series_id, round(max(d) / 3600000000.0, 6) AS max_gap_hours FROM w GROUP BY 1""")
def q_max_gap(t: Tables) -> DataFrame:
    e = t.events().withColumnRenamed("event_type", "series_id")
    return rounded(ti.gaps(e), "max_gap_hours")


@query(with_cte("h") + """, c AS (SELECT series_id, count(*) AS n_rows, (epoch(max(ts))::BIGINT - epoch(min(ts))::BIGINT) // 3600 + 1 AS n_expected FROM h GROUP BY 1)
SELECT series_id, n_rows, n_expected, round(greatest(0.0, (n_expected - n_rows) * 100.0 / n_expected), 6) AS missing_pct,
greatest(0.0, (n_expected - n_rows) * 100.0 / n_expected) > 5 AS warn FROM c""")
def q_continuity(t: Tables) -> DataFrame:
    return rounded(ti.continuity(t.hourly()), "missing_pct")


@query(with_cte("d") + """, x AS (SELECT ticker, ts, close, lead(ts) OVER (PARTITION BY ticker ORDER BY ts) AS nx FROM d),
y AS (SELECT ticker, ts AS src, close, unnest(generate_series(ts, coalesce(nx - INTERVAL 1 HOUR, ts), INTERVAL 1 HOUR)) AS ts FROM x)
SELECT ticker, ts, CASE WHEN ts <= src + INTERVAL 24 HOUR THEN close END AS close FROM y""")
def q_upsample_ffill(t: Tables) -> DataFrame:
    bars = t.bars().select("ticker", "ts", "close")
    return ti.upsample_ffill(bars, keys=["ticker"])


_ASOF_SIDES = """p AS (SELECT user_id, ts, event_id, value FROM events WHERE event_type = 'purchase'),
v AS (SELECT user_id, ts, value AS view_value FROM events WHERE event_type = 'view')"""


@query(f"""WITH {_ASOF_SIDES},
m AS (SELECT p.*, v.ts AS matched_ts, v.view_value FROM p ASOF LEFT JOIN v ON p.user_id = v.user_id AND p.ts >= v.ts),
k AS (SELECT *, sum(CASE WHEN matched_ts = ts THEN 0 ELSE 1 END) OVER (PARTITION BY user_id, matched_ts ORDER BY ts ROWS UNBOUNDED PRECEDING) AS run FROM m)
SELECT user_id, ts, event_id, value, CASE WHEN run <= 2 THEN view_value END AS view_value,
CASE WHEN run <= 2 THEN matched_ts END AS matched_ts FROM k""")
def q_asof_backward_limit(t: Tables) -> DataFrame:
    e = t.events()
    left = e.filter("event_type = 'purchase'").select("user_id", "ts", "event_id", "value")
    right = e.filter("event_type = 'view'").select("user_id", "ts", F.col("value").alias("view_value"))
    return ti.asof_backward(left, right, ["view_value"], keys=["user_id"], limit=2)


@query(f"""WITH {_ASOF_SIDES},
b AS (SELECT p.*, v.ts AS bt, v.view_value AS bv FROM p ASOF LEFT JOIN v ON p.user_id = v.user_id AND p.ts >= v.ts),
a AS (SELECT b.*, v.ts AS nt, v.view_value AS nv FROM b ASOF LEFT JOIN v ON b.user_id = v.user_id AND b.ts <= v.ts),
c AS (SELECT *, nt IS NULL OR (bt IS NOT NULL AND epoch_us(ts) - epoch_us(bt) < epoch_us(nt) - epoch_us(ts)) AS back FROM a)
SELECT user_id, ts, event_id, value, CASE WHEN back THEN bv ELSE nv END AS view_value, CASE WHEN back THEN bt ELSE nt END AS matched_ts FROM c""")
def q_asof_nearest(t: Tables) -> DataFrame:
    e = t.events()
    left = e.filter("event_type = 'purchase'").select("user_id", "ts", "event_id", "value")
    right = e.filter("event_type = 'view'").select("user_id", "ts", F.col("value").alias("view_value"))
    return ti.asof_nearest(left, right, ["view_value"], keys=["user_id"])


@query(with_cte("h", "d") + "SELECT h.series_id, h.ts, round(h.value, 6) AS value, d.close FROM h LEFT JOIN d ON d.ticker = h.series_id AND d.ts = h.ts")
def q_left_align(t: Tables) -> DataFrame:
    right = t.bars().select(F.col("ticker").alias("series_id"), "ts", "close")
    return rounded(ti.left_align(t.hourly(), right), "value")


TICKERS = ("click", "error", "purchase", "signup", "view")


@query(with_cte("d") + "SELECT ts, " + ", ".join(f"max(CASE WHEN ticker = '{k}' THEN {c} END) AS {k}_{c}" for k in TICKERS for c in ("close", "volume")) + " FROM d GROUP BY ts")
def q_outer_concat(t: Tables) -> DataFrame:
    return ti.outer_concat(t.bars(), "ticker", TICKERS, ["close", "volume"])


@query(with_cte("h") + """SELECT series_id, ts, round(value, 6) AS value FROM h
QUALIFY ts >= max(ts) OVER (PARTITION BY series_id) - INTERVAL 72 HOUR""")
def q_trailing_72h(t: Tables) -> DataFrame:
    return rounded(ti.trailing_window(t.hourly(), 72), "value")


@query(with_cte("h") + "SELECT series_id, ts, round(value, 6) AS value FROM h QUALIFY row_number() OVER (PARTITION BY series_id ORDER BY ts DESC) <= 168")
def q_tail_rows(t: Tables) -> DataFrame:
    return rounded(ti.tail_rows(t.hourly(), 168), "value")


@query("""WITH b AS (SELECT min(o_orderdate)::DATE AS lo, max(o_orderdate)::DATE AS hi FROM orders),
y AS (SELECT lo, hi, unnest(generate_series(year(lo), year(hi))) AS y FROM b)
SELECT greatest(lo, make_date(y, 1, 1)) AS chunk_start, least(hi, make_date(y, 12, 31)) AS chunk_end FROM y
WHERE greatest(lo, make_date(y, 1, 1)) < hi""")
def q_year_chunks(t: Tables) -> DataFrame:
    return ti.year_chunks(t.read("orders"), "o_orderdate")


@query("""WITH f AS (SELECT ts, event_id FROM events ORDER BY ts, event_id LIMIT 100),
s AS (SELECT (epoch_us(ts) - lag(epoch_us(ts)) OVER (ORDER BY ts, event_id)) / 1000000.0 AS d FROM f),
m AS (SELECT d FROM s WHERE d IS NOT NULL GROUP BY d ORDER BY count(*) DESC, d LIMIT 1),
k AS (SELECT CASE data_type WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(data_type) END AS kind FROM duckdb_columns() WHERE table_name = 'events'),
u AS (SELECT unnest([avg((event_id IS NULL)::INT), avg((ts IS NULL)::INT), avg((user_id IS NULL)::INT), avg((event_type IS NULL)::INT), avg((value IS NULL)::INT), avg((props IS NULL)::INT)]) AS share FROM events)
SELECT count(*) AS n_rows, (SELECT count(*)::INT FROM k) AS n_columns, min(ts) AS ts_min, max(ts) AS ts_max, (SELECT max(share) FROM u) AS max_null_share, (SELECT count(*) FILTER (share > 0.1)::INT FROM u) AS n_sparse_columns,
(SELECT string_agg(kind || ':' || c, ',' ORDER BY kind) FROM (SELECT kind, count(*) AS c FROM k GROUP BY 1)) AS column_types, (SELECT round(d, 6) FROM m) AS step_seconds FROM events""")
def q_profile(t: Tables) -> DataFrame:
    return rounded(profile(t.events(), tie=["event_id"]), "step_seconds")


@query("""SELECT 'o_orderkey' AS "column", avg((o_orderkey IS NULL)::INT) AS null_share FROM orders
UNION ALL SELECT 'o_totalprice', avg((o_totalprice IS NULL)::INT) FROM orders
UNION ALL SELECT 'o_orderpriority', avg((o_orderpriority IS NULL)::INT) FROM orders""")
def q_null_share(t: Tables) -> DataFrame:
    return null_share(t.read("orders"), ["o_orderkey", "o_totalprice", "o_orderpriority"])


@query(with_cte("h") + """SELECT series_id, ts, round(value, 6) AS value FROM h
WHERE ts >= (SELECT max(ts) FROM h) - INTERVAL 48 HOUR AND ts <= (SELECT max(ts) FROM h)""")
def q_recent_slice(t: Tables) -> DataFrame:
    # whole hours: the slice is cut from the raw rows, where the filter reaches the scan
    newest = t.events().agg((F.date_trunc("hour", F.max("ts")) + F.expr("INTERVAL 1 HOUR") - F.expr("INTERVAL 1 MICROSECOND")).cast("timestamp_ntz").alias("m"))
    first = newest.select(F.date_trunc("hour", F.col("m") - F.expr("INTERVAL 48 HOURS")).cast("timestamp_ntz")).scalar()
    e = t.events().filter((F.col("ts") >= first) & (F.col("ts") <= newest.scalar())).withColumnRenamed("event_type", "series_id")
    return rounded(ti.downsample(e, "1 hour", {"value": F.avg("value")}), "value")


@query("SELECT event_id, ts, user_id, value FROM events")
def q_union_chunks(t: Tables) -> DataFrame:
    e = t.events().select("event_id", "ts", "user_id", "value")
    cut = F.lit("2024-01-16").cast("timestamp_ntz")
    return ti.union_chunks(e.filter(F.col("ts") < cut), e.filter(F.col("ts") >= cut))


_TARGET = """tg AS (SELECT series_id, ts, value, lead(value, 24) OVER (PARTITION BY series_id ORDER BY ts) AS target_24h FROM g),
tc AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY ts) - 1 AS pos, count(*) OVER (PARTITION BY series_id) AS n
FROM tg WHERE value IS NOT NULL AND target_24h IS NOT NULL),
ts_ AS (SELECT *, CASE WHEN pos < floor(n * 0.8::DOUBLE) THEN 'train' WHEN pos < floor(n * (0.8::DOUBLE + 0.1::DOUBLE)) THEN 'val' ELSE 'test' END AS split FROM tc)"""


def target_split(t: Tables) -> DataFrame:
    rows = ti.lead_target(t.grid(), "value", 24, step="1 hour")
    return ti.temporal_split(ti.drop_incomplete(rows))


@query(with_cte("h", "g", more=_TARGET) + "SELECT series_id, ts, round(value, 6) AS value, round(target_24h, 6) AS target_24h, split FROM ts_")
def q_target_split(t: Tables) -> DataFrame:
    return rounded(target_split(t), "value", "target_24h")


@query(with_cte("h", "g", more=_TARGET) + """SELECT series_id, max(CASE WHEN split = 'train' THEN ts END) < min(CASE WHEN split = 'val' THEN ts END) AS train_before_val,
max(CASE WHEN split = 'val' THEN ts END) < min(CASE WHEN split = 'test' THEN ts END) AS val_before_test,
count(*) FILTER (split = 'train') AS n_train, count(*) FILTER (split = 'val') AS n_val, count(*) FILTER (split = 'test') AS n_test FROM ts_ GROUP BY 1""")
def q_split_integrity(t: Tables) -> DataFrame:
    return ti.split_integrity(target_split(t))


@query(with_cte("h", "g", more="tg AS (SELECT value, lead(value, 24) OVER (PARTITION BY series_id ORDER BY ts) AS target_24h FROM g)") + """SELECT count(*) AS n_before, count(*) FILTER (value IS NOT NULL AND target_24h IS NOT NULL) AS n_after,
count(*) FILTER (value IS NULL OR target_24h IS NULL) AS n_dropped, round(avg((value IS NULL OR target_24h IS NULL)::INT) * 100, 6) AS dropped_pct FROM tg""")
def q_drop_report(t: Tables) -> DataFrame:
    rows = ti.lead_target(t.grid(), "value", 24, step="1 hour")
    return rounded(ti.drop_report(rows, ["value", "target_24h"]), "dropped_pct")
