"""Online features against a row-by-row reference, over several micro-batches, and against the SQL on odd rows."""

import os
from datetime import datetime, timedelta

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from oracle import compare
from pyspark.sql import functions as F

from tidemark.operators import blocks
from tidemark.plans import all_queries
from tidemark.streaming import streams

START = datetime(2024, 1, 1)
SCHEMA = "series_id string, ts timestamp_ntz, event_id bigint, value double"
LAGS, WINDOWS, SPANS, DELAY = (1, 5, 30), (1, 24), (2, 6), 5


def write(folder, number, rows):
    """One file of rows; later numbers are newer files."""
    names = ("series_id", "ts", "event_id", "value")
    types = (pa.string(), pa.timestamp("us"), pa.int64(), pa.float64())
    table = pa.table({n: pa.array([r[i] for r in rows], t) for i, (n, t) in enumerate(zip(names, types))})
    path = f"{folder}/f{number}.parquet"
    pq.write_table(table, path)
    os.utime(path, (1_700_000_000 + number, 1_700_000_000 + number))


def batches(n=700, seed=5):
    """Rows of three series (one without a key), out of order by up to four hours, with nulls, ties and late rows."""
    rng = np.random.default_rng(seed)
    rows = []
    for name, share in (("a", 1.0), (None, 0.6), ("b", 0.3)):
        for i in range(int(n * share)):
            at = START + timedelta(hours=i // 2 * 2, microseconds=700)  # two rows share a time
            x = None if i % 11 == 3 or (name == "b" and i > 60) else float(rng.normal(10, 5))
            rows.append((name, at, int(rng.integers(1, 2**40)), x))
    rows.sort(key=lambda r: r[1] + timedelta(hours=float(rng.uniform(0, 4))))
    parts = [rows[: len(rows) // 2], rows[len(rows) // 2 : len(rows) * 3 // 4], rows[len(rows) * 3 // 4 :]]
    parts[1].append(("a", START + timedelta(hours=2), 1, 1e6))  # far behind the mark
    parts[1].append(("a", None, 2, 1e6))
    parts[1].append(("a", parts[1][0][1], 3, float("nan")))
    return parts


def reference(parts):
    waiting, mark, past, sums, out = [], None, {}, {}, []
    for part in parts:
        waiting += [r for r in part if r[1] is not None and (mark is None or r[1] > mark)]
        top = max(r[1] for r in waiting)
        reached = top.replace(microsecond=top.microsecond // 1000 * 1000) - timedelta(hours=DELAY)
        mark = reached if mark is None else max(mark, reached)
        for key, ts, _, x in sorted((r for r in waiting if r[1] <= mark), key=lambda r: (r[1], r[2])):
            x = None if x is None or x != x else x
            seen = past.setdefault(key, [])
            seen.append(x)
            row = [seen[-1 - k] if len(seen) > k else None for k in LAGS]
            for w in WINDOWS:
                have = [v for v in seen[-w:] if v is not None]
                row.append(sum(have) / len(have) if len(have) >= max(1, w // 4) else None)
            for s in SPANS:
                fade = 1.0 - 2.0 / (s + 1.0)
                top, bottom = sums.get((key, s), (0.0, 0.0))
                top, bottom = top * fade + (x or 0.0), bottom * fade + (x is not None)
                sums[key, s] = (top, bottom)
                # rows without a value keep the last mean, however many they are
                row.append(top / bottom if bottom > 1e-250 else None)
            out.append((key, ts, x, *row))
        waiting = [r for r in waiting if r[1] > mark]
    return out


def run(spark, source, out, state):
    df = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
    streams.online_features(
        df, "value", out, state, tie=["event_id"], lags=LAGS, windows=WINDOWS, spans=SPANS, delay=f"{DELAY} hours"
    ).awaitTermination()
    return spark.read.parquet(out)


def check(got, want):
    key = lambda r: (r[0] is None, r[0] or "", r[1])
    # rows of one time leave in the order of their ids, which the values behind them tell apart
    got = sorted((tuple(r) for r in got.drop("batch_id").collect()), key=lambda r: (key(r), str(r[2:])))
    want = sorted(want, key=lambda r: (key(r), str(r[2:])))
    assert [r[:2] for r in got] == [r[:2] for r in want]
    a, b = (np.array([r[2:] for r in rows], dtype=float) for rows in (got, want))
    np.testing.assert_allclose(a, b, rtol=1e-9, equal_nan=True)


def test_online_features_go_on_over_batches(spark, tmp_path, monkeypatch):
    """Two batches in one run, a third after a restart from the checkpoint."""
    monkeypatch.setattr(streams, "RANGE_ROWS", 100)
    monkeypatch.setattr(blocks, "BLOCK_ROWS", 50)
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    os.makedirs(source)
    parts = batches()
    for i, part in enumerate(parts):
        write(source, i, part)
        if i:
            got = run(spark, source, out, state)
    assert got.select("batch_id").distinct().count() == 3
    check(got, reference(parts))


def test_online_features_without_sums(spark, tmp_path):
    source = str(tmp_path / "in")
    os.makedirs(source)
    for i, part in enumerate(batches(60)):
        write(source, i, part)
    df = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
    out = str(tmp_path / "out")
    streams.online_features(df, "value", out, str(tmp_path / "state"), tie=["event_id"], lags=(1,), windows=(), spans=(), delay="5 hours").awaitTermination()
    got = spark.read.parquet(out)
    want = [(*r[:3], r[3]) for r in reference(batches(60))]
    assert got.columns == ["series_id", "ts", "value", "value_lag_1h", "batch_id"]
    check(got, want)


def test_online_features_hold_no_series_in_a_task(spark, tmp_path, monkeypatch):
    """One series, most of it at one time, still is many ranges and the rows stay in order over their edges."""
    monkeypatch.setattr(streams, "RANGE_ROWS", 500)
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    os.makedirs(source)
    n = 6000
    rows = [("a", START + timedelta(minutes=max(0, i - 5000)), i, float(i)) for i in range(n)]
    write(source, 0, [rows[i] for i in np.random.default_rng(1).permutation(n)])
    df = spark.readStream.schema(SCHEMA).parquet(source)
    streams.online_features(df, "value", out, state, tie=["event_id"], lags=(1, 24), windows=(24,), spans=(6,)).awaitTermination()
    ranges = spark.read.parquet(f"{state}/features/ready").groupBy(F.shiftright("__at", 33)).count().toPandas()
    assert len(ranges) >= n // 500 - 2 and ranges["count"].max() <= 1000
    got = spark.read.parquet(out).orderBy("value").toPandas()
    assert len(got) == 5940 and got["value"].tolist() == list(range(5940))
    assert (got["value"] - got["value_lag_1h"])[1:].eq(1).all() and (got["value"] - got["value_lag_24h"])[24:].eq(24).all()
    np.testing.assert_allclose(got["value_roll_mean_24h"][24:], got["value"][24:] - 11.5)
    np.testing.assert_allclose(got["value_ewm_6h"][200:], got["value"][200:] - 2.5)


@pytest.mark.parametrize("n", [0, 400])
def test_query_orders_tied_times_by_id(spark, tmp_path, n):
    """Rows of one time follow their ids, not their values; rows without a key, a value or a time as the SQL has them."""
    rng = np.random.default_rng(2)
    table = pa.table({
        "event_id": pa.array(rng.permutation(n), pa.int64()),
        "ts": pa.array([None if i % 97 == 5 else START + timedelta(minutes=15 * (i // 8)) for i in range(n)], pa.timestamp("us")),
        "user_id": pa.array([1] * n, pa.int64()),
        "event_type": pa.array([(None, "view", "click")[i % 3] for i in range(n)], pa.string()),
        "value": pa.array([None if i % 13 == 1 else round(float(rng.uniform(0, 100)), 2) for i in range(n)], pa.float64()),
        "props": pa.array(["{}"] * n, pa.string()),
    })
    pq.write_table(table, tmp_path / "events.parquet")
    q = all_queries()["q_stream_features"]
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{tmp_path}/events.parquet')")
    got = q.run(spark, str(tmp_path)).toPandas()
    assert compare(got, con.execute(q.sql).df()) is None and (len(got) > 0) == (n > 0)
