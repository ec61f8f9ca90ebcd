"""Block primitives against pandas, with blocks and cells small enough to be crossed."""

import numpy as np
import pandas as pd
import pytest
from series_frames import column, frame
from pyspark.sql import functions as F

from tidemark.operators import blocks, clean, features, quantiles
from tidemark.operators import timeindex as ti
from tidemark.operators.blocks import cell_scan

N = 700
GAPS = ((0, 5), (20, 3), (40, 6), (60, 7), (80, 30), (130, 31), (200, 59), (300, 100), (690, 10))


@pytest.fixture(scope="module")
def values():
    v = np.random.default_rng(0).normal(size=N)
    for at, length in GAPS:
        v[at : at + length] = np.nan
    return v


@pytest.fixture(scope="module")
def series(values):
    return pd.Series(values, index=pd.date_range("2024-01-01", periods=N, freq="h"))


@pytest.mark.parametrize("step,size", [(None, 50), ("1 hour", 60), ("1 hour", None)])
def test_imputation_matches_pandas(spark, values, series, step, size):
    df = frame(spark, values)
    first = series.interpolate(method="time", limit=6, limit_direction="forward")
    want = first.ffill(limit=24).bfill(limit=24)
    got = column(clean.impute(df, ["value"], step=step, size=size, cell="2 days"), "value")
    np.testing.assert_allclose(got, want.to_numpy(), equal_nan=True)
    # a gap of 59 keeps exactly five nulls
    assert np.isnan(got[200:259]).sum() == 5


def test_fill_limits(spark, values, series):
    df = frame(spark, values)
    np.testing.assert_allclose(column(clean.forward_fill(df, ["value"], size=40), "value"), series.ffill(limit=24), equal_nan=True)
    np.testing.assert_allclose(column(clean.backward_fill(df, ["value"], size=40), "value"), series.bfill(limit=24), equal_nan=True)


def test_rolling_and_differences_match_pandas(spark, values, series):
    df = frame(spark, values)
    rolled = features.add_rolling(df, "value", size=200, cell="2 days")
    np.testing.assert_allclose(
        column(rolled, "value_roll_std_24h"), series.rolling(24, min_periods=6).std(), equal_nan=True)
    moved = features.add_differences(df, "value", size=200, cell="2 days")
    padded = series.ffill()
    want = (padded / padded.shift(24) - 1).clip(-2, 2)
    np.testing.assert_allclose(column(moved, "value_pct_24h"), want, equal_nan=True)
    np.testing.assert_allclose(column(moved, "value_diff_7d"), series.diff(168), equal_nan=True)


@pytest.mark.parametrize("block", [60, 150, None])
def test_weighted_mean_matches_pandas(spark, values, series, block):
    out = features.add_ewm(frame(spark, values), "value", (24,), step="1 hour", max_block=block)
    np.testing.assert_allclose(column(out, "value_ewm_24h"), series.ewm(span=24, min_periods=1).mean(), rtol=1e-10, equal_nan=True)


def test_quantiles_are_exact(spark):
    v = np.random.default_rng(1).lognormal(size=20_000)
    probs = [0.999, 0.25, 0.5, 0.0, 1.0]
    q = quantiles.exact_quantiles(frame(spark, v), ["value"], probs).first()
    assert q.n == len(v)
    np.testing.assert_allclose(q.q, np.quantile(v, probs), rtol=1e-12)


def test_quantiles_with_one_dominant_value(spark):
    v = np.concatenate([np.full(9_000, 3.0), np.arange(1_000.0)])
    q = quantiles.exact_quantiles(frame(spark, v), ["value"], [0.01, 0.5, 0.95]).first().q
    np.testing.assert_allclose(q, np.quantile(v, [0.01, 0.5, 0.95]))


def test_cell_scan_totals_and_neighbours(spark):
    v = [1.0, np.nan, 3.0, np.nan, np.nan, 6.0]
    out = cell_scan(
        frame(spark, v), ["series_id"], "ts", cell="2 hours", running={"s": F.col("value")},
        totals={"t": F.lit(1)}, prev={"p": F.col("value")}, nxt={"x": F.col("value")},
    ).orderBy("ts").toPandas()
    assert out["s"].tolist() == [1, 1, 4, 4, 4, 10]
    assert set(out["t"]) == {6}
    assert out["p"].tolist() == [1, 1, 3, 3, 3, 6]
    assert out["x"].tolist() == [1, 3, 3, 6, 6, 6]


def test_upsample_friday_to_monday(spark):
    bars = frame(spark, [1.0, 2.0]).withColumn(
        "ts", F.when(F.col("value") == 1.0, F.lit("2024-01-05")).otherwise(F.lit("2024-01-08")).cast("timestamp_ntz"))
    out = ti.upsample_ffill(bars)
    assert (out.count(), out.filter("value is not null").count()) == (73, 26)


def test_asof_limit_and_null_source(spark):
    left = frame(spark, np.arange(40.0))
    right = frame(spark, [5.0]).select("series_id", "ts", F.col("value").alias("close"))
    for step in ("1 hour", None):
        out = ti.asof_backward(left, right, ["close"], limit=24, step=step, cell="5 hours")
        assert out.filter("close is not null").count() == 25
    empty = right.withColumn("close", F.lit(None).cast("double"))
    both = empty.unionByName(right.withColumn("ts", F.col("ts") - F.expr("INTERVAL 1 HOUR")))
    assert ti.asof_backward(left, both, ["close"], limit=24).filter("close is not null").count() == 0


def test_nearest_tie_takes_the_later(spark):
    left = frame(spark, [0.0], start="2024-01-01 01:00")
    right = frame(spark, [1.0, 9.0, 2.0]).filter("value < 9").select("series_id", "ts", F.col("value").alias("x"))
    assert ti.asof_nearest(left, right, ["x"]).first().x == 2.0


def test_lag_on_a_grid_needs_one_shuffle(spark):
    plan = features.add_lags(frame(spark, np.arange(50.0)), "value", [1, 24], step="1 hour")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_split_is_chronological(spark):
    split = ti.temporal_split(frame(spark, np.arange(1000.0)), cell="3 days")
    row = ti.split_integrity(split).first()
    assert row.train_before_val and row.val_before_test
    assert (row.n_train, row.n_val, row.n_test) == (800, 100, 100)


def test_cells_follow_the_number_of_rows(spark, monkeypatch):
    monkeypatch.setattr(blocks, "CELL_ROWS", 50)
    sparse = frame(spark, np.arange(60.0))
    dense = spark.range(6000).select(F.lit("b").alias("series_id"), F.timestamp_micros(F.lit(1704067200000000) + F.col("id") * 36000000).cast("timestamp_ntz").alias("ts"), F.col("id").cast("double").alias("value"))
    df = sparse.unionByName(dense)
    cells = {r.series_id: r["__cells"] for r in blocks.row_spans(df, ["series_id"], "ts").collect()}
    assert cells == {"a": 2, "b": 120}  # 100 times the rows in the same time: no larger cells
    out = blocks.with_position(df, ["series_id"], "ts", name="pos", total="n")
    assert out.filter("pos <> value").count() == 0 and {(r.series_id, r.n) for r in out.select("series_id", "n").distinct().collect()} == {("a", 60), ("b", 6000)}


def test_series_without_a_key_are_kept(spark, monkeypatch):
    monkeypatch.setattr(blocks, "CELL_ROWS", 50)
    rows = spark.range(400).select(
        F.when(F.col("id") < 200, "a").alias("series_id"), F.timestamp_micros(F.lit(1704067200000000) + F.col("id") * 36000000).cast("timestamp_ntz").alias("ts"), (F.col("id") % 200).alias("value"))
    out = blocks.with_position(rows, ["series_id"], "ts", name="pos", total="n")
    assert out.filter("pos = value AND n = 200").count() == 400 and out.filter("series_id IS NULL").count() == 200
    stats = rows.groupBy("series_id").agg(F.count("*").alias("c"))
    assert blocks.spread_join(rows, stats, ["series_id"]).filter("c = 200").count() == 400
    assert blocks.attach(rows, stats, ["series_id"]).filter("c = 200").count() == 400


def _twice(spark, values, **more):
    """The same series under a name and under a null key."""
    return frame(spark, values, series="a", **more).unionByName(frame(spark, values, series=None, **more)).repartition(4)


def _same_for_both(out):
    """Rows of the named and of the null series, equal but for the key."""
    rows = {True: [], False: []}
    for r in out.collect():
        d = r.asDict()
        key = d.pop("series_id")
        rows[key is None].append(tuple(round(v, 8) if isinstance(v, float) else str(v) for v in d.values()))
    assert rows[True] and sorted(rows[True], key=str) == sorted(rows[False], key=str)
    return rows[True]


def test_null_keys_carry_state_between_blocks(spark):
    gapped = [float(k) if k % 11 < 6 else None for k in range(120)]
    twice = _twice(spark, gapped)
    filled = _same_for_both(clean.interpolate(twice, ["value"], 6, size=8, cell="20 hours"))
    assert (5.0 in {r[1] for r in filled}) and sum(r[1] == "None" for r in filled) == 0
    _same_for_both(clean.backward_fill(twice, ["value"], 3, size=8, cell="20 hours"))
    _same_for_both(features.add_ewm(twice, "value", (3, 6), cell="20 hours", max_block=8))
    _same_for_both(features.add_differences(twice, "value", (1, 3), size=8, cell="20 hours"))


def test_null_keys_keep_their_statistics(spark):
    from tidemark.operators import arima, decompose, eda, stats

    rng = np.random.default_rng(41)
    level = 10 + 3 * np.sin(np.arange(300) * np.pi / 6) + np.cumsum(rng.normal(size=300)) / 4
    push = np.roll(level, 1) + rng.normal(size=300)
    twice = _twice(spark, level, other=push)
    assert len(_same_for_both(decompose.decompose(twice, "value", 12, size=40, cell="60 hours"))) == 300
    assert len(_same_for_both(decompose.stl(twice, "value", 12))) == 300
    assert len(_same_for_both(eda.histogram(twice, "value", 8, keys=["series_id"]))) == 8
    _same_for_both(stats.order_suggestion(twice, "value", 12))
    _same_for_both(stats.kpss(twice, "value"))
    _same_for_both(stats.shapiro(twice, "value", cell=50))
    _same_for_both(stats.granger(twice, "value", ["other"], 4, size=60))
    model = arima.fit(twice, "value", season=6, long_order=8, size=80)
    assert model.filter("theta IS NOT NULL").count() == 2
    assert len(_same_for_both(arima.forecast(twice, model, "value", 5, season=6, long_order=8))) == 5
