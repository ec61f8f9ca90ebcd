"""Whole jobs end to end on small series: training, inference, monitoring, validation, test battery."""

import numpy as np
import pytest
from series_frames import column, frame
from pyspark.sql import functions as F

from tidemark.operators import arima, drift, features, models, quality, scoring
from tidemark.operators import timeindex as ti
from tidemark.operators.baselines import compare
from tidemark.plans import jobs
from tidemark.sources import files


def wave(n, seed, level=15.0):
    rng = np.random.default_rng(seed)
    return level + 6 * np.sin(np.arange(n) * 2 * np.pi / 24) + rng.normal(0, 0.3, n)


@pytest.fixture(scope="module")
def table(spark):
    spec = features.FeatureSpec(target="value", lags=(1, 24), windows=(6,), diffs=(1,), derived=False)
    df = frame(spark, wave(900, 3)).unionByName(frame(spark, wave(900, 4), series="b"))
    built = features.build_features(df, spec, step="1 hour").dropna()
    return spec, ti.temporal_split(built).cache()


@pytest.fixture(scope="module")
def trained(spark, table, tmp_path_factory):
    spec, split = table
    folder = str(tmp_path_factory.mktemp("jobs"))
    names = features.feature_columns(split, spec)
    label = spec.target_column
    candidates = [
        models.Candidate("trees", lambda d: models.gbt(names, label, {"n_estimators": 30, "learning_rate": 0.3}).fit(d), 1),
        models.Candidate("naive", lambda d: models.ColumnModel("value"), 2),
        models.Candidate("broken", lambda d: models.gbt(names, label, {"booster": 1.0}).fit(d), 3),
    ]
    picked, metrics = jobs.run_training(split, spec, candidates, folder=folder, run_id="r1")
    return folder, names, picked, metrics


def test_training_logs_and_saves(spark, trained):
    folder, names, picked, metrics = trained
    assert picked.best in ("trees", "naive") and "booster" in picked.failures["broken"]
    errors = {r.model: r.error for r in picked.metrics.collect()}
    assert errors["trees"] is None and "unknown" in errors["broken"]
    assert files.best_logged_run(spark, f"{folder}/runs").first().run_id == "r1"
    stored = files.load_baseline(spark, f"{folder}/best").first()
    assert abs(stored.rmse - metrics.first().rmse) < 1e-9
    model, meta = files.load_model(f"{folder}/best", spark)
    assert meta["feature_names"] == names and model.transform


def test_inference_writes_a_batch_and_compares(spark, table, trained):
    spec, split = table
    folder, names, picked, _ = trained
    out, moved = jobs.run_inference(split, split.filter("split = 'train'"), picked.model, names, folder=folder, stamp="20240301", prefix="value")
    assert out.count() == 2 * 73 and {"lower", "upper"} <= set(out.columns)
    back = files.latest_predictions(spark, f"{folder}/predictions")
    assert back.count() == out.count() and {r.file for r in back.select("file").distinct().collect()} == {"predictions_20240301"}
    assert moved.count() == len(drift.monitored_columns(split, "value"))


def test_monitoring_against_stored_metrics(spark, table, trained, tmp_path):
    _, split = table
    folder, names, picked, _ = trained
    jobs.run_inference(split, split, picked.model, names, folder=str(tmp_path), stamp="20240302")
    actuals = split.select("series_id", "ts", F.col("target_24h").alias("value"))
    report = jobs.monitor_stored(spark, f"{tmp_path}/predictions", actuals, f"{folder}/best", "value", folder=str(tmp_path))
    rows = {r.series_id: r for r in report.collect()}
    assert set(rows) == {"a", "b"} and all(r.action in ("OK", "MONITOR", "RETRAIN") for r in rows.values())
    assert spark.read.json(f"{tmp_path}/performance").count() == 2


def test_unreadable_batches_are_named(spark, tmp_path):
    df = frame(spark, [1.0, 2.0]).withColumn("file", F.concat(F.lit("predictions_2024010"), F.col("value").cast("int").cast("string")))
    path = str(tmp_path / "predictions_2024" / "all")
    files.write_predictions(df, path)
    assert files.latest_predictions(spark, path, 1).first().value == 2.0
    bad = tmp_path / "predictions_2024" / "all" / "file=predictions_20240109"
    bad.mkdir()
    (bad / "part-0.parquet").write_bytes(b"PAR1 this is no table PAR1")
    with pytest.warns(UserWarning, match="predictions_20240109"):
        assert files.latest_predictions(spark, path, 3, skip_unreadable=True).count() == 2


def test_drift_job_and_null_columns(spark, table, tmp_path):
    _, split = table
    shifted = split.filter("split = 'test'").withColumn("value", F.col("value") + 8.0).withColumn("value_none", F.lit(None).cast("double"))
    train = split.filter("split = 'train'").withColumn("value_none", F.lit(None).cast("double"))
    row = jobs.monitor_drift(train, shifted, folder=str(tmp_path), prefix="value").first()
    assert row.n_drifted == 1 and row.n_total == 2 and row.dataset_drift and not row.majority_drift
    per = {r.column: r for r in drift.column_drift(train, shifted, ["value", "value_none"]).collect()}
    assert per["value_none"].n_ref == 0 and per["value_none"].psi is None and not per["value_none"].drifted
    wide = train.select(*[F.col("value").alias(f"c{k}") for k in range(12)])
    assert drift.priority_psi(wide, wide).count() == 12


def test_validation_of_both_sides(spark):
    flat = {"relative_humidity_2m": 50.0, "wind_speed_10m": 3.0, "precipitation": 0.0, "surface_pressure": 1013.0, "shortwave_radiation": 100.0}
    weather = frame(spark, wave(48, 1)).withColumnRenamed("value", "meteo_temperature_2m").drop("series_id")
    with pytest.raises(ValueError, match="column_exists"):
        jobs.validated(weather)
    weather = weather.withColumns({f"meteo_{c}": F.lit(v) for c, v in flat.items()})
    assert jobs.validated(weather).count() == quality.run_validation(weather, None, keys=()).count() > 5


def test_battery_orders_follow_the_verdict(spark):
    rng = np.random.default_rng(6)
    noise, walk = rng.normal(size=600), np.cumsum(rng.normal(size=600))
    df = frame(spark, noise, x=rng.normal(size=600)).unionByName(frame(spark, walk, series="w", x=rng.normal(size=600)))
    out = jobs.statistics_report(df, "value", ["x", "value"], max_lag=4, periods=())
    verdict = {r.series_id: r.differencing_recommended for r in out["stationarity"].collect()}
    assert verdict == {"a": False, "w": True}
    orders = {r.series_id: r for r in out["orders"].collect()}
    # differenced noise would be an over-differenced moving average with a strong first lag
    assert orders["a"].n_significant_acf < 12 and {r.series_id for r in out["granger"].collect()} == {"a", "w"}


def test_batches_are_split_not_dropped(spark):
    rows = spark.range(400).select(F.lit("u").alias("user"), "id", F.create_map(F.lit("k"), F.lit(1.0)).alias("features"))
    batches = scoring.collect_batches(rows, ["user"], ["id"], ["id", "features"])
    assert sorted(r.n for r in batches.select(F.size("requests").alias("n")).collect()) == [64, 168, 168]
    accepted, rejected = scoring.explode_batches(batches)
    assert accepted.count() == 400 and rejected.count() == 0


def test_search_refits_and_additive_and_arima(spark, table):
    spec, split = table
    names = ["value", "value_lag_24h"]
    space = {"n_estimators": (2, 4, "int"), "max_depth": (2, 3, "int")}
    model, best, trials = models.fit_best(split.filter("split = 'train'"), split.filter("split = 'val'"), names, spec.target_column, n_trials=2, space=space)
    assert set(best) == set(space) and trials.count() == 2
    assert models.evaluate(model, split.filter("split = 'test'"), spec.target_column).first().rmse < 6
    additive = models.fit_additive(split.filter("split = 'train'"), "value", regressors=["value_lag_24h"])
    assert np.isfinite(column(additive.transform(split.filter("split = 'test'")), "prediction")).all()
    series = split.select("series_id", "ts", "value")
    made = arima.forecast(series, arima.fit(series, "value"), "value", 24)
    assert made.count() == 48 and np.abs(column(made, "predicted") - 15).max() < 12
    scored = {"n": models.score(models.ColumnModel("value"), split, spec.target_column)}
    assert compare(scored, baseline="n").first().improvement_pct == 0
