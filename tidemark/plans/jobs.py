"""Whole jobs composed from the operators: preprocess, statistics, training, monitoring."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import clean, decompose, drift, features, models, monitor, quality, scoring, stats
from tidemark.operators import timeindex as ti
from tidemark.operators.blocks import DEFAULT_KEYS, attach, null_safe_join
from tidemark.session import cut
from tidemark.sources import files


def preprocess(
    weather: DataFrame,
    market: DataFrame | None = None,
    *,
    market_values: Sequence[str] = (),
    columns: Sequence[str] | None = None,
    keys: Sequence[str] = DEFAULT_KEYS,
    ts: str = "ts",
    step: str = "1 hour",
    iqr_factor: float = 3.0,
    z_threshold: float = 5.0,
) -> DataFrame:
    """Align daily bars on the hourly grid, null outliers twice, flag them, impute.

    The outlier statistics of the second pass are taken on the result of the first.
    """
    rows = weather
    if market is not None:
        hourly = ti.upsample_ffill(market, step, 24, keys=keys, ts=ts)
        rows = ti.asof_backward(weather, hourly, market_values, keys=keys, ts=ts, limit=24, step=step).drop("matched_ts")
    rows = cut(rows)
    columns = list(columns or [c for c in rows.columns if c.startswith(("meteo_", "fin_"))])
    cleaned = clean.remove_outliers_iqr(rows, columns, iqr_factor, flags=True)
    cleaned = cut(clean.remove_outliers_zscore(cleaned, columns, z_threshold))
    return clean.impute(cleaned, columns, keys=keys, ts=ts, step=step)


def statistics_report(
    table: DataFrame, target: str, candidates: Sequence[str], *, keys: Sequence[str] = DEFAULT_KEYS, ts: str = "ts",
    max_lag: int = 24, periods: Sequence[int] = (24, 168),
) -> dict[str, DataFrame]:
    """Stationarity (raw and first difference), STL strengths, lag orders and causality.

    Lag orders are taken on the first difference of the series for which differencing is
    recommended, else on the series itself.  All candidates with over 100 values are tested.
    """
    from tidemark.operators.blocks import halo

    kw = {"keys": keys, "ts": ts}
    b = halo(table.select(*keys, ts, target), keys, ts, before=1)
    moved = b.close(b.df.withColumn("diff_1", F.col(target) - F.lag(target, 1).over(b.w)))
    filled = table.agg(*[F.count(c).alias(c) for c in candidates]).first().asDict()
    chosen = [c for c in candidates if c != target and filled[c] > 100]
    verdict = cut(stats.stationarity(table, target, **kw))
    advice = verdict.select(*keys, F.coalesce("differencing_recommended", F.lit(False)).alias("__differ"))
    chosen_form = attach(moved, advice, keys).withColumn("__order", F.when(F.col("__differ"), F.col("diff_1")).otherwise(F.col(target)))
    return {
        "stationarity": verdict,
        "stationarity_diff": stats.stationarity(moved, "diff_1", **kw),
        **{
            f"strength_{p}": decompose.strengths(decompose.stl(table, target, p, **kw), keys=keys) for p in periods
        },
        "orders": stats.order_suggestion(chosen_form, "__order", **kw),
        **({"granger": stats.granger(table, target, chosen, max_lag, **kw)} if chosen else {}),
    }


def run_training(
    table: DataFrame, spec: features.FeatureSpec, candidates: Sequence[models.Candidate], *, folder: str,
    run_id: str, keys: Sequence[str] = DEFAULT_KEYS, ts: str = "ts",
) -> tuple[models.Selection, DataFrame]:
    """Select on an inner 80/20 split of the training rows, test, log, save tree models."""
    spark = table.sparkSession
    inner = cut(ti.temporal_split(table.filter("split = 'train'").drop("split"), 0.8, 0.2, keys=keys, ts=ts))
    label = spec.target_column
    picked = models.select_model(inner.filter("split = 'train'"), inner.filter("split = 'val'"), label, candidates)
    metrics = models.evaluate(picked.model, table.filter("split = 'test'"), label)
    row = {k: v for k, v in metrics.first().asDict().items() if v is not None}
    files.log_run(spark, f"{folder}/runs", run_id, {"model": picked.best, "horizon": spec.horizon}, row)
    if isinstance(picked.model, models.boosting.BoostedModel) or hasattr(picked.model, "write"):
        names = features.feature_columns(table, spec, keys=keys, ts=ts)
        files.save_model(picked.model, {"model": picked.best, "metrics": row, "feature_names": names, "horizon_h": spec.horizon}, f"{folder}/best", spark)
    return picked, metrics


def run_inference(
    table: DataFrame, train: DataFrame, model, names: Sequence[str], *, folder: str, stamp: str, hours: int = 72,
    width: float = 3.0, keys: Sequence[str] = DEFAULT_KEYS, ts: str = "ts", drift_rows: int = 168, prefix: str = "meteo_",
) -> tuple[DataFrame, DataFrame]:
    """Score the newest ``hours`` of every series, write them as batch ``stamp`` and compare the slice
    with the last training rows: (scored rows, drift per column).

    ``model`` is fitted (``transform`` adds ``prediction``) on the columns ``names``.
    """
    recent = ti.trailing_window(table, hours, keys=keys, ts=ts)
    scored = model.transform(ti.drop_incomplete(recent, list(names))).withColumnRenamed("prediction", "predicted")
    out = cut(scoring.with_band(scored.select(*keys, ts, "predicted"), width=width))
    files.write_predictions(out.withColumn("file", F.lit(f"predictions_{stamp}")), f"{folder}/predictions")
    columns = drift.monitored_columns(table, prefix) or list(names)
    reference = ti.tail_rows(train, drift_rows, keys=keys, ts=ts)
    return out, drift.column_drift(reference.select(*columns), recent.select(*columns), columns)


def monitor_stored(
    spark, predictions: str, actuals: DataFrame, model: str, value: str, *, folder: str,
    keys: Sequence[str] = DEFAULT_KEYS, ts: str = "ts", hours: int = 72, batches: int = 7,
) -> DataFrame:
    """Monitoring job over stored artefacts: newest prediction batches against the model's stored metrics."""
    stored = files.latest_predictions(spark, predictions, batches)
    baseline = files.load_baseline(spark, model)
    if keys:
        baseline = attach(stored.select(*keys).distinct(), baseline)
    return monitor_performance(stored, actuals, baseline, value, folder=folder, order=["file_no"], keys=keys, ts=ts, hours=hours)


def monitor_performance(
    predictions: DataFrame, actuals: DataFrame, baseline: DataFrame, value: str, *, folder: str, order: Sequence[str],
    keys: Sequence[str] = DEFAULT_KEYS, ts: str = "ts", hours: int = 72,
) -> DataFrame:
    """Live metrics, degradation against the baseline, JSON report and exposition text."""
    scored = monitor.attach_truth(predictions, actuals, value, order=order, keys=keys, ts=ts)
    live = cut(monitor.rolling_metrics(scored, hours, keys=keys, ts=ts))
    report = cut(monitor.degradation(live, baseline, keys=keys))
    files.write_report(report, f"{folder}/performance")
    joined = null_safe_join(report.select(*keys, "n_alerts"), live, list(keys), "left")
    files.write_text(monitor.prometheus_lines(joined, keys=keys), f"{folder}/prometheus")
    return report


def monitor_drift(
    train: DataFrame, test: DataFrame | None, *, folder: str, keys: Sequence[str] = DEFAULT_KEYS, ts: str = "ts",
    prefix: str = "meteo_",
) -> DataFrame:
    """Compare the newest test week with the last training month on the base columns."""
    ref, cur = drift.drift_windows(train, test, keys=keys, ts=ts)
    columns = drift.monitored_columns(train, prefix)
    per_column = cut(drift.column_drift(ref.select(*columns), cur.select(*columns)))
    files.write_report(per_column, f"{folder}/drift")
    return drift.drift_summary(per_column, len(columns))


def validated(weather: DataFrame, market: DataFrame | None = None, *, keys: Sequence[str] = (), ts: str = "ts") -> DataFrame:
    """Validation report; raises when a critical check failed."""
    return quality.raise_on_critical(cut(quality.run_validation(weather, market, keys=keys, ts=ts)))
