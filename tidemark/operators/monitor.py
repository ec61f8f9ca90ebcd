"""Live accuracy of stored predictions and the resulting action."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.metrics import EPS
from tidemark.operators.blocks import CELL, DEFAULT_KEYS, attach
from tidemark.operators.timeindex import asof_nearest, dedupe, trailing_window

MIN_PREDICTIONS = 10
RMSE_RISE = 0.30
MAPE_RISE = 5.0
BIAS_LIMIT = 2.0


def attach_truth(
    predictions: DataFrame,
    actuals: DataFrame,
    value: str,
    *,
    order: Sequence[str],
    keys: Sequence[str] = DEFAULT_KEYS,
    ts: str = "ts",
    cell: str | None = CELL,
) -> DataFrame:
    """Latest prediction per time with the nearest actual value as ``actual``."""
    latest = dedupe(predictions, keys=keys, ts=ts, order=order, keep="last")
    return asof_nearest(latest, actuals, [value], keys=keys, ts=ts, cell=cell).withColumnRenamed(value, "actual")


def rolling_metrics(
    predictions: DataFrame, hours: int = 72, *, keys: Sequence[str] = DEFAULT_KEYS, ts: str = "ts"
) -> DataFrame:
    """rmse, mae, mape and bias (predicted - actual) of the newest ``hours``.

    Groups with fewer than ten scored rows are left out.
    """
    recent = trailing_window(predictions.dropna(subset=["actual", "predicted"]), hours, keys=keys, ts=ts)
    err = F.col("predicted") - F.col("actual")
    return (
        recent.groupBy(*keys)
        .agg(
            F.sqrt(F.avg(err * err)).alias("rmse"),
            F.avg(F.abs(err)).alias("mae"),
            (F.avg(F.abs(err) / (F.abs("actual") + EPS)) * 100.0).alias("mape"),
            F.avg(err).alias("bias"),
            F.count("*").alias("n_predictions"),
            F.min(ts).alias("window_start"),
            F.max(ts).alias("window_end"),
        )
        .filter(F.col("n_predictions") >= MIN_PREDICTIONS)
    )


def degradation(
    current: DataFrame,
    baseline: DataFrame,
    *,
    keys: Sequence[str] = DEFAULT_KEYS,
    rmse_rise: float = RMSE_RISE,
    mape_rise: float = MAPE_RISE,
    bias_limit: float = BIAS_LIMIT,
) -> DataFrame:
    """Three alerts against the baseline and the action they lead to.

    A baseline group without current metrics is reported as ``no_data``.
    """
    base = baseline.select(*keys, F.col("rmse").alias("base_rmse"), F.col("mape").alias("base_mape"))
    joined = attach(base, current, list(keys))
    rise = (F.col("rmse") - F.col("base_rmse")) / (F.col("base_rmse") + EPS)
    alerts = {
        "alert_rmse": rise > rmse_rise,
        "alert_mape": (F.col("mape") - F.col("base_mape")) > mape_rise,
        "alert_bias": F.abs("bias") > bias_limit,
    }
    flagged = joined.select(
        *keys,
        rise.alias("rmse_rise"),
        (F.col("mape") - F.col("base_mape")).alias("mape_rise"),
        "bias",
        F.col("rmse").isNull().alias("__none"),
        *[F.coalesce(c, F.lit(False)).alias(n) for n, c in alerts.items()],
    )
    count = sum((F.col(n).cast("int") for n in alerts), F.lit(0))
    return flagged.withColumn("n_alerts", count).withColumn(
        "action",
        F.when(F.col("__none"), "no_data").when(F.col("n_alerts") >= 2, "RETRAIN").when(F.col("n_alerts") == 1, "MONITOR")
        .otherwise("OK"),
    ).drop("__none")


# Exposition name, help text and source column of every gauge.
GAUGES = (
    ("model_rmse_live", "RMSE of the live window", "rmse", "%.6f"),
    ("model_mae_live", "MAE of the live window", "mae", "%.6f"),
    ("model_mape_live", "MAPE of the live window", "mape", "%.6f"),
    ("model_bias_live", "Mean signed error of the live window", "bias", "%.6f"),
    ("performance_alerts_total", "Number of degradation alerts", "n_alerts", "%.0f"),
)


def prometheus_lines(metrics: DataFrame, *, keys: Sequence[str] = ()) -> DataFrame:
    """Text exposition rows ``(line_no, line)``; missing metrics are written as 0.

    With ``keys`` every gauge carries the series as labels.
    """
    label = F.lit("")
    if keys:
        parts = [F.concat(F.lit(f'{k}="'), F.col(k).cast("string"), F.lit('"')) for k in keys]
        label = F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))
    rows = []
    for i, (name, text, column, fmt) in enumerate(GAUGES):
        value = F.coalesce(F.col(column).cast("double"), F.lit(0.0)) if column in metrics.columns else F.lit(0.0)
        for j, line in enumerate(
            (
                F.lit(f"# HELP {name} {text}"),
                F.lit(f"# TYPE {name} gauge"),
                F.concat(F.lit(name), label, F.lit(" "), F.format_string(fmt, value)),
            )
        ):
            rows.append(F.struct(F.lit(3 * i + j).alias("line_no"), line.alias("line")))
    lines = metrics.select(F.inline(F.array(*rows)))
    return lines.distinct() if keys else lines
