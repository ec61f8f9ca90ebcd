"""Forecast error measures as aggregate expressions (one pass, partial aggregation)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EPS = 1e-8


def metric_columns(y: str = "actual", p: str = "predicted") -> list[Column]:
    """rmse, mae, mape, smape, r2 and n over the rows where both sides are present."""
    both = F.col(y).isNotNull() & F.col(p).isNotNull()
    a, f = F.when(both, F.col(y)), F.when(both, F.col(p))
    err = a - f
    total = F.var_pop(a) * F.count(err)
    return [
        F.sqrt(F.avg(err * err)).alias("rmse"),
        F.avg(F.abs(err)).alias("mae"),
        (F.avg(F.abs(err) / (F.abs(a) + EPS)) * 100.0).alias("mape"),
        (F.avg(2.0 * F.abs(err) / (F.abs(a) + F.abs(f) + EPS)) * 100.0).alias("smape"),
        (1.0 - F.sum(err * err) / (total + EPS)).alias("r2"),
        F.count(err).alias("n"),
    ]


def regression_metrics(
    df: DataFrame, y: str = "actual", p: str = "predicted", *, keys: Sequence[str] = ()
) -> DataFrame:
    return df.groupBy(*keys).agg(*metric_columns(y, p))


def weighted_ape(y: str = "actual", p: str = "predicted") -> Column:
    """Sum of absolute errors over sum of absolute actuals: stays finite near zero actuals."""
    return F.sum(F.abs(F.col(y) - F.col(p))) / F.sum(F.abs(F.col(y)))
