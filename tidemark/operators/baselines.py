"""Reference forecasts, model comparison and walk-forward evaluation."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.metrics import metric_columns, regression_metrics
from tidemark.operators.blocks import CELL, DEFAULT_KEYS, attach, halo, with_position


def seasonal_naive(
    df: DataFrame, column: str, season: int = 24, *, keys: Sequence[str] = DEFAULT_KEYS, ts: str = "ts",
    step: str | None = None, size: int | None = None,
) -> DataFrame:
    """Value one season earlier as ``predicted``; the observed value as ``actual``."""
    b = halo(df, keys, ts, before=season, step=step, size=size)
    rows = b.df.withColumn("predicted", F.lag(column, season).over(b.w)).withColumn("actual", F.col(column))
    return b.close(rows)


def mean_baseline(split: DataFrame, column: str, *, keys: Sequence[str] = DEFAULT_KEYS) -> DataFrame:
    """Training mean as the prediction of every validation and test row."""
    means = split.filter(F.col("split") == "train").groupBy(*keys).agg(F.avg(column).alias("predicted"))
    rows = split.filter(F.col("split") != "train").withColumn("actual", F.col(column))
    return attach(rows, means, keys)


def fold_bounds(n: Column, k: int, gap: int, fold: int) -> tuple[Column, Column, Column]:
    """(train end, test start, test end) of fold ``fold`` in 0..k-1 for ``n`` rows."""
    size = F.floor(n / F.lit(k + 1))
    start = n - F.lit(k - fold) * size
    return start - gap, start, start + size


def walk_forward(
    df: DataFrame, *, k: int = 5, gap: int = 24, keys: Sequence[str] = DEFAULT_KEYS, ts: str = "ts",
    tie: Sequence[str] = (), cell: str | None = CELL,
) -> DataFrame:
    """Add ``pos``, ``n_series`` and ``fold`` (the fold a row is tested in, else null).

    Test ranges do not overlap, so the fold is arithmetic on the row number.
    """
    rows = with_position(df, keys, ts, tie=tie, cell=cell, name="pos", total="n_series")
    size = F.floor(F.col("n_series") / F.lit(k + 1))
    first = F.col("n_series") - k * size
    fold = F.floor((F.col("pos") - first) / size)
    return rows.withColumn("fold", F.when((size > 0) & (F.col("pos") >= first), fold))


def fold_train(rows: DataFrame, fold: int, *, k: int = 5, gap: int = 24) -> DataFrame:
    end, _, _ = fold_bounds(F.col("n_series"), k, gap, fold)
    return rows.filter(F.col("pos") < end)


def walk_forward_metrics(scored: DataFrame, *, keys: Sequence[str] = DEFAULT_KEYS) -> DataFrame:
    """Metrics per fold of rows carrying ``fold``, ``actual`` and ``predicted``."""
    return scored.filter(F.col("fold").isNotNull()).groupBy(*keys, (F.col("fold") + 1).alias("fold")).agg(
        *metric_columns()
    )


def walk_forward_summary(per_fold: DataFrame, *, keys: Sequence[str] = DEFAULT_KEYS) -> DataFrame:
    return per_fold.groupBy(*keys).agg(
        F.avg("rmse").alias("cv_rmse_mean"),
        F.stddev_samp("rmse").alias("cv_rmse_std"),
        F.avg("mae").alias("cv_mae_mean"),
        F.avg("r2").alias("cv_r2_mean"),
        F.count("*").alias("n_folds"),
    )


def walk_forward_mean(
    df: DataFrame, column: str, *, k: int = 5, gap: int = 24, keys: Sequence[str] = DEFAULT_KEYS, ts: str = "ts",
    tie: Sequence[str] = (), cell: str | None = CELL,
) -> DataFrame:
    """Walk-forward of the training mean: all folds' means come from one aggregate."""
    rows = walk_forward(df, k=k, gap=gap, keys=keys, ts=ts, tie=tie, cell=cell)
    means = rows.groupBy(*keys).agg(
        F.array(
            *[
                F.avg(F.when(F.col("pos") < fold_bounds(F.col("n_series"), k, gap, i)[0], F.col(column)))
                for i in range(k)
            ]
        ).alias("__means")
    )
    tested = attach(rows.filter(F.col("fold").isNotNull()), means, keys)
    return tested.withColumn("actual", F.col(column)).withColumn(
        "predicted", F.col("__means")[F.col("fold").cast("int")]
    ).drop("__means")


def walk_forward_model(
    rows: DataFrame, fit: Callable[[DataFrame], object], label: str, *, k: int = 5, gap: int = 24,
    keys: Sequence[str] = DEFAULT_KEYS,
) -> DataFrame:
    """Refit any estimator per fold and score the fold's rows; the k folds (a small constant) are fitted at once."""

    def fold(i: int) -> DataFrame:
        scored = fit(fold_train(rows, i, k=k, gap=gap)).transform(rows.filter(F.col("fold") == i))
        return scored.select(*keys, "fold", F.col(label).alias("actual"), F.col("prediction").alias("predicted"))

    with ThreadPoolExecutor(k) as pool:
        parts = list(pool.map(fold, range(k)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return walk_forward_metrics(out, keys=keys)


def compare(named: dict[str, DataFrame], *, baseline: str) -> DataFrame:
    """Metric rows per model and the RMSE improvement over the baseline in percent."""
    out = None
    for name, scored in named.items():
        row = regression_metrics(scored).withColumn("model", F.lit(name))
        out = row if out is None else out.unionByName(row)
    base = out.filter(F.col("model") == baseline).select("rmse").scalar()
    return out.withColumn("__b", base).withColumn(
        "improvement_pct", (F.col("__b") - F.col("rmse")) / F.col("__b") * 100.0
    ).drop("__b")


def best_run(metrics: DataFrame, *, keys: Sequence[str] = (), by: str = "rmse") -> DataFrame:
    """The row with the smallest error per group (ties: smallest name)."""
    rest = [c for c in metrics.columns if c not in keys]
    pick = F.min_by(F.struct(*rest), F.struct(F.col(by), F.col("model")))
    return metrics.filter(F.col(by).isNotNull()).groupBy(*keys).agg(pick.alias("__row")).select(*keys, "__row.*")
