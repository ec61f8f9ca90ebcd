"""Queries that fit models on the derived hourly series."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.metrics import regression_metrics
from tidemark.operators import arima, clean, eda, features, models
from tidemark.operators import timeindex as ti
from tidemark.operators.baselines import compare, walk_forward, walk_forward_model
from tidemark.plans.registry import Tables, query, rounded
from tidemark.session import cut

SPEC = features.FeatureSpec(target="value", lags=(1, 2, 24, 168), windows=(6, 24), diffs=(1, 24), derived=False)
# The published parameters of the selected model.
BEST = {"n_estimators": 163, "max_depth": 3, "learning_rate": 0.0391, "subsample": 0.883}
_FITTED: dict = {}
_M = ("rmse", "mae", "mape", "smape", "r2")


def feature_table(t: Tables) -> tuple[DataFrame, list[str]]:
    """Features with a time split; cut once because every model fit reads it many times."""
    filled = cut(clean.impute(cut(t.grid()), ["value"], step="1 hour"))
    table = cut(features.build_features(filled, SPEC, step="1 hour"))
    split = cut(ti.temporal_split(table).withColumn("current", F.col("value")))
    names = [c for c in features.feature_columns(split, SPEC) if c != "current"]
    return split, names


def parts(split: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    return tuple(split.filter(F.col("split") == s) for s in ("train", "val", "test"))


def fitted(t: Tables) -> tuple[DataFrame, list[str], object]:
    """Feature table, model columns and the trees fitted once per session and input folder."""
    key = (t.spark.sparkContext.applicationId, t.sf_dir)
    if key not in _FITTED:
        split, names = feature_table(t)
        _FITTED[key] = split, names, models.gbt(names, SPEC.target_column, BEST).fit(parts(split)[0])
    return _FITTED[key]


@query()
def q_gbt(t: Tables) -> DataFrame:
    split, names, model = fitted(t)
    return rounded(models.evaluate(model, parts(split)[2], SPEC.target_column, keys=["series_id"]), *_M)


@query()
def q_importance(t: Tables) -> DataFrame:
    _, names, model = fitted(t)
    return eda.top_importance(names, models.importances(model, names, t.spark), len(names))


@query()
def q_top_importance(t: Tables) -> DataFrame:
    _, names, model = fitted(t)
    return eda.top_importance(names, models.importances(model, names, t.spark), 10)


@query()
def q_search(t: Tables) -> DataFrame:
    split, names = feature_table(t)
    train, val, _ = parts(split)
    trials, _ = models.random_search(train, val, names, SPEC.target_column)
    return rounded(trials.select("trial", "rmse", "n_trees", "best_trees", "ended"), "rmse")


@query()
def q_additive(t: Tables) -> DataFrame:
    split, _ = feature_table(t)
    train, _, test = parts(split)
    regressors = ["value_lag_24h", "value_roll_mean_24h"]
    model = models.fit_additive(train, "value", regressors=regressors)
    out = model.transform(test.select("series_id", "ts", "value", *regressors)).drop(*regressors)
    return rounded(out, "value", "prediction", "lower", "upper", digits=4)


@query()
def q_seasonal_arima(t: Tables) -> DataFrame:
    filled = cut(clean.impute(cut(t.grid()), ["value"], step="1 hour"))
    split = cut(ti.temporal_split(filled))
    train = split.filter("split = 'train'")
    made = arima.forecast(train, arima.fit(train, "value"), "value", 72)
    truth = split.filter("split <> 'train'").select("series_id", "ts", F.col("value").alias("actual"))
    return rounded(made.join(truth, ["series_id", "ts"], "left"), "predicted", "actual", digits=4)


@query()
def q_sarima(t: Tables) -> DataFrame:
    filled = cut(clean.impute(cut(t.grid()), ["value"], step="1 hour"))
    split = cut(ti.temporal_split(filled))
    train = split.filter("split = 'train'")
    made = arima.forecast(train, arima.fit_multiplicative(train, "value"), "value", 72)
    truth = split.filter("split <> 'train'").select("series_id", "ts", F.col("value").alias("actual"))
    return rounded(made.join(truth, ["series_id", "ts"], "left"), "predicted", "actual", digits=4)


@query()
def q_select(t: Tables) -> DataFrame:
    split, names, trees = fitted(t)
    train, val, _ = parts(split)
    label = SPEC.target_column
    picked = models.select_model(
        train, val, label,
        [
            models.Candidate("gbt", lambda d: trees, 1),
            models.Candidate("additive", lambda d: models.fit_additive(d, label), 2),
            models.Candidate("naive", lambda d: models.ColumnModel("current"), 3),
            models.Candidate("mean", lambda d: models.fit_mean(d, label), 4),
        ],
    )
    return rounded(picked.metrics, *_M).withColumn("selected", F.col("model") == picked.best)


@query()
def q_walk_forward_gbt(t: Tables) -> DataFrame:
    split, names = feature_table(t)
    label = SPEC.target_column
    rows = cut(walk_forward(split, k=5))
    fit = lambda d: models.gbt(names, label, BEST).fit(d)
    return rounded(walk_forward_model(rows, fit, label, k=5), *_M)


@query()
def q_compare_models(t: Tables) -> DataFrame:
    split, _, trees = fitted(t)
    test = parts(split)[2]
    label = SPEC.target_column
    scored = {
        "naive": models.score(models.ColumnModel("current"), test, label),
        "gbt": models.score(trees, test, label),
    }
    return rounded(compare(scored, baseline="naive"), *_M, "improvement_pct")
