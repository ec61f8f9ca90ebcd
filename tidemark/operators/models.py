"""Forecast models on feature tables: boosted trees, additive regression, search, selection."""

from __future__ import annotations

import random
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException, IllegalArgumentException
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.metrics import regression_metrics
from tidemark.operators import boosting
from tidemark.operators.blocks import DEFAULT_KEYS, attach, micros
from tidemark.operators.quantiles import exact_quantiles

# Search ranges of the tree model as (low, high, kind).
SEARCH_SPACE = {
    "n_estimators": (100, 800, "int"),
    "learning_rate": (0.005, 0.2, "log"),
    "max_depth": (3, 10, "int"),
    "subsample": (0.5, 1.0, "float"),
    "colsample_bytree": (0.4, 1.0, "float"),
    "min_child_weight": (1, 20, "int"),
    "gamma": (0.0, 3.0, "float"),
    "reg_alpha": (1e-8, 5.0, "log"),
    "reg_lambda": (1e-8, 5.0, "log"),
}


def gbt(features: Sequence[str], label: str, params: dict | None = None, seed: int = 42) -> boosting.Booster:
    """Penalised boosted trees; an unknown parameter is an error."""
    return boosting.Booster(tuple(features), label, boosting.TreeParams.of(params), seed)


def importances(model: boosting.BoostedModel, features: Sequence[str], spark) -> DataFrame:
    """One row with the array ``importances`` in the order of ``features``."""
    share = dict(zip(model.features, model.importances()))
    return spark.range(1).select(F.lit([share[f] for f in features]).alias("importances"))


def score(model, df: DataFrame, label: str) -> DataFrame:
    """Rows with ``actual`` and ``predicted``."""
    return model.transform(df).withColumnRenamed("prediction", "predicted").withColumn("actual", F.col(label))


def draw(rng: random.Random, space: dict = SEARCH_SPACE) -> dict:
    import math

    out = {}
    for name, (lo, hi, kind) in space.items():
        if kind == "int":
            out[name] = rng.randint(lo, hi)
        elif kind == "log":
            out[name] = math.exp(rng.uniform(math.log(lo), math.log(hi)))
        else:
            out[name] = rng.uniform(lo, hi)
    return out


def random_search(
    train: DataFrame,
    val: DataFrame,
    features: Sequence[str],
    label: str,
    *,
    n_trials: int = 50,
    seed: int = 42,
    space: dict = SEARCH_SPACE,
    **halving,
) -> tuple[DataFrame, dict]:
    """Seeded random search by validation RMSE: the trial table and the best parameters.

    All trials grow over one binned table in the same Spark jobs, see :func:`boosting.search` for
    the rule (``rungs``, ``keep``, ``patience``) by which losing trials end.
    """
    rng = random.Random(seed)
    trials = [draw(rng, space) for _ in range(n_trials)]
    rows, _, best = boosting.search(train, val, features, label, trials, seed=seed, **halving)
    table = train.sparkSession.createDataFrame(
        [(r["trial"], r["params"], r["rmse"], r["n_trees"], r["best_trees"], r["ended"]) for r in rows],
        "trial int, params map<string,double>, rmse double, n_trees int, best_trees int, ended string",
    )
    return table, best


# ------------------------------------------------------------------ additive regression

# Seasonal periods in seconds and their number of sine/cosine pairs.
SEASONS = (("year", 365.25 * 86_400, 10), ("week", 7 * 86_400.0, 3), ("day", 86_400.0, 4))
KNOTS = 25
KNOT_RANGE = 0.8


def additive_columns(ts: str, lo: Column, hi: Column) -> list[Column]:
    """Trend, trend breaks on the first 80 % of the range, and Fourier terms."""
    us = micros(ts)
    t = (us - lo) / F.greatest(hi - lo, F.lit(1))
    out = [t.alias("trend")]
    out += [F.greatest(F.lit(0.0), t - KNOT_RANGE * j / (KNOTS + 1)).alias(f"knot_{j}") for j in range(1, KNOTS + 1)]
    for name, period, pairs in SEASONS:
        for k in range(1, pairs + 1):
            angle = F.lit(2.0 * k) * F.pi() * (us / F.lit(period * 1e6))
            out += [F.sin(angle).alias(f"{name}_sin_{k}"), F.cos(angle).alias(f"{name}_cos_{k}")]
    return out


@dataclass
class AdditiveModel:
    """Fitted additive model; ``transform`` adds prediction and the residual band."""

    inner: PipelineModel
    level: DataFrame
    band: tuple[float, float]
    bounds: tuple[int, int]
    keys: list[str]
    ts: str
    names: list[str]

    def transform(self, df: DataFrame) -> DataFrame:
        lo, hi = (F.lit(b) for b in self.bounds)
        rows = attach(df.select("*", *additive_columns(self.ts, lo, hi)), self.level, self.keys)
        out = self.inner.transform(rows)
        p = F.col("prediction") + F.col("__level")
        return out.select(
            *df.columns, p.alias("prediction"), (p + self.band[0]).alias("lower"), (p + self.band[1]).alias("upper")
        )


def fit_additive(
    train: DataFrame, label: str, *, regressors: Sequence[str] = (), keys: Sequence[str] = DEFAULT_KEYS,
    ts: str = "ts", ridge: float = 1e-3, coverage: float = 0.95,
) -> AdditiveModel:
    """Piecewise-linear trend + Fourier seasons + regressors by one least-squares pass.

    Values are taken relative to their series mean and all series share the seasonal
    shape.  The band is the central share of the training residuals.
    """
    keys = list(keys)
    span = train.agg(F.min(micros(ts)).alias("lo"), F.max(micros(ts)).alias("hi")).first()
    lo, hi = F.lit(span.lo), F.lit(span.hi)
    level = train.groupBy(*keys).agg(F.avg(label).alias("__level"))
    extra = additive_columns(ts, lo, hi)
    base = train.select(*keys, ts, label, *regressors).dropna(subset=[ts, label, *regressors])
    rows = attach(base.select("*", *extra), level, keys).withColumn("__y", F.col(label) - F.col("__level"))
    names = [c for c in rows.columns if c.startswith(("trend", "knot_", "year_", "week_", "day_"))] + list(regressors)
    assemble = VectorAssembler(inputCols=names, outputCol="__x")
    linear = LinearRegression(featuresCol="__x", labelCol="__y", predictionCol="prediction", regParam=ridge, solver="normal")
    inner = Pipeline(stages=[assemble, linear]).fit(rows)
    resid = inner.transform(rows).select((F.col("__y") - F.col("prediction")).alias("e"))
    side = (1.0 - coverage) / 2.0
    q = exact_quantiles(resid, ["e"], [side, 1.0 - side]).first().q
    return AdditiveModel(inner, level, (q[0], q[1]), (span.lo, span.hi), keys, ts, names)


# ------------------------------------------------------------------ selection


@dataclass
class Candidate:
    """A named way to fit: ``fit(train)`` returns anything with ``transform``."""

    name: str
    fit: Callable[[DataFrame], object]
    priority: int = 0
    enabled: bool = True


@dataclass
class ColumnModel:
    """Uses an existing column as the prediction (naive forecasts)."""

    column: str

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn("prediction", F.col(self.column))


@dataclass
class MeanModel:
    means: DataFrame
    keys: list[str]

    def transform(self, df: DataFrame) -> DataFrame:
        return attach(df, self.means, self.keys)


def fit_mean(train: DataFrame, label: str, keys: Sequence[str] = DEFAULT_KEYS) -> MeanModel:
    return MeanModel(train.groupBy(*keys).agg(F.avg(label).alias("prediction")), list(keys))


@dataclass
class Selection:
    best: str
    model: object
    metrics: DataFrame
    failures: dict = field(default_factory=dict)


def select_model(train: DataFrame, val: DataFrame, label: str, candidates: Sequence[Candidate]) -> Selection:
    """Fit the enabled candidates by priority and keep the smallest validation RMSE.

    A candidate that cannot be fitted on these data (a value or analysis error) is a row of
    the metrics with its ``error``; other errors are raised.  Without any result it is an error.
    """
    fitted, rows, failures = {}, [], {}
    for c in sorted((c for c in candidates if c.enabled), key=lambda c: c.priority):
        try:
            model = c.fit(train)
            m = regression_metrics(score(model, val, label)).first().asDict()
        except (ValueError, ArithmeticError, AnalysisException, IllegalArgumentException) as exc:
            failures[c.name] = f"{type(exc).__name__}: {exc}"
            rows.append((c.name, *[None] * 5, 0, failures[c.name][:500]))
            continue
        fitted[c.name] = model
        rows.append((c.name, *[None if m[k] is None else float(m[k]) for k in ("rmse", "mae", "mape", "smape", "r2")], int(m["n"]), None))
    scored = [r for r in rows if r[1] is not None]
    if not scored:
        raise RuntimeError(f"no candidate could be evaluated: {failures}")
    best = min(scored, key=lambda r: r[1])[0]
    table = train.sparkSession.createDataFrame(
        rows, "model string, rmse double, mae double, mape double, smape double, r2 double, n bigint, error string"
    )
    return Selection(best, fitted[best], table, failures)


def fit_best(train: DataFrame, val: DataFrame, features: Sequence[str], label: str, **search) -> tuple[boosting.BoostedModel, dict, DataFrame]:
    """Search, then fit the best parameters again on the training rows: (model, parameters, trials)."""
    trials, best = random_search(train, val, features, label, **search)
    return gbt(features, label, best, search.get("seed", 42)).fit(train), best, trials


def evaluate(model, test: DataFrame, label: str, *, keys: Sequence[str] = ()) -> DataFrame:
    """Metrics of a fitted model on held-out rows."""
    return regression_metrics(score(model, test, label), keys=keys)
