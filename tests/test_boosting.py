"""Boosted trees against a direct solver on small tables; search over many trials."""

import math

import numpy as np
import pandas as pd
import pytest

from tidemark.operators import boosting
from tidemark.operators.boosting import Booster, BoostedModel, TreeParams, search


def table(n=400, seed=9):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3)).round(2)
    y = np.where(x[:, 0] > 0.2, 3.0, -1.0) + x[:, 1] ** 2 + rng.normal(scale=0.2, size=n)
    x[rng.random(x.shape) < 0.1] = np.nan
    return pd.DataFrame({"a": x[:, 0], "b": x[:, 1], "c": x[:, 2], "y": y})


def direct(x, y, cuts, p):
    """Grow the same trees with plain loops over all splits."""
    soft = lambda g: math.copysign(max(abs(g) - p.reg_alpha, 0.0), g)
    worth = lambda g, h: soft(g) ** 2 / (h + p.reg_lambda)
    pred = np.full(len(y), y.mean())

    def grow(rows, grad, depth):
        g, h = grad[rows].sum(), float(len(rows))
        best = None
        for f in range(x.shape[1]):
            v = x[rows, f]
            for c in cuts[f]:
                for missing_left in (False, True):
                    left = (v <= c) | (np.isnan(v) & missing_left)
                    lg, lh = grad[rows][left].sum(), float(left.sum())
                    if min(lh, h - lh) < max(p.min_child_weight, 1e-12):
                        continue
                    gain = 0.5 * (worth(lg, lh) + worth(g - lg, h - lh) - worth(g, h)) - p.gamma
                    if best is None or gain > best[0] + 1e-9:
                        best = gain, left
        if depth == p.max_depth or best is None or best[0] <= 0:
            out[rows] = -soft(g) / (h + p.reg_lambda)
            return
        grow(rows[best[1]], grad, depth + 1)
        grow(rows[~best[1]], grad, depth + 1)

    for _ in range(p.n_estimators):
        out = np.zeros(len(y))
        grow(np.arange(len(y)), pred - y, 0)
        pred = pred + p.learning_rate * out
    return pred


PARAMS = TreeParams(n_estimators=11, learning_rate=0.3, max_depth=3, reg_alpha=1.5, reg_lambda=2.0, gamma=0.1, min_child_weight=4, max_bins=16)


@pytest.fixture(scope="module")
def given(spark):
    pdf = table()
    return pdf, spark.createDataFrame(pdf.assign(k=range(len(pdf)))).repartition(3).cache()


def test_equals_direct_solver(given):
    pdf, df = given
    model = Booster(("a", "b", "c"), "y", PARAMS).fit(df)
    got = model.transform(df).orderBy("k").toPandas()["prediction"].to_numpy()
    assert np.allclose(got, direct(pdf[["a", "b", "c"]].to_numpy(), pdf["y"].to_numpy(), model.cuts, PARAMS), atol=1e-8)
    assert model.importances()[2] < 0.1 < model.importances()[0]


def test_many_blocks_give_the_same_trees(given, monkeypatch):
    pdf, df = given
    one = Booster(("a", "b", "c"), "y", PARAMS).fit(df)
    monkeypatch.setattr(boosting, "BLOCK", 64)
    many = Booster(("a", "b", "c"), "y", PARAMS).fit(df)
    assert [(t.feature, t.split, t.left) for t in many.trees] == [(t.feature, t.split, t.left) for t in one.trees]
    assert np.allclose([v for t in many.trees for v in t.value], [v for t in one.trees for v in t.value])


def test_penalties_and_subsets(given):
    _, df = given
    plain = Booster(("a", "b", "c"), "y", TreeParams(n_estimators=1, max_depth=2, reg_lambda=0.0)).fit(df)
    shrunk = Booster(("a", "b", "c"), "y", TreeParams(n_estimators=1, max_depth=2, reg_lambda=50.0, reg_alpha=5.0)).fit(df)
    assert max(map(abs, shrunk.trees[0].value)) < max(map(abs, plain.trees[0].value))
    assert len(Booster(("a", "b", "c"), "y", TreeParams(n_estimators=1, gamma=1e9)).fit(df).trees[0].feature) == 1
    some = Booster(("a", "b", "c"), "y", TreeParams(n_estimators=9, max_depth=2, colsample_bytree=0.34, subsample=0.5)).fit(df)
    assert all(len({f for f in t.feature if f >= 0}) <= 1 for t in some.trees)
    with pytest.raises(ValueError):
        TreeParams.of({"booster": 1})
    with pytest.raises(ValueError):
        Booster(("a",), "y").fit(df.where("false"))


def test_saved_model_predicts_the_same(spark, given, tmp_path):
    _, df = given
    model = Booster(("a", "b", "c"), "y", PARAMS).fit(df)
    model.save(spark, f"{tmp_path}/m")
    again = BoostedModel.load(spark, f"{tmp_path}/m")
    assert again == model
    a, b = (m.transform(df).orderBy("k").toPandas()["prediction"] for m in (model, again))
    assert (a == b).all()


def test_search_drops_trials_and_keeps_the_best(given):
    _, df = given
    train, val = df.where("k % 4 > 0"), df.where("k % 4 = 0")
    trials = [{"n_estimators": n, "learning_rate": r, "max_depth": d} for n, r, d in ((30, 0.3, 3), (30, 0.001, 3), (30, 0.002, 1), (6, 0.2, 2), (30, 0.25, 4))]
    rows, model, best = search(train, val, ("a", "b", "c"), "y", trials, rungs=(8,), keep=0.5, patience=50)
    assert [r["ended"] for r in rows] == ["complete", "rung 8", "rung 8", "complete", "complete"]
    assert [r["n_trees"] for r in rows] == [30, 8, 8, 6, 30]
    top = min(rows, key=lambda r: r["rmse"])
    assert best == trials[top["trial"]] and len(model.trees) == top["best_trees"]
    got = model.transform(val).toPandas()
    assert math.isclose(math.sqrt(((got["prediction"] - got["y"]) ** 2).mean()), top["rmse"], rel_tol=1e-9)
    # A trial that is not dropped has the losses it has alone.
    alone, _, _ = search(train, val, ("a", "b", "c"), "y", trials[3:4], seed=45, rungs=(), patience=50)
    assert math.isclose(alone[0]["rmse"], rows[3]["rmse"])
