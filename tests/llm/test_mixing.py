"""Rates against a direct solver, domain totals against targets, odd rows."""

import numpy as np
import pandas as pd
import pytest

from tidemark.llm import mixing as m
from tidemark.llm.queries import op1_mixing


def direct(p, w, target, mu, rounds=200000, floor=None):
    """Plain projected gradient on all rates at once; with ``floor``, distances in the metric of the domains."""
    r = np.ones(len(p))
    scale = np.eye(p.shape[1]) if floor is None else np.linalg.inv((w[:, None] * p).T @ p + floor * np.eye(p.shape[1]))
    for _ in range(rounds):
        new = np.maximum(0, r - (p @ scale @ (p.T @ (w * r) - target) + mu * (r - 1)) / (1 + mu))
        if np.abs(new - r).max() < 1e-10:
            break
        r = new
    return r


def test_given_documents_meet_their_targets(spark):
    out = op1_mixing(spark, "/root/testdata/sf0.01").toPandas()
    spec = m.MixSpec()
    p = out[[f"p_{d}" for d in spec.domains]].to_numpy()
    w = (out.n_tokens / out.n_tokens.sum()).to_numpy()
    target = np.array([spec.target[d] for d in spec.domains])
    assert len(out) == 1000 and (out.rate >= 0).all() and np.allclose(p.sum(1), 1, atol=1e-4)
    assert np.abs(p.T @ (w * out.rate.to_numpy()) - target).max() < 0.001
    assert np.abs(out.rate - direct(p, w, target, spec.mu, floor=spec.floor)).max() < 0.05
    assert (abs(out.copies - out.rate) < 1).all() and abs((w * (out.copies - out.rate)).sum()) < 0.1
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").toPandas()
    both = out.merge(labels, on="doc_id")
    assert (both[both.toxic == 1].p_toxic > 0.5).mean() > 0.8 and (both[both.toxic == 0].p_toxic < 0.5).mean() > 0.95


def test_projection_binds(spark):
    rng = np.random.default_rng(2)
    p = rng.dirichlet((0.3, 0.3, 0.3), 400)
    n = rng.integers(1, 300, 400)
    spec = m.MixSpec(target={"a": 1.0, "b": 0.0, "c": 0.0}, mu=0.05, steps=300, tolerance=2e-5, whiten=False)
    members = spark.createDataFrame([(int(a), [float(v) for v in b]) for a, b in zip(n, p)], "n_tokens long, posteriors array<double>").coalesce(2)
    got, _ = m.rates(p, [np.array(v) for v in m.fit_rates(members, spec).steps], spec.mu)
    want = direct(p, n / n.sum(), np.array([1.0, 0, 0]), spec.mu)
    assert (want == 0).any() and np.abs(got - want).max() < 1e-3


@pytest.mark.parametrize("share", [0.01, 0.003, 0.001])
def test_small_domains_reach_their_targets(spark, share):
    rng = np.random.default_rng(11)
    n = 20000
    group = np.where(np.arange(n) < share * n, 2, np.where(rng.random(n) < 0.3, 1, 0))
    p = np.array([(0.949, 0.05, 0.001), (0.05, 0.949, 0.001), (0.01, 0.01, 0.98)])[group] * rng.uniform(0.8, 1.2, (n, 3))
    p /= p.sum(1, keepdims=True)
    size = np.full(n, 100)
    members = spark.createDataFrame(pd.DataFrame({"n_tokens": size, "posteriors": list(p)}))
    spec = m.MixSpec()
    fit = m.fit_rates(members, spec)
    r, _ = m.rates(p, [np.array(v) for v in fit.steps], spec.mu)
    got = (size / size.sum() * r) @ p
    want = np.array([spec.target[d] for d in spec.domains])
    assert np.abs(got - fit.totals).max() < 1e-9 and abs(np.abs(got - want).max() - fit.unmet) < 1e-9
    assert abs(got[2] - 0.05) < 0.0005 and fit.unmet <= 0.0005 and len(fit.steps) < 20


def test_targets_out_of_reach_are_reported(spark):
    members = spark.createDataFrame([(10, [0.5, 0.5, 0.0])] * 50, "n_tokens long, posteriors array<double>")
    fit = m.fit_rates(members, m.MixSpec())
    assert fit.unmet > 0.04 and len(fit.steps) < 20


def test_copies_of_one_text_are_rounded_each_for_itself(spark):
    docs = spark.createDataFrame([(k, "the same words in every row") for k in range(400)] + [(k, f"other words {k} here") for k in range(400, 500)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, "good"), (450, "low")], "doc_id long, domain string")
    out = m.mix(docs, labels, m.MixSpec(target={"good": 0.3, "low": 0.7})).toPandas()
    same = out[out.doc_id < 400]
    assert same.rate.nunique() == 1 and 0.02 < same.rate.iloc[0] % 1 < 0.98 and same.copies.nunique() == 2
    assert abs(same.copies.mean() - same.rate.iloc[0]) < 0.1


def test_odd_rows(spark):
    rows = [(1, None, "x"), (None, "some words here", "y"), (2, "", "z"), (3, "a b", None), (3, "a b", None), (4, "long " * 50000, "q")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, rate string")
    labels = spark.createDataFrame([(3, 1, 0), (4, 0, 0), (None, 1, 1), (1, None, 0)], "doc_id long, quality int, toxic int")
    marked = m.domain_labels(labels)
    out = m.mix(docs, marked).collect()
    assert len(out) == 6 and all(r.rate >= 0 for r in out) and len({r.rate for r in out if r.doc_id == 3}) == 1
    kept = m.mix(docs, marked, keep=True)
    assert kept.columns[:2] == ["doc_id", "text"] and kept.columns.count("rate") == 1 and kept.count() == 6
    assert {(r.doc_id, round(r.rate, 4)) for r in kept.collect()} == {(r.doc_id, round(r.rate, 4)) for r in out}
    assert m.mix(docs.where("false"), marked).count() == 0
    assert all(r.rate == 1.0 for r in m.mix(docs.where("doc_id < 3 AND text IS NULL"), marked).collect())


def test_rates_beside_texts_come_from_one_python_pass(spark):
    docs = spark.createDataFrame([(k, f"{'good words' if k % 3 else 'bad text'} number {k % 50}") for k in range(3000)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, "good" if k % 3 else "low") for k in range(0, 3000, 2)], "doc_id long, domain string")
    spec = m.MixSpec(target={"good": 0.8, "low": 0.2})
    kept = m.mix(docs, labels, spec, keep=True)
    nodes = [x for x in kept._jdf.queryExecution().executedPlan().toString().splitlines() if "Arrow" in x or "Python" in x]
    assert len(nodes) == 1, nodes
    out = m.mix(docs, labels, spec).toPandas().set_index("doc_id").sort_index()
    beside = kept.toPandas().set_index("doc_id").sort_index()
    assert out.rate.nunique() > 1 and (beside[out.columns] - out).abs().to_numpy().max() < 2e-6 and list(beside.columns) == ["text", "n_tokens", "rate", "p_good", "p_low", "unmet", "copies"]
