"""Held-out accuracy, votes against a direct sort, odd rows."""

import numpy as np

from tidemark.llm import quality_knn as k
from tidemark.llm.queries import op3_quality_knn


def test_held_out_accuracy(spark):
    rows = op3_quality_knn(spark, "/root/testdata/sf0.01").toPandas()
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").toPandas()
    both = rows.merge(labels, on="doc_id")
    held = both[both.held_out]
    assert len(rows) == 1000 and held.shape[0] > 80 and set(rows.predicted) <= {0, 1}
    good, bad = held[held.quality == 1].score, held[held.quality == 0].score
    auc = np.mean([(g > bad).mean() + 0.5 * (g == bad).mean() for g in good])
    print("AUC", auc, "accuracy", (held.predicted == held.quality).mean(), "good kept", (good >= 0.5).mean(), "bad kept", (bad >= 0.5).mean())
    assert auc > 0.95 and (held.predicted == held.quality).mean() > 0.93


def test_votes_by_direct_sort():
    rng = np.random.default_rng(1)
    v = k._unit(rng.standard_normal((60, 5))).astype(np.float32)
    v[30] = v[31]
    space = k.LatentSpace(None, None, v, (rng.random(60) > 0.4).astype(np.float32), 0.6)
    q = np.vstack([k._unit(rng.standard_normal((20, 5))), v[30:31], np.zeros((1, 5))]).astype(np.float32)
    got = k.vote(q, space, 7, 8.0)
    for i, x in enumerate(q):
        sims = [float(x @ y) for y in v]
        least = sorted(sims)[-7]
        w = [max(s, 0) ** 8 if s >= least - 1e-7 else 0 for s in sims]
        want = sum(a * b for a, b in zip(w, space.labels)) / sum(w) if sum(w) > 1e-12 else 0.6
        assert abs(got[i] - want) < 1e-5


def test_odd_rows(spark):
    rows = [(1, None, 1), (None, "plain words in a row", None), (2, "", 3), (3, "a b", 4), (3, "a b", 4), (4, "long " * 60000, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score long")
    labels = spark.createDataFrame([(3, 1), (4, 0), (None, 1), (1, None), (9, 0)], "doc_id long, quality int")
    space = k.fit_space(docs, labels)
    out = k.score(docs, space).collect()
    assert len(out) == 6 and all(0 <= r.score <= 1 for r in out)
    by = {r.doc_id: r.score for r in out}
    assert by[1] == by[2] == 0.5 and by[3] > 0.5 > by[4]
    assert k.fit_space(docs, labels.where("false")) is None
    assert {r.score for r in k.score(docs, None).collect()} == {0.5}
    assert k.score(docs.where("false"), space).count() == 0
