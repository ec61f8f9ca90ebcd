"""Spelling variants against all pairs of the vocabulary."""

import random
import re
import zlib
from collections import Counter

import pytest

from tidemark.llm.spelling import SpellingSpec, acceptor, compose, variants

SCHEMA = "doc_id long, text string, word string, n string, form int"


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute(rows, shortest=5, least=3, factor=2):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= shortest and c >= least}
    by = {w: [v for v in n if near(w, v)] for w in n}
    form = {}
    for w, close in by.items():
        best = min(close, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= factor * n[w] else None

    def root(w):
        return root(form[w]) if form[w] else w

    return sorted((w, form[w], root(w), n[w], len(by[w]), n[form[w]] if form[w] else None) for w in n)


def got(spark, rows, **spec):
    df = spark.createDataFrame([(i, t, "x", "y", 1) for i, t in rows], SCHEMA)
    return sorted((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in variants(df, SpellingSpec(**spec)).collect())


def hard_rows(seed, n=60):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abÀé") for _ in range(rng.randrange(4, 9))) for _ in range(25)] + ["aaaaaa", "aaaaa", "aaaaaaa", "Ababab", "z" * 3000]

    def edited(w):
        k, c = rng.randrange(len(w)), rng.choice("abÀÉ")
        return rng.choice((w, w, w, w[:k] + w[k + 1 :], w[:k] + c + w[k:], w[:k] + c + w[k + 1 :]))

    rows = [(i, " ".join(edited(rng.choice(base)) for _ in range(rng.randrange(40)))) for i in range(n)]
    return rows + [(None, "aaaaaa, aaaaaa"), (3, None), (4, ""), (4, "!! 12"), rows[0], rows[0], (-7, "É" * 3 + "ab×÷")]


@pytest.mark.parametrize("most", [20_000, 2])
def test_against_all_pairs(spark, most):
    for seed in (1, 2):
        assert got(spark, hard_rows(seed), most=most) == brute(hard_rows(seed))


def test_given_documents(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    assert got(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert got(spark, []) == []


def test_acceptor_shares_states_and_composes():
    words = sorted(["tapped", "topped", "tapper", "topper", "tapp"])
    start, arcs = acceptor(words)
    assert len(arcs) == 10  # the tree of prefixes has 18 nodes
    assert compose(start, arcs) == {(a, b) for a in words for b in words if near(a, b) and (len(a), a) < (len(b), b)}


def test_parameters_are_checked():
    with pytest.raises(ValueError):
        SpellingSpec(factor=1)
