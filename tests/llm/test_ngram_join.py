"""Components of the shingle join against all pairs, on given and on hard rows."""

import random
import re

import pytest

from tidemark.llm.ngram_join import JoinSpec, keep_first, near_duplicates

SCHEMA = "doc_id long, text string, extra string"


def brute(rows, percent=80):
    """(doc_id -> set size, component) by comparing all pairs."""

    def sets(text):
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        w = re.findall(r"[^\x20\x09-\x0D]+", low)
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())

    items = [(i, sets(t)) for i, t in rows]
    label = {i: i for i, _ in items if i is not None}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for n, (i, s) in enumerate(items):
        for j, t in items[:n]:
            if i is not None and j is not None and s and t and min(len(s), len(t)) * 100 >= percent * max(len(s), len(t)) and 100 * len(s & t) >= percent * len(s | t):
                lo, hi = sorted((root(i), root(j)))
                label[hi] = lo
    return sorted((i is not None, i or 0, len(s), root(i) if i is not None else 0) for i, s in items)


def got(df):
    return sorted((r.doc_id is not None, r.doc_id or 0, r.n_shingles, r.component_id or 0) for r in df.collect())


def mutated(rng, words, share):
    return [w if rng.random() > share else f"x{rng.randrange(10**6)}" for w in words]


def hard_rows(seed=5, n=160):
    rng = random.Random(seed)
    vocab = [f"w{k}" for k in range(400)]
    base = [rng.choice(vocab) for _ in range(120)]
    rows, texts = [], [base]
    for _ in range(n):  # copies of copies around the limit, some cut or extended
        words = mutated(rng, rng.choice(texts[:1] if rng.random() < 0.6 else texts), rng.choice((0.0, 0.01, 0.02, 0.03, 0.05)))
        if rng.random() < 0.3:
            words = words[: rng.randrange(80, len(words))]
        texts.append(words)
    texts += [[rng.choice(vocab) for _ in range(rng.randrange(1, 60))] + base[:50] for _ in range(20)]
    rows = [(k, " ".join(t)) for k, t in enumerate(texts)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("spec", [JoinSpec(), JoinSpec(sketch_bits=6, hot_count=1, filter_bits=8)])
def test_components_equal_all_pairs(spark, spec):
    rows = hard_rows()
    df = spark.createDataFrame([(i, t, "e") for i, t in rows], SCHEMA).repartition(5)
    assert got(near_duplicates(df, spec)) == brute(rows)


def test_given_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in df.collect()]
    assert got(near_duplicates(df)) == brute(rows)


def test_odd_rows(spark):
    rows = [
        (1, None), (2, ""), (3, " \t\n "), (4, "a b"), (5, "A  b"), (6, "a b c d e"), (None, "a b c d e"), (7, "A B C D E"),
        (8, "p q r s t u v"), (8, "a b c d e"), (9, "p q r s t u v"), (6, "a b c d e"), (10, "z " * 40000), (11, "Z " * 40001), (-3, "É b"), (12, "é b"),
    ]
    df = spark.createDataFrame([(i, t, "e") for i, t in rows], SCHEMA)
    assert got(near_duplicates(df)) == brute(rows)
    kept = [(r.doc_id, r.extra) for r in keep_first(df).collect()]
    assert sorted(kept, key=str) == sorted([(i, "e") for i in (1, 2, 3, 4, 6, None, 10, -3, 12)], key=str)
    empty = df.where("doc_id > 100")
    assert near_duplicates(empty).count() == 0 and keep_first(empty).count() == 0
