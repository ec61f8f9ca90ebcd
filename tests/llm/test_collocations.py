"""Phrases, scores and paths against direct counts."""

import random
import re
from collections import Counter, defaultdict

import pytest

from tidemark.llm.collocations import CollocationSpec, build_graph, mine, unary_paths

SCHEMA = "doc_id long, lang string, text string, a long, phrase string, x int"


def counts(rows):
    f = defaultdict(Counter)
    for lang, text in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            w = re.findall("[^\x20\x09]+", piece)
            for size in (1, 2, 3):
                f[lang or ("und" if lang is None else lang)].update(tuple(w[i : i + size]) for i in range(len(w) - size + 1))
    return f


def brute(rows, least=10, inside=50, top=2000):
    out = []
    for lang, f in counts(rows).items():
        n = sum(c for k, c in f.items() if len(k) == 1)
        candidates = {k: c for k, c in f.items() if len(k) > 1 and c >= least}
        rows_ = []
        for k, a in candidates.items():
            if len(k) == 2 and any(len(t) == 3 and k in (t[:2], t[1:]) and 100 * c >= inside * a for t, c in candidates.items()):
                continue
            score, cut = min((1000000 * a * a // (f[k[:i]] * f[k[i:]]), i) for i in range(1, len(k)))
            rows_.append((-score, -a, " ".join(k).encode(), f[k[:cut]], f[k[cut:]]))
        out += [(lang, i + 1, p.decode(), -a, l, r, n, -s) for i, (s, a, p, l, r) in enumerate(sorted(rows_)[:top])]
    return sorted(out)


def frame_of(spark, rows):
    return spark.createDataFrame([(1, lang, text, 1, "p", 1) for lang, text in rows], SCHEMA).repartition(4)


def got(spark, rows, **spec):
    found = mine(frame_of(spark, rows), CollocationSpec(**{"bits": 20, **spec})).collect()
    return sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in found)


def hard_rows(seed, n=150):
    rng = random.Random(seed)
    vocab = ["a", "B", "ab", "Ä", "ä", "x<|>", " ", "w1", "W2", "w 3", "é", "q"]
    fixed = ["New York City Hall", "in spite of", "a a a a", "Ä Ä ä"]
    rows = []
    for _ in range(n):
        words = []
        for _ in range(rng.randrange(25)):
            words.append(rng.choice(fixed) if rng.random() < 0.3 else rng.choice(vocab))
            words.append(rng.choice((" ", " ", " ", "\t", ". ", ",", "\n", "\r\n", " \x0b", "!?")))
        rows.append((rng.choice(("en", "de", None, "l l", "")), "".join(words)))
    return rows + [("en", None), (None, ""), ("fr", "...")] + rows[:20] + [("en", "long word " * 3000)]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_direct_counts(spark, seed):
    assert got(spark, hard_rows(seed)) == brute(hard_rows(seed))


def test_parameters_and_small_buckets(spark):
    rows = hard_rows(3)
    assert got(spark, rows, least=3, inside=80, top=7, bucket=500, bits=16) == brute(rows, 3, 80, 7)


def test_exact_beyond_64_bits():
    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F

    from tidemark.llm.collocations import _score

    spark = SparkSession.getActiveSession()
    a, left, right = 9_999_999_999, 10_000_000_000, 9_999_999_999
    row = spark.range(1).select(_score(*[F.lit(v).cast("long") for v in (a, left, right)]).alias("s")).first()
    assert row.s == 1000000 * a * a // (left * right)


def test_unary_paths(spark):
    text = ["one two three four five six"] * 12 + ["zero one two three four other"] * 12 + ["loop loop loop loop"] * 12 + ["p q r p q r p"] * 12
    paths = {(r.phrase, r.a) for r in unary_paths(build_graph(frame_of(spark, [("en", t) for t in text]), CollocationSpec(bits=20))).collect()}
    # "one two" is no unary node (half its flow comes from "zero"), "two three" is.
    assert paths == {
        ("zero one two", 12), ("one two three four", 24), ("three four five six", 12), ("three four other", 12),
        ("loop loop loop", 24), ("p q r p", 24), ("r p q", 12),
    }


def test_long_path_is_one_row(spark):
    line = " ".join(f"k{i}" for i in range(300))
    found = unary_paths(build_graph(frame_of(spark, [("en", line)] * 11), CollocationSpec(bits=20))).collect()
    assert [(r.phrase, r.n_words, r.a) for r in found] == [(line, 300, 11)]


def test_empty_table(spark):
    assert got(spark, []) == []
