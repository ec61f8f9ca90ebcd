"""Removed words against a direct scan of all windows."""

import random
import re
import time

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import substring_dedup
from tidemark.llm.substring_dedup import RepeatSpec, remove_repeats
from tidemark.llm.text import joined, word_hashes

SCHEMA = "doc_id long, text string, kept int, removed string, k1 string"


def brute(rows, window=20):
    seen, out = set(), []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        gone = [False] * len(words)
        for s in range(len(words) - window + 1):
            run = tuple(words[s : s + window])
            if run in seen:
                gone[s : s + window] = [True] * window
            seen.add(run)
        out.append((doc_id is None, doc_id or 0, len(words), sum(gone), " ".join(w for w, g in zip(words, gone) if not g)))
    return sorted(out)


def got(spark, rows, spec=RepeatSpec()):
    df = spark.createDataFrame([(i, t, 1, "x", "y") for i, t in rows], SCHEMA).repartition(5)
    out = remove_repeats(df, spec).collect()
    for r in out:
        assert sum(s.end - s.start for s in r.removed) == r.n_removed
    return sorted((r.doc_id is None, r.doc_id or 0, r.n_words, r.n_removed, r.kept) for r in out)


def hard_rows(seed, n=120, window=20):
    rng = random.Random(seed)
    vocab = [f"w{k}" for k in range(60)] + ["Ä", " x", "a b"]
    passages = [[rng.choice(vocab) for _ in range(rng.choice((window - 1, window, window + 1, 3 * window)))] for _ in range(12)]
    texts = []
    for _ in range(n):
        words = []
        for _ in range(rng.randrange(4)):
            words += [rng.choice(vocab) for _ in range(rng.randrange(30))]
            words += rng.choice(passages)[rng.randrange(3) :]
        if rng.random() < 0.2:
            words += words  # repeats inside one document
        texts.append(rng.choice((" ", "\n", "\t ")).join(words))
    texts += texts[:10] + ["a " * 500, "a " * 70, "a b " * 40, " ".join(passages[0] * 200), "", "  \n", None, "one"]
    rng.shuffle(texts)
    return [(k * 3 - 20, t) for k, t in enumerate(texts)] + [(None, " ".join(passages[3]))]


@pytest.mark.parametrize("window", [20, 7, 1])
def test_against_all_windows(spark, window):
    rows = hard_rows(window, window=window)
    assert got(spark, rows, RepeatSpec(window=window, bits=20)) == brute(rows, window)


def test_full_bitmaps_only_cost_work(spark):
    rows = hard_rows(5)
    assert got(spark, rows, RepeatSpec(bits=20)) == got(spark, rows, RepeatSpec(bits=17)) == brute(rows)


def test_hot_passage_and_copies(spark):
    line = " ".join(f"p{k}" for k in range(25))
    rows = [(k, f"own{k} {line} end{k}") for k in range(300)] + [(1000 + k, f"{line} same copy") for k in range(200)]
    assert got(spark, rows) == brute(rows)


def test_one_id_twice(spark):
    line = " ".join(f"p{k}" for k in range(30))
    same = got(spark, [(1, line), (1, line), (2, line)])
    assert [r[3] for r in same] == [0, 0, 30]
    other = got(spark, [(1, line), (1, line + " more")])
    assert sorted(r[3] for r in other) == [0, 30]


def test_empty_table(spark):
    assert got(spark, []) == []


def test_repeats_next_to_text_ends(spark):
    """Texts of one task stand in one array: no window may reach from one into the next."""
    line = [f"p{k}" for k in range(40)]
    rows = [(k, " ".join(line[k % 20 : k % 20 + 20])) for k in range(60)] + [(100, " ".join(line[:30])), (101, " ".join(line[10:]))]
    rows += [(200 + k, " ".join(line[: 10 + k] + ["x"] * (k % 3))) for k in range(30)]
    df = spark.createDataFrame([(i, t) for i, t in rows], "doc_id long, text string").coalesce(1)
    out = sorted((r.doc_id is None, r.doc_id, r.n_words, r.n_removed, r.kept) for r in remove_repeats(df, RepeatSpec(bits=20)).collect())
    assert out == brute(rows)


def test_hashes_of_words_by_content_alone():
    rng = random.Random(3)
    words = {"".join(rng.choice("ab\0Äß日") for _ in range(n)) for n in [*range(1, 40), 63, 64, 65, 200, 5000] for _ in range(40)}
    words = [w.encode() for w in words]
    rng.shuffle(words)
    one = dict(zip(words, word_hashes(b" ".join(words)).tolist()))
    assert len(set(one.values())) == len(words)
    rng.shuffle(words)
    assert word_hashes(b" ".join(words)).tolist() == [one[w] for w in words]
    for text in (b" a\t\tb ", b"a\nb", b"\v\f\r", b"", None, "a\u00a0b  c\x1cd".encode()):
        assert joined(text) == b" ".join((text or b"").split())


def test_hashing_costs_no_more_than_splitting():
    """A task that hashes and marks all blocks: 6 times the time of splitting its texts before, 1 now."""
    rng = random.Random(4)
    vocab = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 11))) for _ in range(300_000)]
    texts = [" ".join(rng.choices(vocab, k=500)) for _ in range(2000)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["doc_id", "text"])

    class Docs:
        def mapInArrow(self, run, schema):
            return run

    run = substring_dedup._block_marks(Docs(), RepeatSpec())

    def spent(work):
        begin = time.process_time()
        work()
        return time.process_time() - begin

    split = min(spent(lambda: [t.encode().split() for t in texts]) for _ in range(5))
    assert min(spent(lambda: list(run([batch]))) for _ in range(3)) < 3 * split


def test_marks_are_the_distinct_places():
    from tidemark.llm.sketch import bloom_places, mark_rows

    values = np.random.default_rng(5).integers(0, 1 << 62, 5000).astype(np.uint64)
    values[2500:3000] = values[:500]
    rows = mark_rows(values, 18).to_pylist()
    places = [(r["span"] << 16) + int(m) for r in rows for m in np.frombuffer(r["marks"], np.uint16)]
    assert places == sorted(set(np.concatenate(bloom_places(values, 18)).tolist()))
    assert mark_rows(values[:0], 18).num_rows == 0
