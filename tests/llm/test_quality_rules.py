"""Counts against plain Python, bands at their limits, odd rows."""

import gzip
import random
import re
from pathlib import Path

import pytest
import zstandard

from tidemark.llm.quality_rules import BandRules, base_counts, keep_good, measure, ratios
from tidemark.llm.text import WordHashes


def plain(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    runs = {}
    for k in range(len(w) - 7):
        runs.setdefault(tuple(w[k : k + 8]), []).append(k)
    covered = {k + j for at in runs.values() if len(at) > 1 for k in at for j in range(8)}
    lines, seen, dup = text.split("\n"), set(), 0
    for x in lines:
        if re.search(r"[^\x20\x09-\x0D]", x):
            dup += x in seen
            seen.add(x)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def test_counts_on_random_texts():
    rng, hashes = random.Random(3), WordHashes(limit=5)
    for _ in range(400):
        words = [rng.choice(["a", "b", "ça", "x#", "<|>", "\x1f", "é\x85z"]) for _ in range(rng.randrange(60))]
        text = "".join(w + rng.choice([" ", "\n", "\t ", "\x0b", "\n\n"]) for w in words)
        assert base_counts(text, hashes) == plain(text)


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = measure(docs).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n = plain(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == n
        assert r.base_failed == (n[0] < 20 or 100 * n[4] > 30 * n[0]) and not (r.base_failed and r.kept)
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.001/labels.parquet").collect()}
    good = [r.kept for r in rows if labels.get(r.doc_id) == 1 and r.n_words >= 20]
    assert sum(good) >= 0.99 * len(good)
    assert {r.doc_id for r in keep_good(docs).collect()} == {r.doc_id for r in rows if r.kept}


def test_bands():
    compress = zstandard.ZstdCompressor(level=3).compress
    rng = random.Random(1)
    noise = bytes(rng.randrange(33, 127) for _ in range(9000))
    words = " ".join("".join(rng.choice("etaoinshrdlu") for _ in range(rng.randrange(2, 9))) for _ in range(1500)).encode()
    assert not ratios(noise, BandRules(), compress)[3]  # incompressible
    assert ratios(words, BandRules(), compress)[3]
    assert not ratios(words + b"spam " * 1200, BandRules(), compress)[3]  # one repetitive chunk
    assert not ratios(b"ab " * 500, BandRules(), compress)[3]
    assert ratios(b"", BandRules(), compress) == (None, None, None, True)


def test_odd_rows(spark):
    rows = [(1, None, 1), (2, "", 2), (None, "few words", 3), (3, "w " * 300000, 4), (3, "w " * 300000, 4), (4, "\n \n\t\n", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_words long")
    out = measure(df).collect()
    assert len(out) == 6 and not any(r.kept for r in out) and all(r.base_failed for r in out)
    assert keep_good(df).count() == 0 and keep_good(df).columns == df.columns
    assert measure(df.where("false")).count() == 0


def test_bands_at_lengths_of_natural_prose():
    rules, compress = BandRules(), zstandard.ZstdCompressor(level=3).compress
    assert rules.limits(1 << 22)[1] > rules.limits(1 << 20)[1] > rules.limits(1 << 16)[1] > 3.4
    notes = sorted(Path("/usr/share/doc/git/RelNotes").glob("*"))
    if not notes:
        pytest.skip("no release notes on this machine")
    prose = b"\n".join(gzip.open(p).read() if p.suffix == ".gz" else p.read_bytes() for p in notes)
    for size in (1 << 14, 1 << 16, 200_000, 1 << 20):
        texts = [prose[i : i + size] for i in range(0, len(prose) - size + 1, size)]
        assert texts and all(ratios(t, rules, compress)[3] for t in texts), size
    assert not ratios(prose[:500_000] + prose[:60_000] * 9, rules, compress)[3]  # copies of a part
    assert not ratios(prose[:500_000] + b"buy now, pay later. " * 300 + prose[500_000:900_000], rules, compress)[3]


@pytest.mark.parametrize("name", ["GPL-3", "GPL-2", "LGPL-3", "LGPL-2.1", "Apache-2.0", "CC0-1.0"])
def test_license_texts_are_kept(spark, name):
    path = Path("/usr/share/common-licenses") / name
    if not path.exists():
        pytest.skip("no such text on this machine")
    text = path.read_text()
    row = measure(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert row.kept, (row.ratio, row.chunk_low, row.chunk_high)
