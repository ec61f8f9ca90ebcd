"""Every stage of the pipeline against a direct version on its own input; odd rows through all."""

import math
import re

import corpus_pipeline as c
import numpy as np
import pytest
import zstandard
from test_ngram_join import brute

from tidemark.llm import decontaminate, pii
from tidemark.llm.quality_rules import BandRules

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for _, stage in c.STAGES:
        before = docs
        docs = stage(spark, docs, SF).cache()
        docs.count()
        out.append((before, docs))
    return out


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def good(text, rules=BandRules()):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    eights = [tuple(words[k : k + 8]) for k in range(len(words) - 7)]
    twice = {w for w in eights if eights.count(w) > 1} if len(eights) < 3000 else set()
    covered = {k + j for k, w in enumerate(eights) if w in twice for j in range(8)}
    if len(words) < 20 or 100 * len(covered) > 30 * len(words):
        return False

    def fits(part):
        low, high = [b[1:] for b in rules.bands if b[0] <= len(part)][-1]
        return low <= len(part) / len(zstandard.ZstdCompressor(level=3).compress(part)) <= high

    raw = text.encode()
    parts = [raw[k : k + 4096] for k in range(0, len(raw), 4096)] if len(raw) > 4096 else []
    return fits(raw) and all(fits(p) for k, p in enumerate(parts) if k == 0 or len(p) >= 2048)


def test_quality(stages):
    before, after = map(rows, stages[0])
    short = {i for i, r in before.items() if len(r.text) < 15000}
    assert {i for i in after if i in short} == {i for i in short if good(before[i].text)} and stages[0][0].columns == stages[0][1].columns


def test_duplicates(stages):
    before, after = map(rows, stages[1])
    assert set(after) == {i for _, i, _, component in brute([(i, r.text) for i, r in before.items()]) if i == component}


def test_decontamination(spark, stages):
    before, after = map(rows, stages[2])
    codes, bench = decontaminate.TokenCodes(), {}
    for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        h = decontaminate.template_windows(r.text, codes, 6, 4)[0].tolist()
        bench[r.item_id] = h
    gone = set()
    for i, r in before.items():
        mine = decontaminate.template_windows(r.text, codes, 6, 4)[0].tolist()
        for h in bench.values():
            for shift in {mine.index(x) - h.index(x) for x in h if x in mine}:
                same = sum(0 <= k + shift < len(mine) and mine[k + shift] == x for k, x in enumerate(h))
                if same >= 0.3 * len(h):
                    gone.add(i)
    assert gone and set(before) - set(after) == gone


def test_masking(stages):
    before, after = map(rows, stages[3])
    assert set(before) == set(after)
    model = pii.fit_spans(stages[3][0])
    for i, r in before.items():
        assert after[i].text == pii.masked(r.text, model) and not pii.base_spans(after[i].text)
        assert after[i].n_chars == (len(after[i].text) if after[i].text != r.text else r.n_chars)


def test_mixture(stages):
    before, after = stages[4]
    out = after.toPandas()
    assert len(out) == before.count() and list(out.columns[:5]) == before.columns
    w = out.n_tokens / out.n_tokens.sum()
    assert abs((w * out.rate * out.p_good).sum() - 0.85) < 0.02 and (out.rate >= 0).all()


def test_odd_rows_pass_all_stages(spark):
    text = " ".join(f"word{k * 7919 % 1000}" for k in range(90))
    data = [(1, text, None, "s", 5), (None, text + " tail", "en", None, None), (2, None, None, None, None), (3, "", "en", "s", 0), (1, text, None, "s", 5), (4, "x " * 40000, "en", "s", 3)]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
    for some in (docs, docs.where("false")):
        for _, stage in c.STAGES:
            some = stage(spark, some, SF)
        assert not math.isnan(sum(r.rate for r in some.collect()))
    assert np.all([f(spark, docs, SF).columns == docs.columns for _, f in c.STAGES[:4]])
