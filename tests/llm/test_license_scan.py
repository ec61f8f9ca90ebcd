"""Notices in given documents, alignment against a full table, edited and odd texts."""

import random
import re

import numpy as np

from tidemark.llm import license_scan as s


def test_given_notices(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    notices = {name: text for name, (_, text) in s.TEMPLATES.items() if name.endswith("notice")}
    want = {(r.doc_id, name, m.start()) for r in docs.collect() for name, text in notices.items() for m in re.finditer(re.escape(text), r.text)}
    got = s.scan(docs).collect()
    assert want and {(r.doc_id, r.template, r.start) for r in got} >= want
    assert len({r.doc_id for r in got}) == len({w[0] for w in want})
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert all(r.coverage >= 0.75 and 0 <= r.start < r.end <= len(texts[r.doc_id]) for r in got)


def lcs(a, b, shift, band):
    t = np.zeros((len(a) + 1, len(b) + 1), int)
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            t[i, j] = max(t[i + 1, j], t[i, j + 1])
            if a[i] == b[j] and abs(j - i - shift) <= band:
                t[i, j] = max(t[i, j], 1 + t[i + 1, j + 1])
    return t[0, 0]


def test_alignment_equals_full_table():
    rng = random.Random(4)
    for _ in range(300):
        a = [rng.randrange(6) for _ in range(rng.randrange(1, 14))]
        b = [rng.randrange(6) for _ in range(rng.randrange(1, 30))]
        shift, band = rng.randrange(0, 10), rng.randrange(1, 6)
        matched, first, last = s.align(a, b, shift, band)
        assert matched == lcs(a, b, shift, band)
        assert (first < 0) == (matched == 0) and (matched == 0 or last - first + 1 >= matched)


def test_every_shared_run_has_a_common_fingerprint():
    rng = random.Random(8)
    spec = s.ScanSpec()
    words = np.array([rng.randrange(2, 50) for _ in range(400)], np.uint64)
    mine = set(s.windows(words[100:140], spec.gram).tolist())
    for k in range(100, 136):
        run = words[k : k + spec.gram + spec.window - 1]
        assert set(s.winnow(np.concatenate([words[:7], run, words[9:20]]), spec)[1].tolist()) & set(s.windows(run, spec.gram).tolist()) & (mine | set(s.windows(run, spec.gram).tolist()))


def test_edited_and_odd_texts(spark):
    mit = s.TEMPLATES["MIT"][1]
    edited = mit.replace("free of charge,", "").replace("without limitation", "but not only").upper()
    rows = [
        (1, f"intro words\n * {edited} outro"), (2, mit + " middle " + s.TEMPLATES["ISC"][1]), (3, None), (None, ""), (4, "Permission is hereby granted, free of charge, to nobody."),
        (5, "x " * 60000 + s.TEMPLATES["Apache-2.0 notice"][1]), (6, s.TEMPLATES["Apache-2.0 header"][1]), (7, "MIT License"), (7, "--- ### !!"),
    ]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, license string")
    got = [(r.doc_id, r.template) for r in s.scan(df).orderBy("doc_id", "start").collect()]
    assert got == [(1, "MIT"), (2, "MIT"), (2, "ISC"), (5, "Apache-2.0 notice"), (6, "Apache-2.0 header")]
    span = s.scan(df.where("doc_id = 1")).first()
    assert rows[0][1][span.start : span.end].startswith("PERMISSION") and rows[0][1][: span.end].endswith("SOFTWARE.")
    assert s.scan(df.where("false")).count() == 0


def test_near_variants_get_their_own_license():
    spec = s.ScanSpec()
    index, codes = s.build_index(s.TEMPLATES, spec), s.WordCodes()
    named = lambda text: [m[0] for m in s.scan_text(text, index, codes, spec)]
    for name, (spdx, text) in s.TEMPLATES.items():
        assert named(f"some words before {text} some words after") == [spdx], name
    cc = "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."
    assert named(cc) == ["CC-BY-NC-4.0"]
    assert named("This work is licensed under the GNU General Public License, version 2.") == ["GPL-2.0"]
    assert named("This work is licensed under the GNU General Public License, version 1.") == []
    assert named("Licensed under the Apache License, Version 1.1.") == [] == named("Released under the BSD License.")
    header = s.TEMPLATES["GPL header"][1]
    assert named(header.replace("GNU General", "GNU Affero General")) == ["AGPL-3.0"]
    assert named(header.replace("GNU General", "GNU Lesser General")) == ["LGPL-3.0"]
    bsd = s.TEMPLATES["BSD-3-Clause"][1].replace("the copyright holder", "Example Inc.")
    assert named(bsd) == ["BSD-3-Clause"] and named(s.TEMPLATES["BSD-2-Clause"][1]) == ["BSD-2-Clause"]
