"""Base patterns against plain regular expressions, votes, masking and odd rows."""

import hashlib
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain(text):
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        d = [int(c) for c in m[0] if c.isdigit()]
        if 13 <= len(d) <= 19 and sum(v if k % 2 == 0 else sum(divmod(2 * v, 10)) for k, v in enumerate(d[::-1])) % 10 == 0:
            out.append(("card", *m.span()))
    return out + [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(re.sub(r"\D", "", m[0])) <= 15]


@settings(max_examples=600, deadline=None)
@given(st.text(alphabet="ab.@-+%0123456789 ()\né", max_size=60))
def test_base_spans_equal_plain_patterns(text):
    assert pii.base_spans(text) == plain(text)


def test_given_documents_and_result_columns(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = pii.find_personal(docs, pii.fit_spans(docs)).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert len(rows) == len(texts)
    for r in rows:
        base = plain(texts[r.doc_id])
        said = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert r.base_sha256 == hashlib.sha256(said.encode()).hexdigest() and r.spans.startswith(said)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(s[0] == k for s in base) for k in pii.BASE)


def test_votes_find_secrets_and_leave_small_numbers(spark):
    rows = [(k, f'some words token = "{hashlib.sha1(str(k).encode()).hexdigest()}" and version 2.0, page {k} of 12') for k in range(40)]
    rows += [(k, f"call tel 555{k:04d}{k:03d} or password={hashlib.md5(str(k).encode()).hexdigest()[:16]} in {1980 + k}") for k in range(40, 80)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    model = pii.fit_spans(df)
    for i, text in rows:
        _, added = pii.all_spans(text, model)
        found = [text[a:b] for _, a, b in added]
        want = [hashlib.sha1(str(i).encode()).hexdigest()] if i < 40 else [f"555{i:04d}{i:03d}", hashlib.md5(str(i).encode()).hexdigest()[:16]]
        assert sorted(found) == sorted(want)
    assert "token = \"[SECRET]\"" in pii.masked(rows[0][1], model)


def test_reliabilities_favour_labelers_that_agree():
    rng = np.random.default_rng(3)
    truth = rng.random(4000) < 0.3
    v = np.zeros((4000, 7), int)
    for k, right in enumerate((0.95, 0.9, 0.85, 0.6, 0.9)):
        ok = rng.random(4000) < right
        v[:, k] = np.where(truth == ok, 1, -1)
    post, table = pii.aggregate_votes(v, np.ones(4000))
    assert ((post > 0.5) == truth).mean() > 0.95
    assert table["pattern_secret_yes"][1] > table["gazetteer_key_yes"][1]


def found_in(text):
    clear = pii.blanked(text, [(a, b) for _, a, b in pii.base_spans(text)])
    return [(v, key) for _, _, v, key, _ in pii.candidates(clear)]


def test_candidates_inside_packed_text():
    assert found_in('{"email":"a@b.com","password":"S3cr3tValue99"}') == [("S3cr3tValue99", "password")]
    assert found_in("https://x.org/?email=a@b.com&password=S3cr3t99") == [("S3cr3t99", "password")]
    key = hashlib.sha1(b"k").hexdigest()
    assert found_in(f"https://x.org/?user=a&token={key}") == [(key, "token")]
    assert found_in("password: hunter, the key: patience; pwd='two words'") == [("hunter", "password"), ("two words", "pwd")]
    assert ("S3cr3tValue99abc", "x" * 32) not in found_in("x" * 600 + "=S3cr3tValue99abc")
    assert [v for v, _ in found_in("x" * 600 + "=S3cr3tValue99abc")] == ["S3cr3tValue99abc"]
    assert found_in("名前密码A1b2C3d4E5f6G7h8号")[0][0] == "A1b2C3d4E5f6G7h8"


def test_candidates_over_several_words():
    assert found_in("IBAN DE89 3704 0044 0532 0130 00.") == [("DE89 3704 0044 0532 0130 00", "")]
    assert [v for v, _ in found_in("tel 555 0199 234, or 030 1234 5678; (030) 123 4567")] == ["555 0199 234", "030 1234 5678", "(030) 123 4567"]
    assert [v for v, _ in found_in("rows 12 15 18 20 33 of it")] == ["12", "15", "18", "20", "33"]
    assert [v for v, _ in found_in("write jo.doe(at)mail.example.org or jo [at] web.de")] == ["jo.doe(at)mail.example.org", "jo [at] web.de"]


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="aZ09@=:\"' \n,;?&()[]{}./-+é中", max_size=80) | st.lists(st.sampled_from(["password", "=", ": ", '"', "030 ", "123 4567", "(at)", "DE89 3704 0044 0532 ", "x@y.zz", "\n", ","]), max_size=20).map("".join))
def test_candidates_are_apart_and_hold_every_digit_run(text):
    base = [(a, b) for _, a, b in pii.base_spans(text)]
    clear = pii.blanked(text, base)
    assert len(clear) == len(text)
    spans = [(a, b) for a, b, *_ in pii.candidates(clear)]
    assert all(a < b <= c for (a, b), (c, _) in zip(spans, spans[1:])) and not any(a < d and c < b for a, b in spans for c, d in base)
    inside = {k for a, b in spans for k in range(a, b)}
    for m in re.finditer(r"[0-9]{2,}", clear):
        assert set(range(*m.span())) <= inside


def test_long_texts_are_scanned_in_linear_time():
    import time

    start = time.time()
    for text in ("1" * 400000, "a" * 400000 + "1", "=" * 300000, 'password="' * 40000, "(at)" * 90000, "x(at)" * 90000, "1 " * 200000, "1 (" * 100000, "AB12 " * 80000, ":a" * 150000, "a1," * 100000):
        list(pii.candidates(pii.blanked(text, [(a, b) for _, a, b in pii.base_spans(text)])))
    assert time.time() - start < 40


def test_planted_spans_are_found_and_plain_numbers_stay(spark):
    """Recall above nine tenths over kinds of spans, none of them in clean rows."""
    plants = [
        lambda k: f'{{"id":{k % 90},"password":"S3cr3t{k}Value"}}', lambda k: f"see https://h.example.org/?a={k % 9}&token={hashlib.sha1(str(k).encode()).hexdigest()}",
        lambda k: f"IBAN DE{k % 90 + 10} 3704 0044 0532 {k:04d} 00", lambda k: f"call tel 030 {k:04d} 5678", lambda k: f"write to user{k}(at)mail.example.org",
        lambda k: f"api_key = '{hashlib.md5(str(k).encode()).hexdigest()}'", lambda k: f"account 77{k:04d}1234{k:04d}",
    ]
    clean = ["in 1999 there were 12 of 40 rooms", "version 2.0.1, page 7", "rows 12 15 18 20 33 of it", "at 10:30 for 4.50 each", "the key: patience and 3 cups"]
    rows = [(k, f"some words here {plants[k % 7](k)} and more, {clean[k % 5]}.") for k in range(350)] + [(k, f"some words here {clean[k % 5]} and more {k}.") for k in range(1000, 1350)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in pii.find_personal(df, pii.fit_spans(df)).collect()}
    hit = [got[k].n_spans >= 1 for k in range(350)]
    assert np.mean(hit) > 0.9, [np.mean(hit[j::7]) for j in range(7)]
    assert np.mean([got[k].n_spans == 0 for k in range(1000, 1350)]) > 0.98


def test_odd_rows(spark):
    rows = [(1, None, 5, "x"), (None, "", None, "x"), (2, "a@b.co 1.2.3.4", 14, "x"), (2, "a@b.co 1.2.3.4", 14, "x"), (3, "9" * 50000 + "@" + "a" * 50000 + "+1" * 9000, 3, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, spans string")
    model = pii.fit_spans(df)
    out = pii.find_personal(df, model)
    assert out.columns == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_spans"] and out.count() == 5
    hidden = {(r.doc_id, r.text, r.n_chars) for r in pii.mask_personal(df, model).collect() if r.doc_id != 3}
    assert hidden == {(1, None, 5), (None, "", None), (2, "[EMAIL] [IP]", 12)}
    none = df.where("doc_id > 9")
    assert pii.find_personal(none, pii.fit_spans(none)).count() == 0
