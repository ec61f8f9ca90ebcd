"""Counts against the libraries on whole texts, units, other tokenizers, odd rows."""

import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm import token_counts as t

BPE = Tokenizer.from_file(P.path("byte_bpe_50k.json"))


def whole(text):
    return len(BPE.encode(text, add_special_tokens=False).ids)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="ab 's\n\t\u00a0\x1cé1½,.<|>漢", max_size=50), st.booleans())
def test_units_add_up(text, special):
    if special:
        text = text[:20] + "<|endoftext|>" + text[20:]
    parts = t.units(text)
    assert "".join(parts) == text and sum(whole(p) for p in parts) == whole(text)


@pytest.mark.parametrize("small", [True, False])
def test_given_documents(spark, small):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    spec = t.TokenSpec(P.path("byte_bpe_50k.json"), **({"table_size": 3, "task_top": 5, "cache_size": 7} if small else {}))
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in t.count_tokens(docs, spec).collect():
        assert (r.n_tokens, r.n_bytes) == (whole(texts[r.doc_id]), len(texts[r.doc_id].encode()))


def test_other_tokenizers(spark):
    from sentencepiece import SentencePieceProcessor

    df = spark.createDataFrame([(1, "Some words, here!"), (2, None)], "doc_id long, text string")
    piece = SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    got = {r.doc_id: r.n_tokens for r in t.count_tokens(df, t.TokenSpec(P.path("piece_bpe_32k.model"))).collect()}
    assert got == {1: len(piece.encode("Some words, here!")), 2: 0}
    word = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    got = {r.doc_id: r.n_tokens for r in t.count_tokens(df, t.TokenSpec(P.path("word_bpe_49k.json"))).collect()}
    assert got[1] == len(word.encode("Some words, here!", add_special_tokens=False).ids)


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (None, "a <|endoftext|> b"), (3, "x" * 30000), (4, "many words " * 30000), (4, "many words " * 30000), (5, "   \n\n  ")]
    df = spark.createDataFrame([(i, s, "z") for i, s in rows], "doc_id long, text string, n_tokens string")
    got = sorted(((r.doc_id, r.n_tokens) for r in t.count_tokens(df, t.TokenSpec(P.path("byte_bpe_50k.json"))).collect()), key=str)
    assert got == sorted(((i, whole(s or "")) for i, s in rows), key=str)
    assert t.count_tokens(df.where("false"), t.TokenSpec(P.path("byte_bpe_50k.json"))).count() == 0
