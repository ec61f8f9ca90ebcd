"""Token counts: a broadcast table of frequent unit lengths first, worker caches for the rest.

The tokenizer cuts a text into pre-tokens, and a single space between two non-space
characters always opens a new one (it belongs to the pre-token that follows).  So a text falls
apart at such spaces into *units* whose counts add up exactly, whatever the neighbours are.
Tier one is a bounded table of the most frequent units, broadcast to every task; tier two is
a bounded cache in each worker which asks the tokenizer once for every unit it has not seen.
No unit is ever shuffled: only bounded per-task summaries of frequent units meet.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.text import map_rows


@dataclass(frozen=True)
class TokenSpec:
    """``table_size`` bounds the broadcast table, ``task_top`` what a task reports for it,
    ``cache_size`` the worker cache (it is emptied when full).  None of them changes a count."""

    tokenizer: str
    table_size: int = 20_000
    task_top: int = 4_000
    cache_size: int = 300_000
    longest_unit: int = 64


def units(text: str) -> list[str]:
    """Split before every single space that stands between two non-space characters."""
    pieces = text.split(" ")
    out, held = [], pieces[0]
    for piece in pieces[1:]:
        if held and piece and not held[-1].isspace() and not piece[0].isspace():
            out.append(held)
            held = " " + piece
        else:
            held += " " + piece
    out.append(held)
    return out


def load_counter(path: str):
    """text -> number of tokens, by the library the file is made for."""
    if path.endswith(".json"):
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        t.no_padding()
        t.no_truncation()
        return lambda text: len(t.encode(text, add_special_tokens=False).ids)
    from sentencepiece import SentencePieceProcessor

    p = SentencePieceProcessor(model_file=path)
    return lambda text: len(p.encode(text, out_type=int))


def cuts_at_spaces(path: str) -> bool:
    """Whether units may be counted alone: byte-level pre-tokenization without a normalizer."""
    import json

    if not path.endswith(".json"):
        return False
    with open(path, encoding="utf-8") as file:
        t = json.load(file)
    pre = t.get("pre_tokenizer") or {}
    special = [a for a in t.get("added_tokens", []) if a.get("lstrip") or a.get("rstrip") or " " in a["content"]]
    return t.get("normalizer") is None and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True) and not special


def frequent_units(texts: DataFrame, spec: TokenSpec) -> list[str]:
    """The most frequent units over all rows, from each task's ``task_top`` (bounded)."""
    top = spec.task_top

    def summary(batches):
        seen: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if text:
                    seen.update(" " + w for w in text.split() if len(w) < spec.longest_unit)
            if len(seen) > 50 * top:  # keep the head; ties and the tail only cost speed
                seen = Counter(dict(seen.most_common(10 * top)))
        found = seen.most_common(top)
        yield pa.RecordBatch.from_arrays([pa.array([u for u, _ in found], pa.string()), pa.array([n for _, n in found], pa.int64())], names=["unit", "n"])

    heads = texts.mapInArrow(summary, "unit string, n long")
    best = heads.groupBy("unit").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "unit").limit(spec.table_size)
    return [r.unit for r in best.collect()]


def count_tokens(docs: DataFrame, spec: TokenSpec, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``id_col``, n_bytes, n_tokens), one row per input row; ``docs`` itself is not shuffled.

    A null or empty text has 0 bytes and 0 tokens.  Repeated rows and null ids give a row
    each; other columns are not read.  Tokenizers whose counts do not add up over units
    (anything but plain byte-level BPE) are asked for every whole text instead.
    """
    path = spec.tokenizer
    kind = docs.schema[id_col].dataType.simpleString()
    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    if not cuts_at_spaces(path):

        def whole():
            count = load_counter(path)

            def work(columns):
                texts = [t or "" for t in columns["text"].to_pylist()]
                return {"id": columns["id"], "n_bytes": [len(t.encode()) for t in texts], "n_tokens": [count(t) if t else 0 for t in texts]}

            return work

        return map_rows(picked, f"id {kind}, n_bytes long, n_tokens long", whole).withColumnRenamed("id", id_col)

    count = load_counter(path)
    table = {u: count(u) for u in frequent_units(picked.select("text"), spec)}
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def make():
        ask, first = load_counter(path), shared.value

        class Misses(dict):
            def __missing__(self, unit):
                n = ask(unit)
                if len(unit) < spec.longest_unit:
                    if len(self) >= spec.cache_size:
                        self.clear()
                    self[unit] = n
                return n

        second = Misses()

        def work(columns):
            sizes, totals = [], []
            for text in columns["text"].to_pylist():
                sizes.append(len(text.encode()) if text else 0)
                n = 0
                if text:
                    for unit in units(text):
                        got = first.get(unit)
                        n += second[unit] if got is None else got
                totals.append(n)
            return {"id": columns["id"], "n_bytes": sizes, "n_tokens": totals}

        return work

    return map_rows(picked, f"id {kind}, n_bytes long, n_tokens long", make).withColumnRenamed("id", id_col)
