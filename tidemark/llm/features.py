"""Text features for the trained classifiers: hashed words, word shapes and a few style shares."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.text import SPACES, map_rows

N_SHAPES = 64
_EDGE = "\"'`([{<>)]}.,;:!?#*$%&|_-"
_STOPS, _CRIES = set(".,;:?\"'"), set("!?.,")
N_STYLE = 10


@dataclass(frozen=True)
class Features:
    """``word_bits`` gives 2**word_bits word buckets."""

    word_bits: int = 14

    @property
    def n_words(self) -> int:
        return 1 << self.word_bits


class TokenFeatures(dict):
    """Raw token -> word bucket and shape in one integer; a bounded cache."""

    def __init__(self, spec: Features):
        super().__init__()
        self.mask = spec.n_words - 1

    def __missing__(self, token: bytes) -> int:
        if len(self) >= 400_000:
            self.clear()
        text = token.decode(errors="replace")
        if text.isalpha():  # most tokens: nothing to strip, no symbol, no digit
            low = text.lower()
            case = 0 if low == text else 1 if text[0].isupper() and (len(text) == 1 or text[1:].islower()) else 2 if text.isupper() else 3
            shape = case << 4 | int(len(text) > 9)
        else:
            bare = text.strip(_EDGE)
            low = bare.lower()
            case = 0 if bare.islower() else 1 if bare[:1].isupper() and (len(bare) == 1 or bare[1:].islower()) else 2 if bare.isupper() else 3
            tail = text[len(text.rstrip(_EDGE)) :]
            end = 0 if not tail else 1 if set(tail) <= _STOPS else 2 if set(tail) <= _CRIES else 3
            kind = 3 if not bare else 2 if not bare.isalpha() and any(c.isdigit() for c in bare) else int(len(bare) > 9)
            shape = case << 4 | end << 2 | kind
        value = self[token] = (xxhash.xxh3_64_intdigest(low.encode()) & self.mask) << 6 | shape
        return value


def describe(text: str | None, tokens: TokenFeatures) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """(words, word buckets, log counts, shape and style shares) of one text."""
    raw = (text or "").encode()
    words = raw.split()
    n = len(words)
    dense = np.zeros(N_SHAPES + N_STYLE, np.float32)
    if not n:
        return 0, np.empty(0, np.int32), np.empty(0, np.float32), dense
    code = np.fromiter(map(tokens.__getitem__, words), np.int64, n)
    word = code >> 6
    ordered = np.sort(word)
    starts = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
    bucket, count = ordered[starts], np.diff(np.append(starts, n))
    dense[:N_SHAPES] = np.sqrt(np.bincount(code & 63, minlength=N_SHAPES) / n)
    lines = [x for x in raw.split(b"\n") if x.strip(SPACES)]
    both = np.sort(word[1:] * (1 << 24) + word[:-1])
    pairs = (1 + np.count_nonzero(both[1:] != both[:-1])) / (n - 1) if n > 1 else 1.0
    shares = (
        float((word[1:] == word[:-1]).mean()) if n > 1 else 0.0, pairs, len(set(lines)) / max(1, len(lines)),
        (len(raw) - len(raw.translate(None, b"#*$%&|<>!"))) / len(raw), min(1.0, len(raw) / n / 16),
    )
    for k, s in enumerate(shares):
        dense[N_SHAPES + 2 * k], dense[N_SHAPES + 2 * k + 1] = np.sqrt(s), np.sqrt(max(0.0, 1 - s))
    return n, bucket.astype(np.int32), np.log1p(count).astype(np.float32), dense


@dataclass
class Sample:
    """Features of labelled documents in compressed rows; the driver's training set."""

    ids: np.ndarray
    labels: np.ndarray
    starts: np.ndarray
    buckets: np.ndarray
    values: np.ndarray
    dense: np.ndarray

    def rows(self, lo: int, hi: int, n_words: int, scale: np.ndarray) -> np.ndarray:
        """Dense unit-length word rows ``lo:hi``, each bucket times ``scale``."""
        out = np.zeros((hi - lo, n_words), np.float32)
        a, b = self.starts[lo], self.starts[hi]
        row = np.repeat(np.arange(hi - lo), np.diff(self.starts[lo : hi + 1]))
        out[row, self.buckets[a:b]] = self.values[a:b] * scale[self.buckets[a:b]]
        return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_label: int, values: list, spec: Features) -> Sample:
    """At most ``per_label`` documents of each label value, those with the least id hash.

    ``labels`` holds (doc_id, ``label``), ``docs`` (doc_id, text).  Rows without a label or id
    are left out.  The sample is bounded, so its ids may be broadcast and its features collected.
    """
    picks = None
    for v in values:
        some = labels.where((F.col(label) == v) & F.col("doc_id").isNotNull()).select("doc_id", F.col(label).alias("_label")).distinct()
        some = some.orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_label)
        picks = some if picks is None else picks.unionByName(some)
    chosen = docs.select("doc_id", "text").join(F.broadcast(picks), "doc_id")
    kind = picks.schema["_label"].dataType.simpleString()

    def make():
        tokens = TokenFeatures(spec)

        def work(columns):
            got = [describe(t, tokens) for t in columns["text"].to_pylist()]
            return {"doc_id": columns["doc_id"], "label": columns["_label"], "b": [g[1].tobytes() for g in got], "v": [g[2].tobytes() for g in got], "d": [g[3].tobytes() for g in got]}

        return work

    rows = map_rows(chosen, f"doc_id long, label {kind}, b binary, v binary, d binary", make).collect()
    rows.sort(key=lambda r: (r.doc_id, str(r.label), r.b))
    size = [len(r.b) // 4 for r in rows]
    cat = lambda name, kind: np.frombuffer(b"".join(r[name] for r in rows), kind)
    return Sample(
        np.array([r.doc_id for r in rows], np.int64), np.array([r.label for r in rows]), np.concatenate([[0], np.cumsum(size)]).astype(np.int64),
        cat("b", np.int32), cat("v", np.float32), cat("d", np.float32).reshape(len(rows), N_SHAPES + N_STYLE),
    )
