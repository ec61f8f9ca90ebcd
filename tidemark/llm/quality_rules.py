"""Quality rules: word counts and zstandard compression bands over whole texts and fixed chunks."""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass, field
from math import log2

import numpy as np
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.text import SPACES, WordHashes, map_rows, pieces, windows

SYMBOLS = b"#*$%&|<>"


@dataclass(frozen=True)
class BandRules:
    """Limits of ``raw / compressed`` by text length in bytes.

    ``bands`` holds (shortest length, least ratio, greatest ratio), ascending.  Short texts
    compress badly because of the frame overhead, so each length has limits of its own.
    The greatest ratio of clean prose grows with the logarithm of its length, so the limits do:
    they lie above what license texts, manuals and release notes reach at each length, and go on by
    ``growth`` for each doubling past the last band.
    A text outside its band, or one of its ``chunk_bytes`` chunks outside the band of that
    chunk's length, is rejected.  A last chunk below half the size is left to the whole text.
    """

    bands: tuple[tuple[int, float, float], ...] = field(
        default=(
            (0, 0.0, 1.9), (128, 0.9, 2.2), (256, 1.1, 2.6), (512, 1.25, 2.9), (1024, 1.35, 3.1),
            (2048, 1.4, 3.2), (4096, 1.45, 3.4), (8192, 1.5, 3.5), (16384, 1.5, 3.6), (32768, 1.5, 3.8),
            (65536, 1.5, 4.0), (131072, 1.5, 4.2), (262144, 1.5, 4.4), (524288, 1.5, 4.6), (1048576, 1.5, 4.8),
        )
    )
    growth: float = 0.2
    chunk_bytes: int = 4096
    level: int = 3
    min_words: int = 20
    repeat_window: int = 8
    max_repeat_percent: int = 30

    def limits(self, n_bytes: int) -> tuple[float, float]:
        """(least, greatest) ratio of a text of so many bytes."""
        start, low, high = self.bands[bisect_right(self.bands, n_bytes, key=lambda b: b[0]) - 1]
        if start and start == self.bands[-1][0]:
            high += self.growth * log2(n_bytes / start)
        return low, high


MEASURES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
    "ratio double, chunk_low double, chunk_high double, kept boolean"
)


def base_counts(text: str, hashes: WordHashes, window: int = 8) -> tuple[int, int, int, int, int]:
    """(words, code points in words, symbols, repeated lines, words in repeated windows) of one text."""
    raw = text.encode()
    words = raw.split()
    bare = len(raw.translate(None, SPACES))
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    repeated = 0
    if len(words) > window:
        runs = windows(hashes.of(words), window)
        _, group, size = np.unique(runs, return_inverse=True, return_counts=True)
        starts = np.flatnonzero(size[group] > 1)
        if len(starts):
            edge = np.zeros(len(words) + 1, np.int64)
            np.add.at(edge, starts, 1)
            np.add.at(edge, starts + window, -1)
            repeated = int((np.cumsum(edge[:-1]) > 0).sum())
    return len(words), len(text) - (len(raw) - bare), symbols, len(lines) - len(set(lines)), repeated


def ratios(raw: bytes, rules: BandRules, compress) -> tuple[float | None, float | None, float | None, bool]:
    """(ratio of the whole, least and greatest chunk ratio, inside all bands)."""
    if not raw:
        return None, None, None, True

    def one(part: bytes) -> tuple[float, bool]:
        ratio = len(part) / len(compress(part))
        low, high = rules.limits(len(part))
        return ratio, low <= ratio <= high

    whole, fits = one(raw)
    size = rules.chunk_bytes
    if len(raw) <= size:
        return whole, whole, whole, fits
    parts = [one(raw[i : i + size]) for i in range(0, len(raw), size) if i == 0 or len(raw) - i >= size // 2]
    each = [p[0] for p in parts]
    return whole, min(each), max(each), fits and all(p[1] for p in parts)


def measure(docs: DataFrame, rules: BandRules | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``id_col``, measures, ``base_failed``, ``kept``), one row per input row, no shuffle.

    A null text counts as empty: no words, so it fails the base rule.  Repeated rows and
    null ids give a row each.  Extra columns are not read.  Whole texts are measured.
    """
    rules = rules or BandRules()
    kind = docs.schema[id_col].dataType.simpleString()

    def make():
        hashes, compress = WordHashes(), zstandard.ZstdCompressor(level=rules.level).compress

        def work(columns):
            rows = []
            for text in columns["text"].to_pylist():
                text = text or ""
                counts = base_counts(text, hashes, rules.repeat_window)
                failed = counts[0] < rules.min_words or 100 * counts[4] > rules.max_repeat_percent * counts[0]
                whole, low, high, fits = ratios(text.encode(), rules, compress)
                rows.append((*counts, failed, whole, low, high, fits and not failed))
            names = [x.split()[0] for x in MEASURES.split(", ")]
            return {"id": columns["id"], **dict(zip(names, zip(*rows)))}

        return work

    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return map_rows(picked, f"id {kind}, {MEASURES}", make).withColumnRenamed("id", id_col)


def keep_good(docs: DataFrame, rules: BandRules | None = None, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text passes, with all their columns.

    The verdict is computed beside the row itself, so repeated or null ids need no join.
    """
    rules = rules or BandRules()
    schema, names = docs.schema, docs.columns

    def run(batches):
        import pyarrow as pa

        hashes, compress = WordHashes(), zstandard.ZstdCompressor(level=rules.level).compress
        for batch in pieces(batches):
            keep = []
            for text in batch.column(names.index(text_col)).to_pylist():
                counts = base_counts(text or "", hashes, rules.repeat_window)
                failed = counts[0] < rules.min_words or 100 * counts[4] > rules.max_repeat_percent * counts[0]
                keep.append(not failed and ratios((text or "").encode(), rules, compress)[3])
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, schema)
