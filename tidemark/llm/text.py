"""Helpers the text operators share: word hashing inside tasks and tables in the shared folder."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import new_dir

#: ``bytes.split()`` without arguments separates words at exactly these bytes.
SPACES = b" \t\n\v\f\r"
_ODD = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    """64-bit hash of a word; a bounded cache that one task keeps over its rows."""

    def __init__(self, limit: int = 200_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


_TO_SPACE = bytes(32 if c in SPACES else c for c in range(256))


def joined(text: bytes | None) -> bytes:
    """The words of a text, joined by one space each."""
    text = (text or b"").translate(_TO_SPACE)
    return b" ".join(text.split()) if b"  " in text or text[:1] == b" " or text[-1:] == b" " else text


_MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def word_hashes(words: bytes) -> np.ndarray:
    """64-bit hash of each word of :func:`joined` words, eight bytes of all words at a time."""
    data = np.frombuffer(words + b" " * 8, np.uint8)
    end = np.flatnonzero(data[: len(words) + 1] == 32)
    start = np.concatenate(([0], end[:-1] + 1))
    size = end - start
    eight = np.ndarray((len(words) + 1,), "<u8", data.data, strides=(1,))  # the eight bytes at each place
    out = mix((eight[start] & _MASKS[np.minimum(size, 8)]) ^ (size.astype(np.uint64) * _ODD))
    at, more = 8, np.flatnonzero(size > 8)
    while len(more) and at < 64:
        out[more] = mix(out[more] ^ (eight[start[more] + at] & _MASKS[np.minimum(size[more] - at, 8)]))
        at += 8
        more = more[size[more] > at]
    for k in more.tolist():
        out[k] = xxhash.xxh3_64_intdigest(words[start[k] : end[k]])
    return out


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values, so that their order is pseudo-random."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def windows(ids: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` consecutive values; empty if there are fewer."""
    n = len(ids) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = ids[:n].copy()
    for k in range(1, size):
        out = out * _ODD + ids[k : k + n]
    return mix(out)


def shingles(hashes: WordHashes, text: str | None, size: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the ``size``-word shingles of a lower-cased (A-Z) text.

    A text of fewer words is one shingle; a null text or one without words has none.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    ids = hashes.of(words)
    return np.unique(windows(ids, min(size, len(ids))))


def map_rows(df: DataFrame, schema: str, make: Callable[[], Callable[[dict], dict]], rows: int = 1000) -> DataFrame:
    """Pieces of at most ``rows`` rows through ``make()(columns) -> columns``; ``make`` runs once in each task."""
    from pyspark.sql.types import StructType
    from pyspark.sql.pandas.types import to_arrow_schema

    target = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in pieces(batches, rows):
            yield to_batch(work({n: batch.column(i) for i, n in enumerate(batch.schema.names)}), target)

    return df.mapInArrow(run, schema)


def _give_back() -> None:
    """Return freed memory to the system at the end of a task: workers live on for later ones."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only where the C library has it
        ctypes.CDLL(None).malloc_trim(0)


def pieces(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """Non-empty slices of the batches: what a task makes of one slice stays small."""
    for batch in batches:
        for lo in range(0, batch.num_rows, rows):
            yield batch.slice(lo, rows)
    _give_back()


def to_batch(columns: dict, schema: pa.Schema) -> pa.RecordBatch:
    arrays = [c if isinstance(c := columns[f.name], pa.Array) and c.type == f.type else pa.array(c, f.type) for f in schema]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared folder and read it back, which cuts its lineage."""
    path = new_dir(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, rows: int = 1000) -> SparkSession:
    """Have Spark hand texts to Python workers ``rows`` at a time instead of 10 000.

    For jobs over whole documents: a batch of long texts takes memory in the JVM and in the
    worker.  Jobs call it, operators leave the session alone.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))
    return spark


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without columns whose names an operator is about to add (upper or lower case)."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def document_table(spark, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
