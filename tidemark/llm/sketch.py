"""Tables of fixed size that tasks fill in parts and the driver broadcasts: counts and bitmaps."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from tidemark.llm.text import mix, pieces

BLOCK = 1 << 16


def block_batch(counts: np.ndarray) -> pa.RecordBatch:
    """The blocks of a task's count table that are not all zero, compressed: (block, data)."""
    pack = zstandard.ZstdCompressor(level=1).compress
    parts = [(k // BLOCK, counts[k : k + BLOCK]) for k in range(0, len(counts), BLOCK)]
    found = [(k, pack(p.astype(np.uint32).tobytes())) for k, p in parts if p.any()]
    return pa.RecordBatch.from_arrays([pa.array([k for k, _ in found], pa.int32()), pa.array([d for _, d in found], pa.binary())], names=["block", "data"])


def merged(blocks: DataFrame, size: int, finish) -> np.ndarray:
    """Sum of the (block, data) rows of all tasks, one stream per block; ``finish`` maps the sums of a
    block to bytes.  The driver receives ``size`` bytes, whatever the input."""

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for k, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                part = np.frombuffer(unpack(raw), np.uint32)
                sums[k] = sums[k] + part if k in sums else part.astype(np.uint64)
        for k, total in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([finish(total).tobytes()], pa.binary())], names=["block", "data"])

    out = np.zeros(size, np.uint8)
    for row in blocks.repartition("block").mapInArrow(add, "block int, data binary").collect():
        part = np.frombuffer(row.data, np.uint8)
        out[row.block * BLOCK : row.block * BLOCK + len(part)] = part
    return out


def bitmap(values: DataFrame, bits: int) -> np.ndarray:
    """Packed bitmap of 2**bits places (one span at least) with the integers of all columns of ``values`` marked."""
    bits = max(16, bits)

    def mark(batches):
        yield from mark_batches((_unsigned(c.drop_null()) for b in pieces(batches) for c in b.columns), bits, places=1)

    return bloom(values.mapInArrow(mark, MARKS), bits)


def in_bitmap(table: np.ndarray, values: np.ndarray) -> np.ndarray:
    """False where a value surely was not marked."""
    bits = (len(table) * 8).bit_length() - 1
    return _set(table, mix(values.astype(np.int64, copy=False).view(np.uint64)) >> np.uint64(64 - bits))


def _unsigned(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(np.int64, copy=False).view(np.uint64)


def marked(rows: DataFrame, ids: DataFrame, id_col: str, hit: bool, bits: int = 24) -> DataFrame:
    """Rows whose id may (``hit``) or cannot (not ``hit``) occur in any column of ``ids``.

    Most rows skip a shuffle that way; ids that are let through by chance are for a join
    to sort out.  Null ids never occur in it.
    """
    shared = rows.sparkSession.sparkContext.broadcast(bitmap(ids, bits))
    where = rows.columns.index(id_col)

    def keep(batches):
        for batch in pieces(batches):
            column = batch.column(where)
            may = in_bitmap(shared.value, column.fill_null(0).to_numpy(zero_copy_only=False)) & column.is_valid().to_numpy(zero_copy_only=False)
            yield batch.filter(pa.array(may if hit else ~may))

    return rows.mapInArrow(keep, rows.schema)


# ------------------------------------------------------------------ Bloom bitmaps from sparse marks

SPAN = 1 << 16
MARKS = "span int, marks binary"
_SECOND = np.uint64(0xD6E8FEB86659FD93)


def bloom_places(values: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The two places of each 64-bit value in a bitmap of 2**bits places."""
    one = mix(values.astype(np.uint64, copy=False))
    two = mix(one ^ _SECOND)
    return one >> np.uint64(64 - bits), two >> np.uint64(64 - bits)


def mark_rows(values: np.ndarray, bits: int, places: int = 2) -> pa.RecordBatch:
    """(span, marks): the places of the values, cut into spans of 2**16 places; no dense table."""
    at = np.sort(np.concatenate(bloom_places(values, bits)[:places]))
    at = at[np.diff(at, prepend=~at[:1]) != 0]  # np.unique hashes integers, some 50 times slower
    span = (at >> np.uint64(16)).astype(np.int64)
    cuts = np.concatenate(([0], np.flatnonzero(np.diff(span)) + 1, [len(at)])) if len(at) else np.zeros(1, np.int64)
    low = (at & np.uint64(SPAN - 1)).astype(np.uint16)
    rows = [(int(span[a]), low[a:b].tobytes()) for a, b in zip(cuts[:-1], cuts[1:])]
    return pa.RecordBatch.from_arrays([pa.array([s for s, _ in rows], pa.int32()), pa.array([m for _, m in rows], pa.binary())], names=["span", "marks"])


def mark_batches(arrays, bits: int, most: int = 1 << 21, places: int = 2):
    """:func:`mark_rows` of about ``most`` values of a stream of arrays at a time."""
    held, n = [], 0
    for values in arrays:
        held.append(values)
        n += len(values)
        if n >= most:
            yield mark_rows(np.concatenate(held), bits, places)
            held, n = [], 0
    if n:
        yield mark_rows(np.concatenate(held), bits, places)


def bloom(marks: DataFrame, bits: int) -> np.ndarray:
    """Bitmap of the (span, marks) rows: each span is merged in one task, the driver gets 2**bits bits."""

    def add(batches):
        span, seen = None, np.zeros(SPAN, np.bool_)
        for batch in batches:
            for k, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if k != span:
                    if span is not None:
                        yield _part(span, seen)
                    span, seen = k, np.zeros(SPAN, np.bool_)
                seen[np.frombuffer(raw, np.uint16)] = True
        if span is not None:
            yield _part(span, seen)

    out = np.zeros((1 << bits) // 8, np.uint8)
    for row in marks.repartition("span").sortWithinPartitions("span").mapInArrow(add, "span int, part binary").collect():
        part = np.frombuffer(row.part, np.uint8)
        out[row.span * (SPAN // 8) : (row.span + 1) * (SPAN // 8)] |= part
    return out


def _part(span: int, seen: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([span], pa.int32()), pa.array([np.packbits(seen).tobytes()], pa.binary())], names=["span", "part"])


def in_bloom(table: np.ndarray, values: np.ndarray) -> np.ndarray:
    """False where a value surely was not marked."""
    bits = (len(table) * 8).bit_length() - 1
    one = mix(values.astype(np.uint64, copy=False))
    found = _set(table, one >> np.uint64(64 - bits))
    may = np.flatnonzero(found)
    found[may] = _set(table, mix(one[may] ^ _SECOND) >> np.uint64(64 - bits))
    return found


def _set(table: np.ndarray, at: np.ndarray) -> np.ndarray:
    return ((table[at >> np.uint64(3)] >> (7 - (at & np.uint64(7))).astype(np.uint8)) & 1).astype(bool)
