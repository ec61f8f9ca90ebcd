"""Removal of passages that repeat across or inside documents, by fixed-block anchors.

A *window* is ``window`` consecutive words of one document.  Whatever its start, it covers a whole
block of ``window // 2`` words that begins at a multiple of that length.  So:

1. Documents with the same words are one: the first id stands for them, the others repeat it whole.
2. *Index*: the non-overlapping blocks of every document are marked in a bitmap of fixed size.
3. *Probe*: every rolling run of block length that may be marked is counted together with the
   blocks; a hash that occurs twice, at least once as a block, is an anchor.
4. *Extension*: in each document the anchors are extended to all windows around them, which join
   to maximal stretches; of every window content the first (smallest id, then start) is
   found by one aggregate with map-side minima, and each document learns which of its own
   stretches' windows are the first.  The others' words go.

No occurrence is paired with another one, so a passage that a third of all rows share costs as
many rows as it has words in each task.  Bitmaps only leave out work; windows are compared by hashes
of 96 bits.  The bitmaps have a fixed size (``bits``): beyond some 100 million
blocks more chance hits are counted in step 3, up to one row for every word, and the result is the same.

Defined results: a null or wordless text has no words and keeps "".  A text shorter than a
window keeps all words (joined by one space).  Rows with one id and the same words are one document
stored twice and get the same result; rows with one id and other words are documents of their own,
ordered by a hash of their words.  Rows without an id come last and are told apart by their words.  Other columns are
ignored.  An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.sketch import MARKS, bloom, in_bloom, mark_batches
from tidemark.llm.text import joined, mix, pieces, saved, word_hashes

_SALT = np.uint64(0xA5A3564E27F88651)
_BASE = 0x9E3779B97F4A7C15


@dataclass(frozen=True)
class RepeatSpec:
    """``window`` words make a repeat; ``bits`` sizes the two bitmaps (32 MB each)."""

    window: int = 20
    bits: int = 28

    @property
    def block(self) -> int:
        return (self.window + 1) // 2


def _key(text: bytes) -> tuple[int, int]:
    """128-bit hash of a joined word sequence as two signed numbers."""
    digest = xxhash.xxh3_128_digest(text)
    return int.from_bytes(digest[:8], "big", signed=True), int.from_bytes(digest[8:], "big", signed=True)


def windows(ids: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` consecutive values, by doubling the length of the runs."""
    if len(ids) < size:
        return np.empty(0, np.uint64)
    out, have = None, 0
    run, length, factor = ids, 1, _BASE  # hashes of runs of ``length`` values, _BASE ** length
    while True:
        if size & length:
            n = len(ids) - have - length + 1
            out = run[:n].copy() if out is None else out[:n] * np.uint64(factor) + run[have : have + n]
            have += length
        if have == size:
            return mix(out)
        run = run[:-length] * np.uint64(factor) + run[length:]
        length, factor = length * 2, factor * factor & (1 << 64) - 1


def _texts(batches):
    """(batch, words of each text joined by one space, their numbers) of (doc_id, text, ...) batches."""
    for batch in pieces(batches):
        texts = [joined(t) for t in batch.column("text").cast(pa.binary()).to_pylist()]
        yield batch, texts, np.fromiter((t.count(b" ") + 1 if t else 0 for t in texts), np.int64, len(texts))


def _strings(texts: list[bytes]) -> pa.Array:
    return pa.array(texts, pa.binary()).view(pa.string())


def _flat(batches, most: int = 1 << 20):
    """(batch, word hashes, place of each text's first word and the end) of batches of joined texts.

    The words of about ``most`` bytes of text stand in one array, since calls for each text would cost
    more than the work.  No text is cut.
    """
    for batch in pieces(batches):
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        turn = np.cumsum([len(t) for t in texts]) // most
        bounds = [0, *(np.flatnonzero(np.diff(turn)) + 1).tolist(), len(texts)]
        for a, b in zip(bounds[:-1], bounds[1:]):
            first = np.cumsum([0, *(t.count(b" ") + 1 for t in texts[a:b])])
            yield batch.slice(a, b - a), word_hashes(b" ".join(texts[a:b])), first


def _blocks(first: np.ndarray, size: int) -> np.ndarray:
    """Starts of the non-overlapping blocks of the texts of a flat array."""
    n = np.diff(first) // size
    return np.repeat(first[:-1], n) + size * (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))


def _keys(docs: DataFrame, id_type: str) -> DataFrame:
    """(doc_id, k1, k2, n_words) of every row."""

    def run(batches):
        for batch, texts, n in _texts(batches):
            keys = [_key(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([k for k, _ in keys], pa.int64()), pa.array([k for _, k in keys], pa.int64()), pa.array(n)],
                names=["doc_id", "k1", "k2", "n_words"],
            )

    return docs.mapInArrow(run, f"doc_id {id_type}, k1 long, k2 long, n_words long")


def _same(a: str, b: str, columns=("doc_id", "k1", "k2")) -> Column:
    fits = F.lit(True)
    for c in columns:
        fits = fits & F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}"))
    return fits


def _by_key(docs: DataFrame, shared, twice, id_type: str, least: int, hit: bool) -> DataFrame:
    """(doc_id, k, k1, k2, joined text) of rows of at least ``least`` words whose key is (not) in a bitmap.

    ``k`` tells documents of one id apart: 0 for an id that surely occurs once, else the key.
    """

    def run(batches):
        for batch, texts, n in _texts(batches):
            keys = [_key(t) for t in texts]
            k1 = np.array([k for k, _ in keys], np.int64)
            keep = (in_bloom(shared.value, k1.view(np.uint64)) == hit) & (n >= least)
            at = np.flatnonzero(keep)
            ids, k1 = batch.column("doc_id").take(pa.array(at)), k1[at]
            k = np.where(_may_repeat(ids, twice.value), k1, 0)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(k), pa.array(k1), pa.array([keys[i][1] for i in at], pa.int64()), _strings([texts[i] for i in at])], names=["doc_id", "k", "k1", "k2", "text"]
            )

    return docs.mapInArrow(run, f"doc_id {id_type}, k long, k1 long, k2 long, text string")


def _told_apart(copies: DataFrame, twice, id_type: str) -> DataFrame:
    """(doc_id, k) of (doc_id, k1, k2)."""

    def run(batches):
        for batch in pieces(batches):
            k = np.where(_may_repeat(batch.column("doc_id"), twice.value), batch.column("k1").to_numpy(), 0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(k)], names=["doc_id", "k"])

    return copies.mapInArrow(run, f"doc_id {id_type}, k long")


def _may_repeat(ids: pa.Array, twice: np.ndarray) -> np.ndarray:
    """True where an id may occur twice: not surely once, null, or no integer."""
    if not pa.types.is_integer(ids.type):
        return np.ones(len(ids), bool)
    values = ids.cast(pa.int64()).fill_null(0).to_numpy(zero_copy_only=False)
    return in_bloom(twice, values.view(np.uint64)) | ids.is_null().to_numpy(zero_copy_only=False)


def _marks(values: DataFrame, bits: int) -> DataFrame:
    """Marks of a table of one 64-bit column."""

    def run(batches):
        yield from mark_batches((b.column(0).to_numpy().view(np.uint64) for b in pieces(batches)), bits)

    return values.mapInArrow(run, MARKS)


def _block_marks(docs: DataFrame, spec: RepeatSpec) -> DataFrame:
    def run(batches):
        def hashes():
            for _, values, first in _flat(batches):
                at, out = _blocks(first, spec.block), 0
                for j in range(spec.block):  # what ``windows`` gives at these places
                    out = out * np.uint64(_BASE) + values[at + j]
                yield mix(out)

        yield from mark_batches(hashes(), spec.bits)

    return docs.mapInArrow(run, MARKS)


def _anchor_counts(docs: DataFrame, shared, spec: RepeatSpec, most: int = 1 << 19) -> DataFrame:
    """(h, n, blocks): occurrences of run hashes that may equal a block, summed over some ``most`` of them."""

    def run(batches):
        blocks, probes, size = [], [], 0
        for _, values, first in _flat(batches):
            runs = windows(values, spec.block)
            at = _blocks(first, spec.block)
            free = np.ones(len(values), bool)
            free[at] = False
            free[first[1:, None] - np.arange(1, spec.block)] = False  # runs that reach into the next text
            probe = runs[free[: len(runs)]]
            blocks.append(runs[at])
            probes.append(probe[in_bloom(shared.value, probe)])
            size += len(blocks[-1]) + len(probes[-1])
            if size >= most:
                yield _counted(blocks, probes)
                blocks, probes, size = [], [], 0
        if size:
            yield _counted(blocks, probes)

    return docs.mapInArrow(run, "h long, n long, blocks long")


def _counted(blocks: list[np.ndarray], probes: list[np.ndarray]) -> pa.RecordBatch:
    """(h, n, blocks): every hash, how often it occurs and how often as a block."""
    own = np.concatenate(blocks)
    h, back, n = np.unique(np.concatenate([own, *probes]), return_inverse=True, return_counts=True)
    of_block = np.bincount(back[: len(own)], minlength=len(h))
    return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n.astype(np.int64)), pa.array(of_block.astype(np.int64))], names=["h", "n", "blocks"])


def _starts(values: np.ndarray, first: np.ndarray, anchors: np.ndarray, spec: RepeatSpec) -> np.ndarray:
    """Starts of the windows around the anchors of the texts of a flat array, ascending."""
    at = np.flatnonzero(in_bloom(anchors, windows(values, spec.block)))
    text = np.searchsorted(first, at, "right") - 1
    low, high = np.maximum(at - (spec.window - spec.block), first[text]), np.minimum(at, first[text + 1] - spec.window)
    inside = (at + spec.block <= first[text + 1]) & (low <= high)
    edge = np.bincount(low[inside], minlength=len(values) + 1) - np.bincount(high[inside] + 1, minlength=len(values) + 1)
    return np.flatnonzero(np.cumsum(edge) > 0)


def _window_rows(docs: DataFrame, shared, spec: RepeatSpec, id_type: str) -> DataFrame:
    """(w1, w2, doc_id, k, start, around): the windows around the anchors.  Each document that has any
    also leaves one row of its own with the start -1 and all its starts as packed ranges."""
    names = ["w1", "w2", "doc_id", "k", "start", "around"]

    def run(batches):
        for batch, values, first in _flat(batches):
            ids, k, k1 = batch.column("doc_id"), batch.column("k"), batch.column("k1")
            at = _starts(values, first, shared.value, spec)
            if not len(at):
                continue
            text = np.searchsorted(first, at, "right") - 1
            start = at - first[text]
            for lo in range(0, len(at), 1 << 18):
                some, of = at[lo : lo + (1 << 18)], pa.array(text[lo : lo + (1 << 18)])
                part = values[some[0] : some[-1] + spec.window]
                one, two = (windows(p, spec.window)[some - some[0]].view(np.int64) for p in (part, mix(part ^ _SALT)))
                columns = [pa.array(one), pa.array(two >> 32), ids.take(of), k.take(of), pa.array(start[lo : lo + (1 << 18)]), pa.nulls(len(some), pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=names)
            turn = np.flatnonzero(np.diff(text, prepend=-1))
            around = [_packed(s) for s in np.split(start, turn[1:])]
            of, n = pa.array(text[turn]), len(turn)
            columns = [k1.take(of), pa.array(np.full(n, 1 << 40)), ids.take(of), k.take(of), pa.array(np.full(n, -1)), pa.array(around, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.mapInArrow(run, f"w1 long, w2 long, doc_id {id_type}, k long, start long, around binary")


def _packed(at: np.ndarray) -> bytes:
    """Ascending numbers as (first, last) of each range."""
    cut = np.flatnonzero(np.diff(at) != 1)
    return np.stack([at[np.concatenate(([0], cut + 1))], at[np.concatenate((cut, [len(at) - 1]))]], 1).astype(np.int64).tobytes()


def _unpacked(raw: bytes | None) -> np.ndarray:
    ranges = np.frombuffer(raw or b"", np.int64).reshape(-1, 2)
    return np.concatenate([np.arange(a, b + 1) for a, b in ranges]) if len(ranges) else np.empty(0, np.int64)


_OUT = "n_words long, n_removed long, removed array<struct<start:long,end:long>>, kept string"


def _cut(text: bytes, n: int, starts: np.ndarray, window: int) -> tuple[int, list[dict], bytes]:
    """Words of a joined text covered by the windows at ``starts``: their number, their stretches, the text left."""
    gone = np.cumsum(np.bincount(starts, minlength=n + 1) - np.bincount(starts + window, minlength=n + 1))[:-1] > 0
    turn = np.flatnonzero(np.diff(np.concatenate(([0], gone.astype(np.int8), [0]))))
    text += b" "
    place = np.concatenate(([0], np.flatnonzero(np.frombuffer(text, np.uint8) == 32) + 1))  # where words begin
    at = [0, *place[turn].tolist(), len(text)]
    kept = b"".join(text[a:b] for a, b in zip(at[::2], at[1::2]))[:-1]
    return int(gone.sum()), [{"start": int(a), "end": int(b)} for a, b in zip(turn[::2], turn[1::2])], kept


def _columns(ids, n_words, n_removed, removed: list, kept: list[bytes], schema: pa.Schema) -> pa.RecordBatch:
    parts = [pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(removed, schema.field("removed").type), _strings(kept)]
    return pa.RecordBatch.from_arrays([ids.cast(schema[0].type), *parts], schema=schema)


def remove_repeats(docs: DataFrame, spec: RepeatSpec = RepeatSpec()) -> DataFrame:
    """Per row of (doc_id, text): ``doc_id``, ``n_words``, ``n_removed``, ``removed`` (stretches of
    words, end exclusive) and ``kept`` (the other words, joined by one space)."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    docs = docs.select("doc_id", "text")
    context = docs.sparkSession.sparkContext
    id_type = docs.schema["doc_id"].dataType.simpleString()
    keys = _keys(docs, id_type).where(F.col("n_words") >= spec.window).select("doc_id", "k1", "k2")
    keys = saved(keys, "repeat-keys")
    first = keys.groupBy("k1", "k2").agg(F.min("doc_id").alias("doc_id"))
    # Only rows of one id and one text meet in these joins: a large group of copies is no hot key.
    copies = saved(keys.alias("k").join(first.alias("f"), _same("k", "f"), "left_anti").distinct(), "repeat-copies")
    small = max(16, spec.bits - 4)
    copied = context.broadcast(bloom(_marks(copies.select("k1"), small), small))
    repeated = keys.groupBy("doc_id").count().where("count > 1 AND doc_id IS NOT NULL").select("doc_id")
    integer = id_type in ("tinyint", "smallint", "int", "bigint")
    twice = context.broadcast(bloom(_marks(repeated.select(F.col("doc_id").cast("long")), small), small) if integer else np.zeros(1, np.uint8))
    alone, many = (_by_key(docs, copied, twice, id_type, spec.window, hit) for hit in (False, True))
    texts = saved(alone.unionByName(many.alias("m").join(copies.alias("c"), _same("m", "c"), "left_anti")), "repeat-texts")

    blocks = context.broadcast(bloom(_block_marks(texts, spec), spec.bits))
    counted = _anchor_counts(texts, blocks, spec).groupBy("h").agg(F.sum("n").alias("n"), F.sum("blocks").alias("blocks"))
    anchors = context.broadcast(bloom(_marks(counted.where("n > 1 AND blocks > 0").select("h"), spec.bits), spec.bits))
    blocks.destroy()
    order = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "k", "start")).alias("first")
    first = _window_rows(texts, anchors, spec, id_type).groupBy("w1", "w2").agg(order, F.max("around").alias("around"))
    own = first.groupBy("first.doc_id", "first.k").agg(
        F.collect_list("first.start").alias("own"), F.max("around").alias("around"), F.max(F.when(F.col("first.start") == -1, F.col("w1"))).alias("k1")
    )
    own = saved(own, "repeat-own")
    known = own.select("doc_id", "k", "own", "around", F.lit(False).alias("whole"))
    known = known.unionByName(_told_apart(copies, twice, id_type).withColumn("whole", F.lit(True)), allowMissingColumns=True)
    changed = context.broadcast(bloom(_marks(own.select("k1").unionByName(copies.select("k1")), small), small))

    schema = to_arrow_schema(StructType.fromDDL(f"doc_id {id_type}, {_OUT}"))

    def clean(batches):
        """Rows without an anchor and without a copy keep all words."""
        for batch, texts, n in _texts(batches):
            k1 = np.array([_key(t)[0] for t in texts], np.int64)
            at = np.flatnonzero((n < spec.window) | ~in_bloom(changed.value, k1.view(np.uint64)))
            yield _columns(batch.column("doc_id").take(pa.array(at)), n[at], np.zeros(len(at), np.int64), [[]] * len(at), [texts[i] for i in at], schema)

    def finish(batches):
        for batch, texts, n in _texts(batches):
            rows, own = [], batch.column("own")
            ends, starts = own.offsets.to_numpy(), own.values.to_numpy()
            for i, (t, around, whole) in enumerate(zip(texts, *(batch.column(c).to_pylist() for c in ("around", "whole")))):
                mine = starts[ends[i] : ends[i + 1]]
                at = np.arange(n[i] - spec.window + 1) if whole else np.setdiff1d(_unpacked(around), mine, assume_unique=True)
                rows.append(_cut(t, n[i], at, spec.window))
            yield _columns(batch.column("doc_id"), n, *zip(*rows), schema)

    # The one join that moves texts; a document and its row in ``known`` meet alone.
    rows = _by_key(docs, changed, twice, id_type, spec.window, True).alias("t").join(known.alias("o"), _same("t", "o", ("doc_id", "k")), "left")
    rows = rows.select("t.doc_id", "t.text", "o.own", "o.around", F.coalesce("o.whole", F.lit(False)).alias("whole"))
    return docs.mapInArrow(clean, f"doc_id {id_type}, {_OUT}").unionByName(rows.mapInArrow(finish, f"doc_id {id_type}, {_OUT}"))
