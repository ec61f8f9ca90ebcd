"""Phrase collocations from a weighted de Bruijn graph of words.

A node is a word pair, an edge a word triple that joins two overlapping pairs, its weight the
triple's occurrences.  Only edges are counted, and where a piece of text ends; the rest is flow:

    f(x y) = weight that leaves the node (x, y)   + pieces that end in x y
    f(x)   = flow of all nodes that start with x  + pieces that end in x

1. *Screen*: hashes of all edges and nodes are summed, packed in sorted buckets, and those that reach
   ``least`` are marked in two bitmaps of fixed size.
2. *Count*: in a second reading each occurrence leaves its edge (x, y, z) where that is marked, its
   node (x, y) where only that is, else the word x.  What a task has summed is
   small, words and phrases are compared as texts, so that chance hits of a bitmap only cost work.
3. *Flow*: one hierarchy of sums gives the exact counts of triples, pairs and words.
4. *Unary paths*: a node with one edge in and one out, both of its own weight, is always part of
   the longer phrase; such nodes are compacted (see :func:`unary_paths`) and are no candidates.

Defined results: null text is empty, null lang is ``und``; null ids and repeated rows count like
others.  Other columns are ignored.  An empty table gives no phrases.  Arithmetic is exact (decimals of 38
digits) up to 10**15 occurrences.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from dataclasses import dataclass
from itertools import compress

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.sketch import MARKS, bloom, in_bloom, mark_batches
from tidemark.llm.text import WordHashes, mix, pieces, saved

_PIECES = re.compile(b"[.,;:!?\n\v\f\r]")
_ODD = np.uint64(0x9E3779B97F4A7C15)
_SHORT = np.uint64(16)  # the screen's hashes have 48 bits: a chance hit costs work, not results


@dataclass(frozen=True)
class CollocationSpec:
    """Phrases of 2 or 3 words with at least ``least`` occurrences, ``top`` of each lang.  A candidate is
    dropped if a longer one holds ``inside`` percent of its occurrences.  ``bits`` sizes the bitmaps
    (16 MB each); ``bucket`` is about how many distinct hashes one bucket of the screen sums at once."""

    least: int = 10
    inside: int = 50
    top: int = 2000
    bits: int = 27
    bucket: int = 2_000_000


def _sequences(batches):
    """(lang, words of all pieces of the batch's texts in that lang, piece number of each word)."""
    for batch in pieces(batches):
        by_lang: dict[str, list] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
            if text:
                by_lang.setdefault("und" if lang is None else lang, []).append(text.lower())  # bytes lower A-Z alone
        for lang, texts in by_lang.items():
            parts = [w for t in texts for p in _PIECES.split(t) if (w := p.split())]
            words = [x for w in parts for x in w]
            if words:
                yield lang, words, np.repeat(np.arange(len(parts)), [len(w) for w in parts])


def _grams(ids: np.ndarray, piece: np.ndarray, seed: np.uint64) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash of the pair and of the triple that start at each word; false where the piece ends before."""
    n = len(ids)
    pair, triple = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
    has2, has3 = np.zeros(n, bool), np.zeros(n, bool)
    has2[:-1] = piece[:-1] == piece[1:]
    has3[:-2] = piece[:-2] == piece[2:]
    own = ids + seed
    pair[:-1] = own[:-1] * _ODD + ids[1:]
    pair = mix(pair)
    triple[:-2] = mix(pair[:-2] * _ODD + ids[2:])
    return pair >> _SHORT, has2, triple >> _SHORT, has3


def _seed(lang: str) -> np.uint64:
    return np.uint64(xxhash.xxh3_64_intdigest(lang.encode()))


_PACK = "bucket int, hashes binary, counts binary"


def _packed(h: np.ndarray, n: np.ndarray, buckets: int):
    """Rows of (bucket, sorted hashes, counts): differences of the sorted values, compressed."""
    pack = zstandard.ZstdCompressor(level=1).compress
    place = (h >> np.uint64(16)) * np.uint64(buckets) >> np.uint64(32)
    cuts = np.searchsorted(place, np.arange(buckets + 1, dtype=np.uint64))
    rows = []
    for k in range(buckets):
        a, b = cuts[k], cuts[k + 1]
        if b > a:
            gaps = np.diff(h[a:b], prepend=np.uint64(0))
            planes = np.ascontiguousarray(gaps.view(np.uint8).reshape(-1, 8)[:, :6].T)  # equal bytes side by side
            rows.append((k, pack(planes.tobytes()), pack(n[a:b].astype(np.uint32).tobytes())))
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), *[pa.array([r[c] for r in rows], pa.binary()) for c in (1, 2)]], names=["bucket", "hashes", "counts"])


def _unpacked(hashes: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    unpack = zstandard.ZstdDecompressor().decompress
    planes = np.frombuffer(unpack(hashes), np.uint8).reshape(6, -1)
    gaps = np.zeros((planes.shape[1], 8), np.uint8)
    gaps[:, :6] = planes.T
    return np.cumsum(gaps.reshape(-1).view(np.uint64), dtype=np.uint64), np.frombuffer(unpack(counts), np.uint32).astype(np.int64)


def _summed(h: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(h, kind="stable")
    h = h[order]
    first = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1]))) if len(h) else np.empty(0, np.int64)
    return h[first], np.add.reduceat(n[order], first) if len(h) else n


def _screen(docs: DataFrame, buckets: int, limit: int = 2_000_000) -> DataFrame:
    """Packed sums of the hashes of pairs and triples, about ``limit`` occurrences at a time."""

    def run(batches):
        hashes, held, size = WordHashes(), [], 0
        for lang, words, piece in _sequences(batches):
            pair, has2, triple, has3 = _grams(hashes.of(words), piece, _seed(lang))
            held += [pair[has2], triple[has3]]
            size += len(held[-1]) + len(held[-2])
            if size >= limit:
                yield _packed(*np.unique(np.concatenate(held), return_counts=True), buckets)
                held, size = [], 0
        if size:
            yield _packed(*np.unique(np.concatenate(held), return_counts=True), buckets)

    return docs.mapInArrow(run, _PACK)


def _frequent(packed: DataFrame, buckets: int, least: int, spec: CollocationSpec) -> DataFrame:
    """Marks of the hashes whose sum over all tasks reaches ``least``; one bucket is summed at a time."""
    most = spec.bucket // 2

    def run(batches):
        def marked():
            bucket, h, n, new = None, np.empty(0, np.uint64), np.empty(0, np.int64), []
            for batch in batches:
                for k, raw_h, raw_n in zip(*(batch.column(c).to_pylist() for c in range(3))):
                    if k != bucket or sum(len(x) for x, _ in new) > most:
                        h, n = _summed(np.concatenate([h, *[x for x, _ in new]]), np.concatenate([n, *[x for _, x in new]]))
                        new = []
                        if k != bucket:
                            yield h[n >= least]
                            bucket, h, n = k, h[:0], n[:0]
                    new.append(_unpacked(raw_h, raw_n))
            h, n = _summed(np.concatenate([h, *[x for x, _ in new]]), np.concatenate([n, *[x for _, x in new]]))
            yield h[n >= least]

        yield from mark_batches(marked(), spec.bits)

    return packed.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(run, MARKS)


_FLOW = "lang string, x string, y string, z string, n long"


def _flow(docs: DataFrame, shared) -> DataFrame:
    """(lang, x, y, z, n): each occurrence of a word x once, with y where the pair and with z where the triple
    may be frequent; summed within a task."""

    def batch_of(counts: dict) -> pa.RecordBatch:
        keys = [k.split(b" ") for c in counts.values() for k in c]
        texts = [pa.array([k[c] if len(k) > c else None for k in keys], pa.binary()).cast(pa.string()) for c in range(3)]
        langs = pa.array([lang for lang, c in counts.items() for _ in c], pa.string())
        return pa.RecordBatch.from_arrays([langs, *texts, pa.array([n for c in counts.values() for n in c.values()], pa.int64())], names=["lang", "x", "y", "z", "n"])

    def run(batches):
        hashes, counts = WordHashes(), defaultdict(Counter)
        for lang, words, piece in _sequences(batches):
            pair, has2, triple, has3 = _grams(hashes.of(words), piece, _seed(lang))
            edge = has3.copy()
            edge[has3] = in_bloom(shared.value, triple[has3])
            node = has2 & ~edge
            node[node] = in_bloom(shared.value, pair[node])
            own = counts[lang]
            own.update([words[k] + b" " + words[k + 1] + b" " + words[k + 2] for k in np.flatnonzero(edge).tolist()])
            own.update([words[k] + b" " + words[k + 1] for k in np.flatnonzero(node).tolist()])
            own.update(compress(words, (~edge & ~node).tolist()))
            if sum(map(len, counts.values())) > 300_000:
                yield batch_of(counts)
                counts.clear()
        if counts:
            yield batch_of(counts)

    return docs.mapInArrow(run, _FLOW)


@dataclass
class Graph:
    """``edges`` (lang, x, y, z, a), ``nodes`` (lang, x, y, a, ends), ``words`` (lang, x, a): those of at least
    ``least`` occurrences (all words); ``total`` (lang, n)."""

    edges: DataFrame
    nodes: DataFrame
    words: DataFrame
    total: DataFrame


def build_graph(docs: DataFrame, spec: CollocationSpec = CollocationSpec()) -> Graph:
    """Exact counts of the edges, nodes and words of (lang, text)."""
    docs = docs.select("lang", "text")
    size = docs.agg(F.sum(F.octet_length("text")), F.count("*")).first()
    # Every word starts a pair and a triple; a word and its space take two bytes at least, about six in prose.
    buckets = max(1, -(-int(size[0] or 0) // (3 * spec.bucket)))
    marks = _frequent(_screen(docs, buckets), buckets, spec.least, spec)
    shared = docs.sparkSession.sparkContext.broadcast(bloom(marks, spec.bits))
    flow = saved(_flow(docs, shared).groupBy("lang", "x", "y", "z").agg(F.sum("n").alias("n")), "collocation-flow")
    edges = flow.where(F.col("z").isNotNull() & (F.col("n") >= spec.least)).withColumnRenamed("n", "a")
    nodes = flow.where(F.col("y").isNotNull()).groupBy("lang", "x", "y").agg(F.sum("n").alias("a")).where(F.col("a") >= spec.least)
    words = saved(flow.groupBy("lang", "x").agg(F.sum("n").alias("a")), "collocation-words")
    return Graph(edges, saved(nodes, "collocation-nodes"), words, words.groupBy("lang").agg(F.sum("a").alias("n")))


def _sides(graph: Graph) -> DataFrame:
    """Per node: the number and the largest weight of its frequent edges on each side."""
    out = graph.edges.select("lang", "x", "y", F.lit(0).alias("side"), F.lit(None).cast("string").alias("w"), "a")
    into = graph.edges.select("lang", F.col("y").alias("x"), F.col("z").alias("y"), F.lit(1).alias("side"), F.col("x").alias("w"), "a")
    return out.unionByName(into).groupBy("lang", "x", "y").agg(
        F.count_if(F.col("side") == 0).alias("n_out"), F.count_if(F.col("side") == 1).alias("n_in"),
        F.max("w").alias("before"), F.max(F.when(F.col("side") == 0, F.col("a"))).alias("most_out"), F.max(F.when(F.col("side") == 1, F.col("a"))).alias("most_in"),
    )


def _with_sides(graph: Graph) -> DataFrame:
    sides = graph.nodes.join(_sides(graph), ["lang", "x", "y"], "left")
    unary = (F.col("n_in") == 1) & (F.col("n_out") == 1) & (F.col("most_in") == F.col("a")) & (F.col("most_out") == F.col("a"))
    return sides.withColumn("unary", F.coalesce(unary, F.lit(False)))


def unary_paths(graph: Graph) -> DataFrame:
    """(lang, phrase, n_words, a): the edges with their unary nodes compacted to paths.

    Every edge that leaves a unary node points to the one edge that enters it; the pointers double
    their steps until they stand on an edge that leaves another kind of node, the head of the path.
    Rings (a phrase that only ever follows itself) have no head and are left out.
    """
    nodes = _with_sides(graph).where("unary").select("lang", "x", "y", "before")
    edges = graph.edges.join(nodes, ["lang", "x", "y"], "left").select(
        "lang", F.struct("x", "y", "z").alias("edge"), "a",
        F.when(F.col("before").isNotNull(), F.struct(F.col("before").alias("x"), F.col("x").alias("y"), F.col("y").alias("z"))).alias("to"),
    )
    edges = edges.select("lang", "edge", "a", F.coalesce("to", "edge").alias("to"), F.col("to").isNotNull().cast("long").alias("steps"), F.col("to").isNull().alias("done"))
    before = -1
    while True:
        edges = saved(edges, "collocation-paths")
        reached = edges.where("done").count()
        if reached == before:
            break
        before = reached
        far = edges.select(F.col("lang").alias("_l"), F.col("edge").alias("_e"), F.col("to").alias("_to"), F.col("steps").alias("_s"), F.col("done").alias("_d"))
        moving = edges.where("NOT done").join(far, (F.col("lang") == F.col("_l")) & (F.col("to") == F.col("_e")))
        moved = moving.select("lang", "edge", "a", F.col("_to").alias("to"), (F.col("steps") + F.col("_s")).alias("steps"), F.col("_d").alias("done"))
        edges = edges.where("done").unionByName(moved)
    paths = edges.where("done").groupBy("lang", "to").agg(F.array_sort(F.collect_list(F.struct("steps", "edge.z"))).alias("rest"), F.first("a").alias("a"))
    words = F.concat(F.array("to.x", "to.y"), F.transform("rest", lambda r: r["z"]))
    return paths.select("lang", F.array_join(words, " ").alias("phrase"), F.size(words).cast("long").alias("n_words"), "a")


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 * a * a / (l * r)), exact."""
    big = [c.cast("decimal(15,0)") for c in (a, left, right)]
    return F.call_function("div", big[0] * big[0] * F.lit(1_000_000).cast("decimal(7,0)"), big[1] * big[2])


def mine(docs: DataFrame, spec: CollocationSpec = CollocationSpec()) -> DataFrame:
    """The ``top`` phrases of each lang: lang, rank, phrase, a, l, r, n, score."""
    graph = build_graph(docs, spec)
    inner = F.greatest(F.coalesce("most_in", F.lit(0)), F.coalesce("most_out", F.lit(0)))
    nodes = _with_sides(graph).where(~F.col("unary") & (100 * inner < spec.inside * F.col("a")))
    phrases = nodes.select("lang", F.array("x", "y").alias("w"), "a").unionByName(graph.edges.select("lang", F.array("x", "y", "z").alias("w"), "a"))
    rows = _with_words(phrases, graph, spec)
    for k in (1, 2):
        side = graph.nodes.select(F.col("lang").alias("_l"), F.col("x").alias("_x"), F.col("y").alias("_y"), F.col("a").alias(f"node{k}"))
        fits = (F.col("lang") == F.col("_l")) & (F.get("w", F.lit(k - 1)) == F.col("_x")) & (F.get("w", F.lit(k)) == F.col("_y"))
        rows = rows.join(side, fits, "left").drop("_l", "_x", "_y")
    two = _cut(0, F.col("a"), F.col("first"), F.col("last"))
    three = F.least(_cut(1, F.col("a"), F.col("first"), F.col("node2")), _cut(2, F.col("a"), F.col("node1"), F.col("last")))
    rows = rows.withColumn("cut", F.when(F.size("w") == 2, two).otherwise(three))
    rows = rows.select("lang", F.array_join("w", " ").alias("phrase"), "a", "cut.l", "cut.r", "cut.score")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    dealt = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(64))).orderBy(*order)
    best = rows.withColumn("rank", F.row_number().over(dealt)).where(F.col("rank") <= spec.top)  # no lang is one task
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= spec.top)
    return ranked.join(graph.total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _cut(k: int, a: Column, left: Column, right: Column) -> Column:
    """A cut after ``k`` words with its score; of two cuts the least is the one that counts."""
    return F.struct(_score(a, left, right).alias("score"), F.lit(k).alias("k"), left.alias("l"), right.alias("r"))


def _with_words(rows: DataFrame, graph: Graph, spec: CollocationSpec, salts: int = 8) -> DataFrame:
    """Adds the occurrences of the first and the last word of the phrase ``w``.

    The words of frequent phrases are frequent themselves; they are repeated over salts, so that no
    word that many phrases share is a hot key."""
    for name, word in (("first", F.element_at("w", 1)), ("last", F.element_at("w", -1))):
        side = graph.words.where(F.col("a") >= spec.least).select(
            F.col("lang").alias("_l"), F.col("x").alias("_x"), F.col("a").alias(name), F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_s")
        )
        salted = rows.withColumn("_salt", F.pmod(F.xxhash64("w"), F.lit(salts)).cast("int"))
        rows = salted.join(side, (F.col("lang") == F.col("_l")) & (word == F.col("_x")) & (F.col("_salt") == F.col("_s"))).drop("_l", "_x", "_s", "_salt")
    return rows
