"""Similarity self-join of word shingle sets by prefix filters under several token orders.

Two sets with Jaccard similarity of at least ``percent`` share a token among the first
``n - ceil(percent * n / 100) + 1`` tokens of each, whatever order the tokens are put in, as long as
it is the same for both.  The first order (rare tokens first, then by hash) finds candidates
through a shuffle on the prefix tokens; the filters of the other orders are intersected with it
on each candidate before its overlap is counted.

Large groups of near copies would make all pairs of a bucket quadratic.  Only what decides the
components is joined, without losing a link between components:

1. Within a bucket (documents that share a prefix token) every document is paired with one
   *hub*, the one whose tokens are the most frequent: linear in the size of the bucket.  The
   prefixes are lengthened so that linked sets share several tokens; chance meetings over
   a token or two can then be left out.
2. Where a document is not linked to its hub, it may be linked to another document of the
   hub's group.  Put the hub's own tokens last in the order: such a pair shares a token outside
   the hub in both prefixes (an equi-join), or shares hub tokens only, and then its
   overlap is at most the smaller overlap with the hub, which the sizes decide beforehand.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.sketch import block_batch, marked, merged
from tidemark.llm.text import WordHashes, map_rows, mix, pieces, saved, shingles


@dataclass(frozen=True)
class JoinSpec:
    """``percent`` is the least Jaccard similarity times 100; ``orders`` counts the token orders.

    ``sketch_bits`` sizes the table of token frequencies (one byte for each of 2**bits buckets,
    broadcast): it only shapes the first order, which is exact for any table.  Tokens of
    buckets above twice the mean plus ``hot_count`` are dealt out over several partitions.
    """

    shingle: int = 5
    percent: int = 80
    orders: int = 3
    sketch_bits: int = 22
    filter_bits: int = 24
    hot_count: int = 1024

    def prefix(self, n: int, shared: int = 1) -> int:
        """Length of a prefix in which two linked sets share at least ``shared`` tokens."""
        return n - (self.percent * n + 99) // 100 + shared

    def shared(self, n: int) -> int:
        """Tokens that the prefixes of the first order share: one and a twenty-fifth of the set."""
        return 1 + n // 25

    def spare(self) -> str:
        """SQL for the tokens of a set of ``n`` that may go unread: those of two linked sets (sizes within
        ``percent``) together stay below what their prefixes share."""
        return f"CAST(FLOOR(n * {self.percent} / (25.0 * (100 + {self.percent}))) AS BIGINT)"


def profile(docs: DataFrame, spec: JoinSpec) -> DataFrame:
    """Rows (doc, n, s1, s2) for documents and (block, data) for the token counts of each task."""
    size, shift = 1 << spec.sketch_bits, np.uint64(64 - spec.sketch_bits)
    schema = pa.schema([("doc", pa.int64()), ("n", pa.int64()), ("s1", pa.int64()), ("s2", pa.int64()), ("block", pa.int32()), ("data", pa.binary())])

    def run(batches):
        hashes, counts = WordHashes(), np.zeros(size, np.uint32)
        for batch in pieces(batches):
            rows, held = [], []
            for text in batch.column("text").to_pylist():
                s = shingles(hashes, text, spec.shingle)
                held.append(s)
                rows.append((len(s), int(s.sum(dtype=np.uint64).view(np.int64)), int(np.bitwise_xor.reduce(mix(s)).view(np.int64)) if len(s) else 0))
            seen, often = np.unique(np.concatenate(held) >> shift, return_counts=True)
            counts[seen.astype(np.int64)] += often.astype(np.uint32)
            empty = pa.nulls(len(rows), pa.int32()), pa.nulls(len(rows), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc"), *[pa.array(c, pa.int64()) for c in zip(*rows)], *empty], schema=schema)
        found = block_batch(counts)
        yield pa.RecordBatch.from_arrays([*[pa.nulls(found.num_rows, pa.int64())] * 4, *found.columns], schema=schema)

    return docs.mapInArrow(run, "doc long, n long, s1 long, s2 long, block int, data binary")


def frequency_levels(profiled: DataFrame, spec: JoinSpec) -> np.ndarray:
    """log2 of the token count of each bucket, rounded down: 2**sketch_bits bytes on the driver."""
    blocks = profiled.where("block IS NOT NULL").select("block", "data")
    return merged(blocks, 1 << spec.sketch_bits, lambda c: np.log2(c + np.uint64(1)).astype(np.uint8))


class Orders:
    """Token orders that all tasks agree on: rare buckets first, then a hash of the order's own."""

    def __init__(self, levels: np.ndarray, spec: JoinSpec):
        self.levels, self.shift = levels, np.uint64(64 - spec.sketch_bits)

    def level(self, s: np.ndarray) -> np.ndarray:
        return self.levels[(s >> self.shift).astype(np.int64)]

    def ranked(self, s: np.ndarray, order: int, level: np.ndarray | None = None) -> np.ndarray:
        """Positions of the tokens of a set in the given order."""
        level = self.level(s) if level is None else level
        h = s if order == 0 else mix(s + np.uint64(order * 0x5851F42D4C957F2D & (2**64 - 1)))
        return np.argsort((level.astype(np.uint64) << np.uint64(57)) | (h >> np.uint64(7)), kind="stable")


def stars(docs: DataFrame, levels, spec: JoinSpec) -> DataFrame:
    """Rows (hub, doc, token, pref, tokens): documents next to the hub of ``tokens`` buckets of the first order.

    ``token`` is null except for hot tokens, whose bucket is dealt out: their hubs are local
    to a part and are paired with the best of all parts by :func:`hub_pairs`.
    """
    mean = docs.sparkSession.sparkContext.broadcast(levels)

    def post(batches):
        orders, hashes = Orders(mean.value, spec), WordHashes()
        typical = float(np.median(orders.levels)) if len(orders.levels) else 0.0
        hot_from = int(np.log2(2 * 2.0**typical + spec.hot_count))
        for batch in pieces(batches):
            keys, tokens, ids, prefs = [], [], [], []
            for doc, text in zip(batch.column("doc").to_pylist(), batch.column("text").to_pylist()):
                s = shingles(hashes, text, spec.shingle)
                if doc is None or not len(s):
                    continue
                level = orders.level(s)
                p = spec.prefix(len(s), spec.shared(len(s)))
                first = orders.ranked(s, 0, level)[:p]
                token, lv = s[first], level[first].astype(np.int64)
                hot = lv >= hot_from
                parts = np.uint64(1) << np.clip(lv - 9, 1, 20).astype(np.uint64)
                key = np.where(hot, mix(token + mix(np.full(p, doc, np.int64).view(np.uint64)) % parts + np.uint64(1)), token)
                keys.append(key)
                tokens.append(np.where(hot, token, np.uint64(0)))
                ids.append(np.full(p, doc, np.int64))
                prefs.append(np.full(p, int(level.mean() * 1000), np.int32))
            if keys:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(tokens).view(np.int64)), pa.array(np.concatenate(ids)), pa.array(np.concatenate(prefs))],
                    names=["key", "token", "doc", "pref"],
                )

    def pair(batches):
        last_key = hub = None
        for batch in batches:
            key, token, doc, pref = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(4))
            if not len(key):
                continue
            start = np.ones(len(key), bool)
            start[1:] = key[1:] != key[:-1]
            carried = key[0] == last_key
            if carried:
                start[0] = False
            at = np.flatnonzero(start)
            which = np.cumsum(start) - 1
            hubs = np.where(which >= 0, doc[at[np.maximum(which, 0)]] if len(at) else hub, hub if carried else 0).astype(np.int64)
            last_key, hub = key[-1], hubs[-1]
            keep = (~start & (hubs != doc)) | (token != 0)
            cold = keep & (token == 0)
            a, b = hubs[cold], doc[cold]
            by = np.lexsort((b, a))
            a, b = a[by], b[by]
            new = np.ones(len(a), bool)
            new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
            runs = np.flatnonzero(new)
            warm = keep & (token != 0)
            n = len(runs)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([a[runs], hubs[warm]])), pa.array(np.concatenate([b[runs], doc[warm]])),
                    pa.array(np.concatenate([np.zeros(n, np.int64), token[warm]]), mask=np.concatenate([np.ones(n, bool), np.zeros(int(warm.sum()), bool)])),
                    pa.array(np.concatenate([np.zeros(n, np.int32), pref[warm]])),
                    pa.array(np.concatenate([np.diff(np.append(runs, len(a))), np.ones(int(warm.sum()), np.int64)])),
                ],
                names=["hub", "doc", "token", "pref", "tokens"],
            )

    posted = docs.mapInArrow(post, "key long, token long, doc long, pref int")
    dealt = posted.repartition("key").sortWithinPartitions("key", F.desc("pref"), "doc")
    return dealt.mapInArrow(pair, "hub long, doc long, token long, pref int, tokens long")


def hub_pairs(found: DataFrame, sizes: DataFrame, spec: JoinSpec) -> DataFrame:
    """Distinct (a, b): hub and document, with one hub for all parts of a hot token.

    Prefixes are longer than they need be, so linked sets share several tokens.  That allows
    each document to leave the hubs with which it shares the fewest tokens, up to ``spare``
    tokens of its set size (``sizes``: doc, n): any two linked documents still meet at one hub.
    """
    hot = found.where("token IS NOT NULL")
    best = hot.where("hub = doc").groupBy("token").agg(F.min(F.struct(-F.col("pref"), "hub"))["hub"].alias("a"))
    apart = hot.join(best, "token").select("a", F.col("doc").alias("b"), "tokens")
    met = found.where("token IS NULL").select(F.col("hub").alias("a"), F.col("doc").alias("b"), "tokens").unionByName(apart)
    met = met.where("a <> b").groupBy("a", "b").agg(F.sum("tokens").alias("tokens"))
    met = met.join(sizes.groupBy(F.col("doc").alias("b")).agg(F.min("n").alias("n")), "b")
    lost = F.sum("tokens").over(Window.partitionBy("b").orderBy("tokens", "a").rowsBetween(Window.unboundedPreceding, 0))
    return met.withColumn("lost", lost).where(f"lost > {spec.spare()}").select("a", "b")


def verify(pairs: DataFrame, docs: DataFrame, levels: np.ndarray, spec: JoinSpec, describe: bool) -> DataFrame:
    """(a, b, linked) for candidate pairs; with ``describe`` also what the second round needs:
    set sizes ``n_a``, ``n_b``, the overlap ``h``, the tokens of b outside a within the prefix
    (``extras``) and whether tokens of a reach into it (``inside``)."""
    shared = docs.sparkSession.sparkContext.broadcast(levels)
    texts = marked(docs, pairs.select("a", "b"), "doc", True, spec.filter_bits)
    joined = pairs.select("a", "b").join(texts.select(F.col("doc").alias("b"), F.col("text").alias("tb")), "b")
    joined = joined.join(texts.select(F.col("doc").alias("a"), F.col("text").alias("ta")), "a").select("a", "b", "ta", "tb")

    def make():
        orders, hashes = Orders(shared.value, spec), WordHashes()

        def prepared(text):
            s = shingles(hashes, text, spec.shingle)
            level, p = orders.level(s), spec.prefix(len(s))
            return s, [np.sort(s[orders.ranked(s, k, level)[:p]]) for k in range(spec.orders)]

        def work(columns):
            rows, last_text, last = [], None, None
            for ta, tb in zip(columns["ta"].to_pylist(), columns["tb"].to_pylist()):
                if ta != last_text or last is None:
                    last_text, last = ta, prepared(ta)
                (sa, pa_), (sb, pb) = last, prepared(tb)
                fits = 100 * min(len(sa), len(sb)) >= spec.percent * max(len(sa), len(sb)) and all(
                    len(np.intersect1d(x, y, assume_unique=True)) for x, y in zip(pa_, pb)
                )
                if not fits and not describe:
                    rows.append((False,))
                    continue
                inside = np.isin(sb, sa, assume_unique=True)
                h = int(inside.sum())
                linked = fits and 100 * h >= spec.percent * (len(sa) + len(sb) - h)
                if not describe:
                    rows.append((linked,))
                    continue
                p, own = spec.prefix(len(sb)), sb[~inside]
                own = own[orders.ranked(own, 0)[:p]]
                rows.append((linked, len(sa), len(sb), h, len(sb) - h < p, own.view(np.int64)))
            names = ["linked", "n_a", "n_b", "h", "inside", "extras"][: 6 if describe else 1]
            return {"a": columns["a"], "b": columns["b"], **dict(zip(names, zip(*rows)))}

        return work

    more = ", n_a long, n_b long, h long, inside boolean, extras array<long>" if describe else ""
    return map_rows(joined, f"a long, b long, linked boolean{more}", make)


def second_round(checked: DataFrame, first: DataFrame, spec: JoinSpec) -> DataFrame:
    """Pairs (a, b) that may still link different components inside the groups of the hubs."""
    labels = first.select(F.col("node").alias("b"), F.col("component"))
    hub = first.select(F.col("node").alias("a"), F.col("component").alias("ca"))
    rows = checked.join(labels, "b", "left").join(hub, "a", "left").select(
        "a", "b", "n_b", "h", "inside", "extras",
        F.coalesce("component", "b").alias("c"), F.coalesce("ca", "a").alias("ca"),
    )
    rows = rows.withColumn("open", F.col("c") != F.col("ca"))
    groups = rows.where("open").select("a").distinct()
    rows = saved(rows.join(groups, "a", "left_semi"), "groups")

    near = F.lit(spec.percent) * F.greatest("x.n_b", "y.n_b") <= 100 * F.least("x.n_b", "y.n_b")
    apart = (F.col("x.c") != F.col("y.c")) & near & (~F.col("y.open") | (F.col("x.b") < F.col("y.b")))
    out = [F.least("x.b", "y.b").alias("a"), F.greatest("x.b", "y.b").alias("b")]

    each = rows.select("a", "b", "n_b", "c", "open", F.explode("extras").alias("token"))
    mixed = each.groupBy("a", "token").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo <> hi").select("a", "token")
    each = saved(each.join(mixed, ["a", "token"], "left_semi"), "extras")
    outside = each.where("open").alias("x").join(each.alias("y"), ["a", "token"]).where(apart).select(*out)

    # no shared token outside the hub: the overlap is at most min(h, h')
    part = lambda n: F.floor(F.log(n.cast("double")) / F.log(F.lit(1.08))).cast("int")
    most = F.floor((100 + spec.percent) * F.col("h") / spec.percent) - F.col("n_b")
    least = F.ceil(F.col("n_b") * spec.percent / 100)
    small = rows.where("inside").select("a", "b", "n_b", "h", "c", "open")
    probes = small.where("open").withColumns({"least": least, "most": most}).where("most >= least")
    probes = probes.withColumn("size", F.explode(F.sequence(part(F.col("least")), part(F.col("most")))))
    other = small.withColumn("size", part(F.col("n_b")))
    m = F.least("x.h", "y.h")
    bound = 100 * m >= spec.percent * (F.col("x.n_b") + F.col("y.n_b") - m)
    inside = probes.alias("x").join(other.alias("y"), ["a", "size"]).where(apart & bound).select(*out)
    return outside.unionByName(inside).distinct()


def near_duplicates(docs: DataFrame, spec: JoinSpec | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``id_col``, n_shingles, component_id), one row per input row.

    ``component_id`` is the smallest id reachable over links, the row's own included.  A null
    text or one without words has an empty set, links with nothing and is its own component.
    Rows with a null id are measured but have no component.  Rows that share an id are one
    node: a link of any of them links the id.  Equal sets are linked without being compared.
    Ids are integers; other columns are not read.  Every link between different sets is found or
    known to lie inside one component.
    """
    spec = spec or JoinSpec()
    base = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    profiled = saved(profile(base, spec), "profile")
    levels = frequency_levels(profiled, spec)

    sets = profiled.where("block IS NULL").select("doc", "n", "s1", "s2")
    known = sets.where("doc IS NOT NULL AND n > 0")
    least = known.groupBy("n", "s1", "s2").agg(F.min("doc").alias("rep"), F.max("doc").alias("other"))
    copies = known.join(least.where("rep <> other"), ["n", "s1", "s2"]).select("doc", "rep").distinct()
    copies = saved(copies, "copies")
    ambiguous = known.groupBy("doc").agg(F.min(F.struct("n", "s1", "s2")).alias("lo"), F.max(F.struct("n", "s1", "s2")).alias("hi")).where("lo <> hi").select("doc")
    stand_in = copies.where("doc <> rep").join(ambiguous, "doc", "left_anti")

    found = saved(stars(base, levels, spec), "stars")
    pairs = hub_pairs(found, known, spec)
    for side in ("a", "b"):
        pairs = pairs.join(stand_in.select(F.col("doc").alias(side), F.col("rep").alias("_rep")), side, "left").withColumn(side, F.coalesce("_rep", side)).drop("_rep")
    pairs = saved(pairs.where("a <> b").distinct(), "pairs")

    checked = saved(verify(pairs, base, levels, spec, describe=True), "checked")
    links = checked.where("linked").select("a", "b").unionByName(copies.where("doc <> rep").select(F.col("doc").alias("a"), F.col("rep").alias("b")))
    first = components(links)
    more = saved(second_round(checked, first, spec), "pairs")
    more_links = saved(verify(more, base, levels, spec, describe=False).where("linked").select("a", "b"), "links")
    joined = more_links.join(first.select(F.col("node").alias("a"), F.col("component").alias("ca")), "a", "left")
    joined = joined.join(first.select(F.col("node").alias("b"), F.col("component").alias("cb")), "b", "left")
    over = components(joined.select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")))

    final = first.join(over.select(F.col("node").alias("component"), F.col("component").alias("last")), "component", "left")
    final = final.select("node", F.coalesce("last", "component").alias("component")).unionByName(over.join(first, "node", "left_anti"))
    return sets.join(final.withColumnRenamed("node", "doc"), "doc", "left").select(
        F.col("doc").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component", "doc").alias("component_id")
    )


def keep_first(docs: DataFrame, spec: JoinSpec | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its component (or null), all columns kept.

    Of rows that repeat one id, one with the greatest text is kept.
    """
    spec = spec or JoinSpec()
    found = near_duplicates(docs, spec, id_col, text_col).where(F.col(id_col) != F.col("component_id"))
    dropped = saved(found.select(F.col(id_col).cast("long").alias("_gone")).distinct(), "dropped")
    suspects = marked(docs, dropped, id_col, True, spec.filter_bits)
    rest = marked(docs, dropped, id_col, False, spec.filter_bits).unionByName(suspects.join(dropped, F.col(id_col) == F.col("_gone"), "left_anti"))
    again = saved(docs.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_twice")).count().where("count > 1").select("_twice"), "twice")
    if again.isEmpty():
        return rest
    many = rest.join(again, F.col(id_col) == F.col("_twice"), "left_semi")
    once = rest.join(again, F.col(id_col) == F.col("_twice"), "left_anti")
    row = F.struct(F.col(text_col).alias("_t"), *[F.col(f"`{c}`") for c in docs.columns])
    return once.unionByName(many.groupBy(F.col(id_col).alias("_id")).agg(F.max(row).alias("_r")).select(*[F.col("_r").getField(c).alias(c) for c in docs.columns]))
