"""Spelling variants by finite-state composition: vocabulary o one edit o vocabulary.

The words of the vocabulary form an acceptor.  Composed with a transducer that inserts, deletes or
replaces exactly one code point, and with the acceptor again, it accepts the pairs of words at
distance one.  The composition is enumerated in partitions of its start: of a pair with one edit, the first
half of the shorter word stands at the start of both, or its second half at the end of both.  So
every word goes to the partitions of its halves; there, what the words have in common is read
off and the rest is a small acceptor, minimised, that the composition walks: without an edit
both sides stand in one state, after the edit two states read the same code points.

Partitions of more than ``most`` words are cut again (halves of the rest that may hold the edit) until they
are small enough or the rest is too short to be cut, and then holds at most an alphabet to the
power of that length.  A pair is reported in one partition only: that of its first halves that agree.

Defined results: a null text has no runs, a null id reads as an empty string in ``<id>:<run>``.
Repeated rows count again.  Other columns are ignored.  An empty table gives no words.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.text import pieces, saved

_RUN = "[A-Za-zÀ-ÿ]{%d,}"


@dataclass(frozen=True)
class SpellingSpec:
    """Words of at least ``shortest`` code points and ``least`` occurrences; a form has ``factor`` times
    the occurrences.  With ``drop`` d > 0, runs whose crc32 d divides lose one code point."""

    shortest: int = 5
    least: int = 3
    factor: int = 2
    drop: int = 97
    most: int = 20_000

    def __post_init__(self):
        if self.factor < 2 or self.shortest < 2:
            raise ValueError("forms need a factor of 2 or more, words 2 code points or more")


def word_of(seed: int, run: str, drop: int) -> str:
    """The counted form of a lower-cased run: where ``drop`` divides the hash, without one code point.

    ``seed`` is the crc32 of what stands before the run."""
    h = zlib.crc32(run.encode(), seed)
    if drop and h % drop == 0:
        k = h % len(run)
        return run[:k] + run[k + 1 :]
    return run


def vocabulary(docs: DataFrame, spec: SpellingSpec = SpellingSpec()) -> DataFrame:
    """(word, n): words of the whole texts with their occurrences, summed in each task first."""
    shortest, drop = spec.shortest, spec.drop
    runs = re.compile(_RUN % shortest).findall  # shorter runs make no word

    def run(batches):
        counts: Counter = Counter()
        for batch in pieces(batches):
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                seed = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for found, n in Counter(runs((text or b"").lower().decode())).items():  # bytes lower A-Z alone
                    word = word_of(seed, found, drop)
                    if len(word) >= shortest:
                        counts[word] += n
            if len(counts) > 300_000:
                yield _counted(counts)
                counts.clear()
        yield _counted(counts)

    rows = docs.select("doc_id", "text").mapInArrow(run, "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= spec.least)


def _counted(counts: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])


# ------------------------------------------------------------------ partitions


def _first_keys(words: DataFrame, shortest: int) -> DataFrame:
    """Each word in the partitions of its halves, as the shorter word (``l`` its length) and as the longer one.

    ``i`` code points at the start and ``j`` at the end are common to a partition, ``path`` tells which
    halves were kept so far (P the first, S the second).
    """
    length = F.char_length("word")
    rows = words.withColumn("l", F.explode(F.array(length, length - 1))).where(F.col("l") >= shortest)
    return _halved(rows.withColumns({"i": F.lit(0), "j": F.lit(0), "path": F.lit("")}))


def _halved(rows: DataFrame) -> DataFrame:
    half = F.floor((F.col("l") - F.col("i") - F.col("j")) / 2).cast("int")
    rest = F.col("l") - F.col("i") - F.col("j") - half
    both = F.array(
        F.struct((F.col("i") + half).alias("i"), F.col("j").alias("j"), F.concat("path", F.lit("P")).alias("path")),
        F.struct(F.col("i").alias("i"), (F.col("j") + rest).alias("j"), F.concat("path", F.lit("S")).alias("path")),
    )
    out = rows.withColumn("side", F.explode(both)).select("word", "n", "l", "side.*")
    return out.withColumn("key", F.concat(F.expr("substring(word, 1, i)"), F.lit("\u0001"), F.expr("substring(word, char_length(word) - j + 1, j)")))


_KEY = ["l", "path", "key"]


def partitions(words: DataFrame, spec: SpellingSpec) -> DataFrame:
    """(l, i, j, path, key, members): words of a partition, none of more than ``spec.most`` that can be cut."""
    rows, done = _first_keys(words, spec.shortest), None
    while True:
        rows = saved(rows, "spelling-keys")
        sizes = rows.groupBy(*_KEY).agg(F.count("*").alias("size"))
        room = F.col("l") - F.col("i") - F.col("j")
        large = sizes.where(F.col("size") > spec.most)
        cut = rows.join(large.select(*_KEY), _KEY, "left_semi").where(room > 1)
        if cut.isEmpty():
            return rows if done is None else done.unionByName(rows)
        kept = rows.join(large.select(*_KEY), _KEY, "left_anti").unionByName(rows.join(large.select(*_KEY), _KEY, "left_semi").where(room <= 1))
        done = kept if done is None else done.unionByName(kept)
        rows = _halved(cut.drop("key"))


# ------------------------------------------------------------------ acceptor and composition


def acceptor(words: list[str]) -> tuple[int, list[dict]]:
    """Minimal deterministic acceptor of sorted distinct words: start state and the arcs of each state.

    The arc "" (to no state) marks a final state.  States with equal arcs are one.
    """
    arcs: list[dict] = []
    register: dict[tuple, int] = {}

    def state(out: dict) -> int:
        sign = tuple(out.items())
        if sign not in register:
            register[sign] = len(arcs)
            arcs.append(out)
        return register[sign]

    path: list[dict] = [{}]
    last = ""
    for word in words:
        same = 0
        while same < len(last) and same < len(word) and last[same] == word[same]:
            same += 1
        for k in range(len(last), same, -1):
            path[k - 1][last[k - 1]] = state(path.pop())
        path += [{} for _ in word[same:]]
        path[-1][""] = -1
        last = word
    for k in range(len(last), 0, -1):
        path[k - 1][last[k - 1]] = state(path.pop())
    return state(path[0]), arcs


def compose(start: int, arcs: list[dict]) -> set[tuple[str, str]]:
    """Pairs (shorter or smaller word, other word) that the acceptor, one edit and the acceptor accept."""
    pairs: set[tuple[str, str]] = set()

    def common(p: int, q: int):
        """Words that two states both accept."""
        walks = [(p, q, "")]
        while walks:
            p, q, read = walks.pop()
            for c, to in arcs[p].items():
                if c in arcs[q]:
                    if c:
                        walks.append((to, arcs[q][c], read + c))
                    else:
                        yield read

    todo = [(start, "")]
    while todo:
        at, read = todo.pop()
        out = [(c, to) for c, to in arcs[at].items() if c]
        for k, (c, to) in enumerate(out):
            todo.append((to, read + c))
            for d, other in out[k + 1 :]:  # replace
                for tail in common(to, other):
                    pairs.add((read + c + tail, read + d + tail) if c < d else (read + d + tail, read + c + tail))
            for tail in common(at, to):  # insert
                pairs.add((read + tail, read + c + tail))
    return pairs


def own_path(a: str, b: str, path: str) -> bool:
    """Whether a pair (``a`` not longer) belongs to the partition of this path: first halves first."""
    i = j = 0
    for side in path:
        room = len(a) - i - j
        half = room // 2
        first = a[i : i + half] == b[i : i + half]
        if first != (side == "P"):
            return False
        i, j = (i + half, j) if first else (i, j + room - half)
    return True


def near_pairs(words: DataFrame, spec: SpellingSpec = SpellingSpec()) -> DataFrame:
    """(a, b, na, nb): each pair of words at distance one, once."""
    grouped = partitions(words, spec).groupBy(*_KEY, "i", "j").agg(F.collect_list(F.struct("word", "n")).alias("members"))

    def run(batches):
        for batch in pieces(batches, 200):
            rows = {c: batch.column(c).to_pylist() for c in ("l", "i", "j", "path", "members")}
            found = []
            for l, i, j, path, members in zip(*rows.values()):
                number = {m["word"]: m["n"] for m in members}
                head, tail = (w := members[0]["word"])[:i], w[len(w) - j :]
                middles = sorted(w[i : len(w) - j] for w in number)
                for a, b in compose(*acceptor(middles)):
                    a, b = head + a + tail, head + b + tail
                    if len(a) == l and own_path(a, b, path):
                        found.append((a, b, number[a], number[b]))
            if found:
                a, b, na, nb = zip(*found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a, pa.string()), pa.array(b, pa.string()), pa.array(na, pa.int64()), pa.array(nb, pa.int64())], names=["a", "b", "na", "nb"]
                )

    return grouped.where(F.size("members") > 1).mapInArrow(run, "a string, b string, na long, nb long")


def variants(docs: DataFrame, spec: SpellingSpec = SpellingSpec()) -> DataFrame:
    """Per word: ``form`` (its near word of most occurrences, if ``factor`` times its own), ``root``
    (the last of the chain of forms), ``n``, ``n_near``, ``form_n``."""
    words = saved(vocabulary(docs, spec), "spelling-words")
    pairs = near_pairs(words, spec)
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), F.col("nb").alias("na"), F.col("na").alias("nb")))
    near = both.groupBy(F.col("a").alias("word")).agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("nb")).alias("less"), "b")).alias("best"))
    rows = words.join(near, "word", "left").withColumn("form_n", -F.col("best.less"))
    has = F.col("form_n") >= spec.factor * F.col("n")
    rows = rows.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(has, F.col("best.b")).alias("form"), F.when(has, F.col("form_n")).alias("form_n")
    )
    rows = saved(rows, "spelling-near")
    return rows.join(roots(rows), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def roots(rows: DataFrame) -> DataFrame:
    """(word, root) of the words with a form, by doubling the step along the chain in each round.

    Occurrences at least double along a chain, so a few rounds end it.
    """
    links = saved(rows.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        steps = links.select(F.col("word").alias("mid"), F.col("root").alias("far"))
        joined = links.join(steps, F.col("root") == F.col("mid"), "left")
        moved = saved(joined.select("word", F.coalesce("far", "root").alias("root"), F.col("far").isNotNull().alias("moved")), "spelling-roots")
        links = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return links
