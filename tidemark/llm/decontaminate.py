"""Benchmark decontamination by canonical templates: typed placeholders, a hash join of template
windows, and a check that slots are filled consistently."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.sketch import bitmap, in_bitmap, marked
from tidemark.llm.text import pieces, saved, windows

# Unit words: fixed values.
UNITS = frozenset(
    "mm cm m km in ft yd mi mg g kg lb lbs oz t ml cl l s sec second seconds min minute minutes h hr hour hours day days week weeks "
    "month months year years mph kmh km/h hz khz mhz ghz w kw mw v a j kj cal kcal pa kpa b kb mb gb tb percent % $ € £ usd eur dollar "
    "dollars cent cents euro euros pound pounds meter meters metre metres mile miles inch inches foot feet gram grams kilogram kilograms "
    "liter liters litre litres degree degrees".split()
)
_NUMBER = re.compile(r"[+-]?[$€£]?[0-9](?:[0-9.,:/]*[0-9])?(?:st|nd|rd|th|%|[a-z€£$/]{1,4})?")
_EDGE = "\"'`([{<>)]}.,;:!?#*&|…«»“”„‘’_-"
#: Flags in the low bits of a token's code.
NUMBER, UNIT, TITLE, ENDS, EMPTY = (np.uint64(1 << k) for k in range(5))
FLAGS = np.uint64(31)
#: Sets the hashes of exact windows apart from those of templates.
EXACT = np.uint64(0xA5A5_5A5A_C3C3_3C00)
PLACEHOLDER = {k: np.uint64(xxhash.xxh3_64_intdigest(k.encode()) & ~31) for k in ("<number>", "<unit>", "<name>")}


@dataclass(frozen=True)
class TemplateSpec:
    """``window`` tokens make a template window, at least ``least_literal`` of them no placeholders.

    Windows with fewer literal tokens match by their exact tokens only.  An item is found where
    ``min_share`` of its windows match with consistently filled slots, at one alignment or at alignments that
    inserted and dropped words move by no more than ``drift`` of its windows (8 tokens at least), or where
    ``quote`` of its tokens in a row stand word by word.  An item of fewer tokens than ``window`` is one
    window of its own length; below ``least_literal`` tokens it cannot be told from other text and is never found.
    """

    window: int = 6
    least_literal: int = 4
    min_share: float = 0.3
    drift: float = 0.5
    quote: int = 13
    filter_bits: int = 25


class TokenCodes(dict):
    """Hash of a token without its outer punctuation and case, with its flags; a bounded cache."""

    def __missing__(self, token: str) -> int:
        if len(self) >= 300_000:
            self.clear()
        bare = token.strip(_EDGE)
        low = bare.lower()
        code = xxhash.xxh3_64_intdigest(low.encode()) & ~31
        code |= bool(_NUMBER.fullmatch(low)) * int(NUMBER) | (low in UNITS) * int(UNIT) | (not bare) * int(EMPTY)
        code |= (len(bare) > 1 and bare[0].isupper() and bare[1:].islower()) * int(TITLE)
        code |= (token.rstrip("\"'”’)]*#$%&|")[-1:] in (".", "!", "?", ":", "…")) * int(ENDS)
        self[token] = code
        return code


def canonical(text: str, codes: TokenCodes) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """(template hashes, is a slot, raw tokens) of the tokens with letters or digits.

    Numbers, units after a number and names become typed placeholders.  A name is a title-case
    word that does not open a line or sentence.
    """
    h, _, slot, tokens = _coded(text, codes)
    return h, slot, tokens


def _coded(text: str, codes: TokenCodes) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str]]:
    """:func:`canonical` with the hashes of the tokens themselves in second place."""
    tokens: list[str] = []
    opens: list[int] = []
    for line in text.split("\n"):
        opens.append(len(tokens))
        tokens += line.split()
    if not tokens:
        return np.empty(0, np.uint64), np.empty(0, np.uint64), np.empty(0, bool), tokens
    code = np.fromiter(map(codes.__getitem__, tokens), np.uint64, len(tokens))
    number = (code & NUMBER) > 0
    unit, first = np.zeros(len(code), bool), np.zeros(len(code), bool)
    unit[1:] = ((code[1:] & UNIT) > 0) & number[:-1]
    first[1:] = (code[:-1] & ENDS) > 0
    opens = np.array(opens)
    first[opens[opens < len(code)]] = True
    name = ((code & TITLE) > 0) & ~first & ~number & ~unit
    exact = code & ~FLAGS
    h = exact.copy()
    for where, what in ((number, "<number>"), (unit, "<unit>"), (name, "<name>")):
        h[where] = PLACEHOLDER[what]
    real = (code & EMPTY) == 0
    if not real.all():
        tokens = [t for t, r in zip(tokens, real) if r]
    return h[real], exact[real], (number | unit | name)[real], tokens


def template_windows(text: str, codes: TokenCodes, size: int, least_literal: int):
    """(window hashes, their positions, slot flags, tokens); windows without enough literal tokens have the
    hash of their exact tokens."""
    h, exact, slot, tokens = _coded(text, codes)
    if len(h) < size:
        return np.empty(0, np.uint64), np.empty(0, np.int64), slot, tokens
    found = windows(h, size) ^ np.uint64(size)
    literal = np.concatenate([[0], np.cumsum(~slot)])
    heavy = literal[size:] - literal[:-size] < least_literal
    if size < least_literal:
        found, at = found[~heavy], np.flatnonzero(~heavy)
        return found, at, slot, tokens
    if heavy.any():
        found[heavy] = windows(exact, size)[heavy] ^ EXACT ^ np.uint64(size)
    return found, np.arange(len(found)), slot, tokens


def slot_values(at: int, size: int, slot: np.ndarray, tokens: list[str], least_literal: int) -> list[str]:
    """Values of the slots of a window; none of an exact window, whose tokens are all fixed."""
    if size - int(slot[at : at + size].sum()) < least_literal:
        return []
    return [tokens[k].strip(_EDGE).lower() for k in range(at, at + size) if slot[k]]


def item_windows(items: DataFrame, spec: TemplateSpec, id_col: str, text_col: str) -> DataFrame:
    """(h, item_id, item_at, item_slots, size, template, n_template, n_all) of every window of every item."""
    kind = items.schema[id_col].dataType.simpleString()
    names = ["h", "item_id", "item_at", "item_slots", "size", "template", "n_template", "n_all"]

    def cut(batches):
        codes = TokenCodes()
        for batch in batches:
            rows = []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                size = min(spec.window, len(canonical(text or "", codes)[0]))
                if size:
                    h, at, slot, tokens = template_windows(text, codes, size, spec.least_literal)
                    template = [size - int(slot[a : a + size].sum()) >= spec.least_literal for a in at]
                    rows += [
                        (int(x), item, int(a), slot_values(a, size, slot, tokens, spec.least_literal), size, t, sum(template), len(h))
                        for x, a, t in zip(h.view(np.int64), at, template)
                    ]
            yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], schema=pa.schema([
                ("h", pa.int64()), ("item_id", batch.schema.field(0).type), ("item_at", pa.int64()), ("item_slots", pa.list_(pa.string())), ("size", pa.int32()), ("template", pa.bool_()), ("n_template", pa.int64()), ("n_all", pa.int64())]))

    return items.select(id_col, text_col).mapInArrow(cut, f"h long, item_id {kind}, item_at long, item_slots array<string>, size int, template boolean, n_template long, n_all long")


def find_items(docs: DataFrame, items: DataFrame, spec: TemplateSpec | None = None, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """(``id_col``, item_id, n_windows, matched, share, reparameterised, start): items found in documents.

    One row per document id and item, of the best alignment; ``start`` is the token where it
    begins.  ``reparameterised`` says that a slot is filled differently.  At an alignment with
    contradictory slots (one value of the item met by two of the document) only windows without slots
    count.  A quotation of ``spec.quote`` tokens is given whatever its share.  Null or empty texts and empty tables give no row; rows
    with equal ids (null ids too) are read as one document; other columns are not read.

    Windows of documents that cannot occur in any item are left out before the join by a bitmap
    of fixed size; the join itself is a hash join, whatever the size of ``items``.
    """
    spec = spec or TemplateSpec()
    wanted = saved(item_windows(items, spec, item_col, item_text), "windows")
    sizes = sorted(r.size for r in wanted.select("size").distinct().collect())  # at most ``window`` values
    shared = docs.sparkSession.sparkContext.broadcast(bitmap(wanted.select("h"), spec.filter_bits))
    kind = docs.schema[id_col].dataType.simpleString()

    def scan(batches):
        codes, table = TokenCodes(), shared.value
        for batch in pieces(batches):
            ids, hashes, places, slots = [], [], [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for size in sizes if text else ():
                    h, at, slot, tokens = template_windows(text, codes, size, spec.least_literal)
                    for k in np.flatnonzero(in_bitmap(table, h.view(np.int64))):
                        ids.append(doc)
                        hashes.append(int(h[k].view(np.int64)))
                        places.append(int(at[k]))
                        slots.append(slot_values(at[k], size, slot, tokens, spec.least_literal))
            yield pa.RecordBatch.from_arrays([pa.array(ids, batch.schema.field(0).type), pa.array(hashes, pa.int64()), pa.array(places, pa.int64()), pa.array(slots, pa.list_(pa.string()))], names=["doc", "h", "at", "slots"])

    hits = docs.select(id_col, text_col).mapInArrow(scan, f"doc {kind}, h long, at long, slots array<string>")
    both = hits.join(wanted, "h").withColumn("offset", F.col("at") - F.col("item_at"))
    # each hit counts at its own offset and in two overlapping bands of offsets, one of which holds any drift allowed
    drift = F.greatest(F.lit(8), F.ceil(F.col("n_all") * F.lit(spec.drift))).cast("long")
    bands = [F.floor(F.col("offset") / (2 * drift)), F.floor((F.col("offset") + drift) / (2 * drift))]
    places = F.array(*[F.struct(F.lit(k).alias("kind"), v.cast("long").alias("no")) for k, v in enumerate([F.col("offset"), *bands])])
    both = both.withColumn("place", F.explode(places))
    pairs = F.arrays_zip(F.col("item_slots").alias("i"), F.col("slots").alias("d"))
    lined = both.groupBy("doc", "item_id", "place", "n_template", "n_all").agg(
        F.countDistinct("item_at").alias("all"), F.countDistinct(F.when(F.col("template"), F.col("item_at"))).alias("templates"),
        F.countDistinct(F.when(F.size("slots") == 0, F.col("item_at"))).alias("fixed"),
        F.countDistinct(F.when((F.size("slots") == 0) & F.col("template"), F.col("item_at"))).alias("literal"),
        F.array_distinct(F.flatten(F.collect_set(pairs))).alias("filled"), F.min("at").alias("start"),
        F.sort_array(F.collect_set(F.when((F.col("place.kind") == 0) & (F.col("item_slots") == F.col("slots")), F.col("item_at")))).alias("same"),
        F.max("size").alias("size"),
    )
    agrees = F.size(F.array_distinct(F.transform("filled", lambda p: p["i"]))) == F.size("filled")
    begin = F.struct(F.lit(-2).cast("long").alias("at"), F.lit(0).alias("run"), F.lit(0).alias("most"))

    def longer(state, at):
        run = F.when(at == state["at"] + 1, state["run"] + 1).otherwise(1)
        return F.struct(at.alias("at"), run.alias("run"), F.greatest(state["most"], run).alias("most"))

    run = F.aggregate("same", begin, longer, lambda state: state["most"])
    # of the template windows alone, or of all windows, whichever is more
    def count(got, without_slots, n):
        matched = F.when(agrees, F.col(got)).otherwise(F.col(without_slots))
        return F.struct((matched / F.nullif(F.col(n), F.lit(0))).alias("share"), matched.alias("matched"), F.col(n).alias("n"))

    counted = F.greatest(count("templates", "literal", "n_template"), count("all", "fixed", "n_all"))
    lined = lined.withColumns({
        "counted": counted,
        "reparameterised": agrees & F.exists("filled", lambda p: p["i"] != p["d"]),
        "quoted": (run > 0) & (run + F.col("size") - 1 >= spec.quote),
        "exact": F.col("place.kind") == 0,
    })
    best = lined.groupBy("doc", "item_id").agg(F.max(F.struct("counted", "exact", (-F.col("start")).alias("back"), "reparameterised")).alias("b"), F.max("quoted").alias("quoted"))
    out = best.select(
        F.col("doc").alias(id_col), "item_id", F.col("b.counted.n").alias("n_windows"), F.col("b.counted.matched").alias("matched"),
        F.col("b.counted.share").alias("share"), F.col("b.reparameterised").alias("reparameterised"), (-F.col("b.back")).alias("start"), "quoted",
    )
    return out.where((F.col("share") >= spec.min_share) | F.col("quoted")).drop("quoted")


def drop_contaminated(docs: DataFrame, items: DataFrame, spec: TemplateSpec | None = None, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` in whose text no item is found, with all columns.

    Documents are told apart by a digest of their text here, so null and repeated ids do no harm.
    """
    keyed = docs.withColumn("_digest", F.md5(F.coalesce(F.col(text_col), F.lit("")))).withColumn("_key", F.xxhash64("_digest"))
    found = find_items(keyed, items, spec, "_digest", text_col).select(F.col("_digest").alias("_found")).distinct()
    found = saved(found, "found")
    ids = found.select(F.xxhash64("_found").alias("_key"))
    doubtful = marked(keyed, ids, "_key", True).join(found, F.col("_digest") == F.col("_found"), "left_anti")
    return marked(keyed, ids, "_key", False).unionByName(doubtful).select(*[F.col(f"`{c}`") for c in docs.columns])
