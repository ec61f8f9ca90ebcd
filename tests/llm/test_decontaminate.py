"""Template windows: given leaks against plain matching, re-parameterised items, slots, odd rows."""

import re

from tidemark.llm.decontaminate import TokenCodes, canonical, drop_contaminated, find_items

ITEM = "A train leaves Boston at 60 km per hour. How many hours does Alice need for the 120 km to the coast if Boston is behind her?"


def run(spark, texts, items=(ITEM,)):
    docs = spark.createDataFrame([(k, t, "x") for k, t in enumerate(texts)], "doc_id long, text string, item_id string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    return docs, bench, {r.doc_id: r for r in find_items(docs, bench).collect()}


def test_given_leaks(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    bench = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    words = lambda t: re.findall(r"[^\W_]+", t.lower())
    items = {r.item_id: " ".join(words(r.text)) for r in bench.collect()}
    want = {(r.doc_id, i) for r in docs.collect() for i, t in items.items() if f" {t} " in f" {' '.join(words(r.text))} "}
    got = {(r.doc_id, r.item_id) for r in find_items(docs, bench).collect()}
    assert want and want <= got
    eight = {i: {tuple(w[k : k + 6]) for k in range(len(w) - 5)} for i, w in ((i, t.split()) for i, t in items.items())}
    texts = {r.doc_id: r.text for r in docs.collect()}
    for d, i in got - want:  # the rest share many windows literally: near copies of leaks
        w = words(texts[d])
        assert len(eight[i] & {tuple(w[k : k + 6]) for k in range(len(w) - 5)}) >= 0.25 * len(eight[i])


def test_slots(spark):
    same = ITEM.replace("Boston", "Paris").replace("60", "75").replace("120", "225").replace("Alice", "Bob")
    torn = ITEM.replace("Boston at 60", "Paris at 75").replace("120", "75").replace("Alice", "Bob")
    docs, bench, found = run(spark, [f"Some text here.\n{same} And more.", torn, ITEM.upper().replace("TRAIN", "train"), ITEM, "Trains go everywhere in 60 km."])
    assert found[0].reparameterised and found[0].share == 1.0 and found[0].start == 3
    assert not found[3].reparameterised and found[3].share == 1.0
    assert 1 not in found or found[1].share < 0.6  # Boston -> Paris and Boston; 60 and 120 -> 75
    assert 4 not in found
    assert {r.doc_id for r in drop_contaminated(docs, bench).collect()} >= {4} and drop_contaminated(docs, bench).columns == docs.columns


def test_placeholders():
    codes = TokenCodes()
    h, slot, tokens = canonical("The 5 km way of Anna. Bert took 5km, or 7.5 kg.", codes)
    assert [t for t, s in zip(tokens, slot) if s] == ["5", "km", "Anna.", "5km,", "7.5", "kg."]
    assert h[1] == h[8] == h[10] and h[2] == h[11]


def test_odd_rows(spark):
    rows = [(1, None), (None, ITEM), (2, ""), (3, ITEM), (3, ITEM), (4, "word " * 30000 + ITEM), (5, "--- !!! ...")]
    docs = spark.createDataFrame([(i, t, "q") for i, t in rows], "doc_id long, text string, share string")
    bench = spark.createDataFrame([(0, ITEM), (1, None), (2, ""), (3, "too few"), (4, "seven words make one window here"), (None, ITEM)], "item_id long, text string")
    got = sorted(((r.doc_id, r.item_id) for r in find_items(docs, bench).collect()), key=str)
    assert got == sorted([(d, i) for d in (None, 3, 4) for i in (0, None)], key=str)
    assert sorted((r.doc_id for r in drop_contaminated(docs, bench).collect()), key=str) == [1, 2, 5]
    assert find_items(docs, bench.where("item_id > 99")).count() == 0
    assert drop_contaminated(docs.where("doc_id > 99"), bench).count() == 0


def test_edited_quoted_and_slot_heavy_items(spark):
    long = " ".join(f"word{k}" for k in range(60))
    heavy = "Convert 3 km 200 m and 5 km 40 m to 7 km 90 m now"
    words = long.split()
    more = " ".join(w + (" extra" if k in (12, 24, 36, 48) else "") for k, w in enumerate(words, 1))
    less = " ".join(w for k, w in enumerate(words) if k not in (11, 23, 35, 47))
    texts = [f"Before it {more} after it", f"Before it {less} after it", "some prose " + " ".join(words[20:34]) + " other prose", "some prose " + " ".join(words[20:30]) + " other prose", f"so {heavy} please", "Convert 4 km 300 m and 6 km 50 m"]
    _, _, found = run(spark, texts, (long, heavy))
    assert set(found) == {0, 1, 2, 4}
    assert (found[0].matched, found[0].n_windows, found[2].matched) == (35, 55, 9) and found[1].matched > 25
    assert found[4].item_id == 1 and found[4].share == 1.0
    one = "In May Alice paid 5 euros for the red book and 7 euros for the blue book on the shelf"
    _, _, found = run(spark, [one.replace("7", "5")], (one,))
    assert found[0].share == 1.0 and found[0].reparameterised  # two values of the item may meet one of the document
