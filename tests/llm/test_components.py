"""Components against union-find on random and long graphs."""

import random

from tidemark.llm.components import components


def direct(pairs):
    top = {}

    def root(x):
        while top.setdefault(x, x) != x:
            x = top[x]
        return x

    for a, b in pairs:
        if a is not None and b is not None and a != b:
            lo, hi = sorted((root(a), root(b)))
            top[hi] = lo
    return {x: root(x) for x in top}


def test_components(spark):
    rng = random.Random(2)
    pairs = [(k, k + 1) for k in range(200)] + [(1000, 1001 + k) for k in range(300)] + [(rng.randrange(3000, 3400), rng.randrange(3000, 3400)) for _ in range(250)]
    pairs += [(5, 5), (None, 7), (8, None), (-4, 2**40), (2**40, -4)] + pairs[:20]
    rng.shuffle(pairs)
    got = components(spark.createDataFrame(pairs, "a long, b long"))
    assert {r.node: r.component for r in got.collect()} == direct(pairs)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
