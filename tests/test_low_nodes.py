"""Low nodes of paths: replaced, or the path is cut there."""

import random
from collections import Counter

from weftline.operators import abundance, low_nodes, paths

STEPS = "path long, pos int, node long"


def steps(spark, walks: dict[int, list[int]]):
    return spark.createDataFrame([(p, 10 * i, n) for p, walk in walks.items() for i, n in enumerate(walk)], STEPS)


def slow(walks: dict, reads: dict, low: set) -> dict:
    """{(path, piece): [(node, was)]}, walking along each path."""
    hops = {}
    for walk in reads.values():
        for a, b, c in zip(walk, walk[1:], walk[2:]):
            hops.setdefault((a, c), Counter())[b] += 1
    out = {}
    for p, walk in walks.items():
        piece, begun = 0, []
        for i, n in enumerate(walk):
            got = None
            if n not in low:
                got = (n, None)
            elif 0 < i < len(walk) - 1 and walk[i - 1] not in low and walk[i + 1] not in low:
                fit = [(-c, b) for b, c in hops.get((walk[i - 1], walk[i + 1]), {}).items() if b not in low]
                got = (min(fit)[1], n) if fit else None
            if got:
                begun.append(got)
            elif begun:
                out[p, piece] = begun
                piece, begun = piece + 1, []
        if begun:
            out[p, piece] = begun
    return out


def test_fixture(spark):
    reads = steps(spark, {1: [1, 7, 3], 2: [1, 7, 3], 3: [1, 8, 3], 4: [1, 2, 3], 5: [1, 2, 3], 6: [1, 2, 3]})
    low = spark.createDataFrame([(2,), (9,), (2,)], "node long")
    walks = steps(spark, {1: [2, 1, 2, 3, 9, 4, 2, 9, 5, 2], 2: [2, 9], 3: [1, 3]})
    got = sorted((r.path, r.piece, r.node, r.was) for r in low_nodes.replaced(walks, low, abundance.two_hop_support(reads)).collect())
    assert got == [(1, 0, 1, None), (1, 0, 3, None), (1, 0, 7, 2), (1, 1, 4, None), (1, 2, 5, None), (3, 0, 1, None), (3, 0, 3, None)]


def test_against_a_slow_walk(spark):
    rng = random.Random(3)
    walks = {p: [rng.randrange(9) for _ in range(rng.randrange(1, 12))] for p in range(60)}
    reads = {p: [rng.randrange(9) for _ in range(5)] for p in range(80)}
    low = {2, 5, 7}
    found = low_nodes.replaced(steps(spark, walks), spark.createDataFrame([(n,) for n in low], "node long"), abundance.two_hop_support(steps(spark, reads)))
    got = {}
    for r in found.orderBy("pos").collect():
        got.setdefault((r.path, r.piece), []).append((r.node, r.was))
    want = slow(walks, reads, low)
    assert got == want
    left = low_nodes.without_inclusions(found, steps(spark, walks)).select("path", "piece").distinct()
    alone = {(p, i) for (p, i), nodes in want.items() if not any(q != p and {n for n, _ in nodes} <= set(walk) for q, walk in walks.items())}
    assert {tuple(r) for r in left.collect()} == alone


def test_holders(spark):
    rng = random.Random(8)
    walks = {p: [0] + [rng.randrange(1, 12) for _ in range(rng.randrange(6))] for p in range(50)}
    keys = {k: [rng.randrange(14) for _ in range(rng.randrange(1, 4))] for k in range(60)} | {60: [0], 61: [0, 99], 62: [0, None], 63: [None]}
    sets = spark.createDataFrame([(k, n) for k, ns in keys.items() for n in ns], "key long, node long")
    held = steps(spark, walks).unionByName(spark.createDataFrame([(1, 500, None)], STEPS))
    got = sorted((r.key, r.path) for r in paths.holders(sets, held).collect())
    assert got == sorted((k, p) for k, ns in keys.items() for p, walk in walks.items() if set(ns) <= set(walk))
    assert sorted((r.key, r.path) for r in paths.reads_with_all(held, sets).collect()) == got
    assert paths.holders(sets, held.limit(0)).count() == paths.holders(sets.limit(0), held).count() == 0
