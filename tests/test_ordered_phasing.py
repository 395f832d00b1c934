"""Phasing of variants one after another by depth."""

import random

from pyspark.sql import functions as F

from weftline.operators import phasing

VARIANTS, READS, SCOPES, BEST = "locus string, variant long, depth double", "path long, node long", "variant long, member long", "variant long, allele string"


def slow_scopes(on: dict[int, set[int]], variants: list[int]) -> dict[int, list[int]]:
    """From all pairs of variants on a read, what each one's largest companion leads to."""
    partner = {}
    for held in on.values():
        for a in held:
            for b in held - {a}:
                partner[a] = max(partner.get(a, b), b)
    out = {}
    for v in variants:
        out[v], at = [v], v
        while at in partner and partner[at] not in out[v]:
            at = partner[at]
            out[v].append(at)
    return out


def slow_walk(variants: list[tuple], scope: dict, best: dict) -> set[tuple]:
    done, haps = {}, {}
    for locus, v, _ in sorted(variants, key=lambda r: (r[2] is None, -(r[2] or 0), r[1])):
        if (locus, v) in done:
            continue
        before = {done[locus, m][1] for m in scope[v] if (locus, m) in done}
        if not before:
            haps[locus] = haps.get(locus, 0) + 1
        for m in [v] if before else scope[v]:
            done[locus, m] = ("ambiguous" if len(before) > 1 else best.get(v, "ambiguous"), min(before) if before else haps[locus])
    return {(locus, v, *got) for (locus, v), got in done.items()}


def frames(spark, variants, scope, best):
    return spark.createDataFrame(variants, VARIANTS), spark.createDataFrame([(v, m) for v, ms in scope.items() for m in ms], SCOPES), spark.createDataFrame(list(best.items()), BEST)


def test_the_order_of_depths_decides(spark):
    reads = spark.createDataFrame([(1, 1), (1, 2), (2, 1), (2, 3), (2, 99), (3, 4)], READS)
    one = spark.createDataFrame([(v,) for v in (1, 2, 3, 4)], "variant long").withColumn("node", F.col("variant"))
    partners = phasing.last_partners(one, reads)
    assert {tuple(r) for r in partners.collect()} == {(1, 3), (2, 1), (3, 1)}
    got = {}
    for r in phasing.scopes(one, partners).collect():
        got.setdefault(r.variant, set()).add(r.member)
    assert got == {1: {1, 3}, 2: {1, 2, 3}, 3: {1, 3}, 4: {4}}
    best = {1: "A", 2: "B", 4: "C"}
    for depths, want in (((9.0, 5.0, 4.0, None), {(1, "A", 1), (3, "A", 1), (2, "B", 1), (4, "C", 2)}), ((5.0, 9.0, 4.0, 20.0), {(1, "B", 2), (2, "B", 2), (3, "B", 2), (4, "C", 1)})):
        rows = [("x", v, depth) for v, depth in zip((1, 2, 3, 4), depths, strict=True)]
        assert {(r.variant, r.allele, r.hap) for r in phasing.phased_in_order(*frames(spark, rows, got, best)).collect()} == want


def test_several_haps_in_a_scope_are_ambiguous(spark):
    scope = {1: [1], 2: [2], 3: [1, 2, 3], 4: [3, 4]}
    rows = [("x", 1, 9.0), ("x", 2, 8.0), ("x", 3, 7.0), ("x", 4, 6.0)]
    got = phasing.phased_in_order(*frames(spark, rows, scope, {1: "A", 2: "B", 3: "A", 4: "D"}))
    assert {tuple(r) for r in got.collect()} == {("x", 1, "A", 1), ("x", 2, "B", 2), ("x", 3, "ambiguous", 1), ("x", 4, "D", 1)}


def test_against_a_slow_walk(spark):
    rng = random.Random(5)
    variants = [(f"l{v // 12}", v, rng.choice([None, 1.0, 2.0, 2.0, 5.0])) for v in range(96)]
    reads = {p: {12 * (p % 8) + rng.randrange(12) for _ in range(rng.randrange(1, 4))} for p in range(70)}
    one = spark.createDataFrame([(v,) for _, v, _ in variants], "variant long").withColumn("node", F.col("variant"))
    rows = spark.createDataFrame([(p, n) for p, held in reads.items() for n in held], READS)
    scope = phasing.scopes(one, phasing.last_partners(one, rows.unionByName(rows)))
    slow = slow_scopes(reads, [v for _, v, _ in variants])
    assert sorted((r.variant, r.member) for r in scope.collect()) == sorted((v, m) for v, ms in slow.items() for m in ms)
    best = {v: rng.choice("ABC") for _, v, _ in variants if v % 7}
    got = phasing.phased_in_order(spark.createDataFrame(variants, VARIANTS), scope, spark.createDataFrame(list(best.items()), BEST))
    assert {tuple(r) for r in got.collect()} == slow_walk(variants, slow, best)


def test_nothing_to_phase(spark):
    none = spark.createDataFrame([], VARIANTS)
    assert phasing.phased_in_order(none, spark.createDataFrame([], SCOPES), spark.createDataFrame([], BEST)).count() == 0
    one = none.select("variant", F.col("variant").alias("node"))
    assert phasing.scopes(one, phasing.last_partners(one, spark.createDataFrame([], READS))).count() == 0
