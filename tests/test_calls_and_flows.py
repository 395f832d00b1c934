"""Variants, phasing, cleaning and flows on hand-made rows, and what SQL does not say against slow versions."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from weftline.functions import sequences as S
from weftline.operators import cleaning, flow, graph, haplotypes, paths, phasing, solve, variants

STEP = "path string, pos int, node long, ori string"


def _steps(spark, rows):
    return spark.createDataFrame([(p, i, abs(n), "+" if n > 0 else "-") for p, x in rows.items() for i, n in enumerate(x, 1)], STEP)


def test_flanks_support_report_and_pruning(spark):
    alleles = _steps(spark, {"A1": [1, 2, 3, 4], "A2": [1, 5, 3, 4]})
    reads = _steps(spark, {"r1": [1, 9, 3], "r2": [-3, -9, -1], "r3": [2, 9, 3], "r4": [3, 8], "r5": [3, 8], "r6": [7, 6, 4], "r7": [4, 6, 7]})
    links = spark.createDataFrame([(1, 9), (9, 3), (2, 9), (3, 8), (7, 6), (6, 4)], "n1 long, n2 long")
    novel = spark.createDataFrame([(9,), (8,), (6,)], "node long")
    placed = variants.flanks(novel, links, reads, alleles)
    got = {r.node: (r.left, r.right, r.ori, r.tricky) for r in placed.collect()}
    assert got[9] == (None, None, "+", True) and got[8] == (None, None, "+", True)  # three allele nodes beside it; one neighbour
    assert got[6] == (4, 7, "+", False)  # as many reads one way as the other: the smaller first
    two = variants.flanks(novel, links.where("n1 <> 2"), reads.where("path <> 'r3'"), alleles)
    assert {r.node: (r.left, r.right, r.ori) for r in two.collect()}[9] == (1, 3, "+")
    assert {r.node: r.reads for r in variants.support(two, reads).collect()} == {9: 2, 6: 2}
    seg = spark.createDataFrame([(n, "ACGT"[n % 4] * n) for n in range(1, 10)], "node long, seq string")
    rep = {r.node: r for r in variants.report(two, seg, reads, alleles).collect()}
    assert (rep[9].reads, rep[9].length, rep[9].overlap, rep[9].novel, rep[9].seq) == (2, 9, 0, True, "C" + "C" * 9 + "TTT")
    weak = two.where("node = 9")
    kept, edges = variants.pruned(reads.unionByName(alleles), links, weak, alleles.select("path").distinct())
    assert {r.path for r in kept.select("path").distinct().collect()} == {"A1", "A2", "r4", "r5", "r6", "r7"}
    assert {(r.n1, r.n2) for r in edges.collect()} == {(2, 9), (3, 8), (7, 6), (6, 4)}
    kept, edges = variants.pruned(reads.unionByName(alleles), links, weak, spark.createDataFrame([("r1",)], "path string"))
    assert {"r1"} == {r.path for r in kept.where("node = 9").select("path").distinct().collect()} and edges.count() == 6
    rules = {r.depth: (r.prune, r.phase, r.phase_deletion) for r in variants.pruning_depths(spark.createDataFrame([(x,) for x in (0.0, 0.5, 1.0, 2.0, 2.5, 3.0)], "depth double")).collect()}
    assert rules == {0.0: (True, True, True), 0.5: (False, True, True), 1.0: (True, False, False), 2.0: (True, False, False), 2.5: (False, False, True), 3.0: (False, True, True)}


def test_phasing_fixture(spark):
    """Reads that link two variants, a tie, and a variant whose flanks match no allele."""
    members = spark.createDataFrame([(a, n) for a, x in {"A": [1, 2, 3, 5], "B": [1, 4, 3, 5], "C": [1, 2, 6]}.items() for n in x], "allele string, node long")
    assert {(r.allele, r.node) for r in phasing.specific_nodes(members).collect()} == {("B", 4), ("C", 6)}
    pairs = {(r.allele, r.a, r.b) for r in phasing.specific_pairs(members).collect()}
    assert pairs == {("A", 2, 3), ("A", 2, 5), ("B", 1, 4), ("B", 3, 4), ("B", 4, 5), ("C", 1, 6), ("C", 2, 6)}
    reads = spark.createDataFrame([(p, n) for p, x in {"r1": [21, 22, 4], "r2": [22, 23], "r3": [24, 2, 3], "r4": [24, 6], "r5": [25]}.items() for n in x], "path string, node long")
    v = spark.createDataFrame([(n, n) for n in (21, 22, 23, 24, 25)], "variant long, node long")
    linked = {r.variant: r.linked for r in phasing.linked(v, reads).collect()}
    assert linked == {21: 21, 22: 21, 23: 21, 24: 24, 25: 25}
    group = spark.createDataFrame([(g, n) for n, g in linked.items()], "group long, node long")
    support = phasing.read_support(reads, group, phasing.specific_nodes(members), phasing.specific_pairs(members))
    assert {(r.group, r.allele): r.reads for r in support.collect()} == {(21, "B"): 1, (24, "A"): 1, (24, "C"): 1}
    need = spark.createDataFrame([(21, 1), (21, 3), (24, 2), (24, 9), (25, 4)], "group long, node long")
    got = {(r.group, r.allele, r.how) for r in phasing.candidates(need, members, support).collect()}
    assert got == {(21, "B", "refined"), (24, "A", "reads"), (24, "C", "reads"), (25, "B", "flanks")}
    backed = phasing.read_backing(reads, group, phasing.specific_nodes(members), phasing.specific_pairs(members))
    assert {tuple(r) for r in backed.collect()} == {(21, "B"), (24, "A"), (24, "C")}
    more = members.unionByName(spark.createDataFrame([("B", 7), ("C", 8)], "allele string, node long"))  # B has 4 and 7 to itself, and no read both
    backed = phasing.read_backing(reads, group, phasing.specific_nodes(more), phasing.specific_pairs(more))
    assert {tuple(r) for r in backed.collect()} == {(24, "A")}
    any_node = phasing.read_support(reads, group, phasing.specific_nodes(more), phasing.specific_pairs(more))
    assert {(r.group, r.allele) for r in any_node.collect()} == {(21, "B"), (24, "A"), (24, "C")}
    wide = spark.createDataFrame([(21, 1), (21, 3), (21, 6), (24, 2)], "group long, node long")  # B has two thirds of these
    got = {(r.group, r.allele, r.how) for r in phasing.candidates(need, members, support, wide=wide).collect()}
    assert got == {(24, "A", "reads"), (24, "C", "reads"), (25, "B", "flanks")}
    rows = spark.createDataFrame([("A", "v1", 13.3, 10.0, 4), ("A", "v2", 6.7, 10.0, 3), ("B", "v3", 13.4, 10.0, 1), ("B", "v4", 10.0, 10.0, 2), ("C", "v5", 1.0, 10.0, 7)], "allele string, variant string, depth double, allele_depth double, hap int")
    assert {(r.allele, r.variant, r.hap) for r in phasing.merged_variants(rows).collect()} == {("A", "v1", 3), ("A", "v2", 3), ("ambiguous", "v3", 1), ("ambiguous", "v4", 2), ("C", "v5", 7)}
    assert {r.name for r in phasing.exact_alleles(members, support).collect()} == {"A", "B", "C"}
    assert {r.name for r in phasing.exact_alleles(members, support.limit(0)).collect()} == {"exact_A", "exact_B", "exact_C"}
    x = spark.createDataFrame([([1, 2, 3, 4],)], "x array<bigint>")
    lit = lambda *n: F.array(*map(F.lit, n)).cast("array<bigint>")
    for left, right, inner, nodes, how in ((1, 3, lit(9), [1, 9, 3, 4], "replaced"), (1, 2, lit(9, 8), [1, 9, 8, 2, 3, 4], "inserted"), (1, 4, lit(), [1, 4], "deleted"), (4, 2, lit(9, 8), [1, 2, 8, 9, 4], "reversed"), (1, 7, lit(9), [1, 2, 3, 4], "unsupported_tip")):
        r = x.select(phasing.interpolated(F.col("x"), F.lit(left).cast("long"), F.lit(right).cast("long"), inner).alias("r")).first().r
        assert (r.nodes, r.how) == (nodes, how)


def test_call_sequences_and_depths(spark):
    calls = spark.createDataFrame([("G1", "01", "0x"), ("G1", "02", "5x"), ("G2", "01", "0x"), (None, None, None)], "gene string, allele string, shown string")
    alleles = spark.createDataFrame([("G1*01:variant_2", "NOVEL"), ("G1*01:exact_1", "EXACT"), ("G1*02:ambiguous_exact", "AMB"), ("G2*01:ambiguous_variant", "NO"), ("G2*01:other", "NO")], "name string, seq string")
    assert {(r.gene, r.allele): r.fasta for r in cleaning.with_sequences(calls, alleles).collect()} == {("G1", "01"): "EXACT", ("G1", "02"): "AMB", ("G2", "01"): "", (None, None): ""}
    depth = spark.createDataFrame([("G1", 10.0, 1.0), ("G3", 2.345, None)], "gene string, mean double, sd double")
    assert {(r.gene, r.allele): r.shown for r in cleaning.zero_coverage(calls, depth).collect()} == {("G1", "01"): "10x", ("G1", "02"): "5x", ("G2", "01"): "0x", (None, None): None}
    haps = spark.createDataFrame([(1, "g", "ACGT"), (2, "g", "ACGA"), (3, "h", "AC")], "id long, g string, seq string")
    contigs = spark.createDataFrame([("x", "g", "ACGT"), ("y", "g", "ACGT"), ("z", "g", "TCGA")], "name string, g string, cseq string")
    named = {r.id: (r.name, r.how) for r in cleaning.named(haps, contigs, S.hamming(F.col("seq"), F.col("cseq")), "g").collect()}
    assert named == {1: ("x or y", "exact"), 2: ("x or y or z_HammingDistBased", "nearest")}
    a = spark.createDataFrame([("A*01",), ("B/OR*01",)], "allele string")
    assert [r.allele for r in cleaning.in_catalogue(a, a.limit(0), "^B").collect()] == ["B/OR*01"]
    assert [r.allele for r in cleaning.in_catalogue(a, a.where("allele = 'A*01'"), "^B").collect()] == ["A*01"]


def test_merged_haplotypes_equal_a_slow_fold(spark):
    r = random.Random(3)
    rows = [(g, i, "".join(r.choices("AC", k=r.randint(1, 7))), float(r.randint(1, 9))) for g in range(12) for i in range(9)]
    want = []
    for g in range(12):
        x = [list(t) for t in rows if t[0] == g]
        gone = set()
        for i, j in itertools.combinations(range(len(x)), 2):
            if x[i][2] in x[j][2]:
                gone.add(i)
                x[j][3] += x[i][3]
            elif x[j][2] in x[i][2]:
                gone.add(j)
                x[i][3] += x[j][3]
        want += [tuple(t) for k, t in enumerate(x) if k not in gone]
    got = cleaning.merged_haplotypes(spark.createDataFrame(rows, "g long, id long, seq string, abundance double").repartition(3), "g")
    assert sorted(map(tuple, got.collect())) == sorted(want)


def _lcs(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            t[i + 1][j + 1] = max(t[i][j + 1], t[i + 1][j], t[i][j] + (x == y))
    return t[-1][-1]


def test_sequence_functions(spark):
    r = random.Random(4)
    rows = [("".join(r.choices("ACGT", k=r.randint(0, 12))), "".join(r.choices("ACGT", k=r.randint(0, 12)))) for _ in range(200)] + [(None, "A"), ("", "")]
    d = spark.createDataFrame(rows, "a string, b string").select("a", "b", S.common_subsequence(F.col("a"), F.col("b")).alias("n"), S.kmers(F.col("a"), 3).alias("k"))
    for x in d.collect():
        assert x.n == (None if x.a is None else _lcs(x.a, x.b)) and (x.a is None or x.k == [x.a[i : i + 3] for i in range(len(x.a) - 2)])
    e = spark.createDataFrame([(0, n) for n in range(1, 8)] + [(1, 2), (2, 2)], "n1 long, n2 long")
    seq = {n: "".join(r.choices("AC", k=r.randint(1, 8))) for n in range(8)}
    got = {(x.a, x.b): x.score for x in graph.parallel_nodes(e, spark.createDataFrame(list(seq.items()), "node long, seq string")).collect()}
    assert got == {(a, b): _lcs(seq[a], seq[b]) for a, b in itertools.combinations(range(1, 8), 2) if 2 * _lcs(seq[a], seq[b]) > max(len(seq[a]), len(seq[b]))}


def _acyclic(edges):
    left = set(edges)
    while free := {u for u, _ in left} - {v for _, v in left}:
        left = {e for e in left if e[0] not in free}
    return not left


def test_cycle_modes(spark):
    rows = [(1, u, v) for u, v in ((1, 2), (2, 3), (3, 4), (4, 2), (4, 5))] + [(2, 1, 2), (2, 2, 3)]
    d = spark.createDataFrame(rows, "g long, n1 long, n2 long")
    plain = {(r.g, r.n1, r.n2) for r in haplotypes.without_cycles(d, "g").collect()}
    assert plain == {(1, 1, 2), (2, 1, 2), (2, 2, 3)} | {(1, 2, 3)}
    careful = {(r.g, r.n1, r.n2) for r in haplotypes.without_cycles(d, "g", careful=True).collect()}
    assert careful == {(1, 3, 4), (2, 1, 2), (2, 2, 3)}
    r = random.Random(5)
    many = [(g, *e) for g in range(20) for e in {(r.randrange(8), r.randrange(8)) for _ in range(14)} if e[0] != e[1]]
    for mode in (False, True):
        left = haplotypes.without_cycles(spark.createDataFrame(many, "g long, n1 long, n2 long"), "g", careful=mode).collect()
        assert {(x.g, x.n1, x.n2) for x in left} <= set(many)
        assert mode or all(_acyclic([(x.n1, x.n2) for x in left if x.g == g]) for g in range(20))


@pytest.mark.parametrize("kind", [1, 2, 3, 4, 5, 6, 7])
def test_fits_reach_the_optimum(kind):
    """Against all supports of up to the number of paths, each solved on its own rows by a fine search of vertices or squares."""
    r = np.random.default_rng(kind)
    for _ in range(12):
        a = (r.random((7, 3)) < 0.6).astype(float)
        a[0] = 1
        b = np.round(a @ r.integers(0, 20, 3) + r.normal(0, 1.5, 7).clip(-3, 3), 1).clip(0.1)
        got = solve.objective(a, b, solve.fit(a, b, kind), kind)
        if kind in (4, 5, 7):
            scale = 1 / np.sqrt(b) if kind == 5 else np.ones(7)
            tries = []
            for s in itertools.product((0, 1), repeat=3):
                x, cols = np.zeros(3), [j for j in range(3) if s[j]]
                if cols:
                    x[cols] = solve.nnls(a[:, cols] * scale[:, None], b * scale)
                tries.append(solve.objective(a, b, x, kind))
        else:
            tries = [solve.objective(a, b, np.zeros(3), kind)]
            lines = [(a[i], b[i]) for i in range(7)] + [(np.eye(3)[j], 0.0) for j in range(3)]
            for some in itertools.combinations(lines, 3):
                m = np.array([x for x, _ in some])
                if abs(np.linalg.det(m)) > 1e-9:
                    x = np.linalg.solve(m, [y for _, y in some])
                    if (x >= -1e-9).all():
                        x[x < 1e-9] = 0
                        tries.append(solve.objective(a, b, x, kind))
        assert got <= min(tries) * 1.0001 + 1e-6, (kind, got, min(tries))


def test_two_alleles_have_objective_0(spark):
    rows = [(1, "A", n, 30.0 if n < 3 else 40.0) for n in (1, 2, 5)] + [(1, "B", n, 10.0 if n in (3, 4) else 40.0) for n in (3, 4, 5)]
    for kind in range(1, 6):
        got = {r.path: round(r.abundance, 3) for r in haplotypes.fitted(spark.createDataFrame(rows, "g long, path string, node long, abundance double"), "g", kind=kind).collect()}
        assert got == {"A": 30.0, "B": 10.0}
    edges = spark.createDataFrame([(1, 0, 2), (1, 2, 3), (1, 3, 1), (1, 0, 4), (1, 4, 5), (1, 5, 1)], "g long, src long, dst long")
    nodes = spark.createDataFrame([(1, n, b, s, t, 1) for n, b, arcs in ((1, 30.0, [(2, 3)]), (3, 10.0, [(4, 5)]), (5, 40.0, [(2, 3), (4, 5)])) for s, t in arcs], "g long, node long, abundance double, src long, dst long, weight int")
    flows = {(r.src, r.dst): round(r.value, 6) for r in haplotypes.flow_solved(nodes, edges, "g").collect() if r.kind == "flow"}
    assert flows == {(0, 2): 30.0, (2, 3): 30.0, (3, 1): 30.0, (0, 4): 10.0, (4, 5): 10.0, (5, 1): 10.0}
    depth = spark.createDataFrame([(1, 40.0)], "g long, depth double")
    steps = haplotypes.ladder(spark.createDataFrame(rows, "g long, path string, node long, abundance double"), depth, "g").collect()
    assert {(r.path, round(r.abundance), r.round) for r in steps} == {("A", 30, 2), ("B", 10, 2)}


def test_overlaps_orientation_and_joined_paths(spark):
    steps = _steps(spark, {"1": [1, 2, 3], "2": [2, 3, 4], "3": [-5, -4, -3], "4": [9, 3, 4]}).withColumn("path", F.col("path").cast("long"))
    proposed = spark.createDataFrame([(1, 2, "+"), (2, 3, "-"), (1, 4, "+"), (4, 1, "+")], "c1 long, c2 long, way string")
    got = {(r.c1, r.c2): (r.start, r.ori) for r in flow.overlaps(steps, proposed).collect()}
    assert got == {(1, 2): (1, "++"), (2, 3): (1, "+-")}
    low = spark.createDataFrame([(9,), (2,)], "node long")
    assert {(r.c1, r.c2): r.start for r in flow.overlaps(steps, proposed, low).collect()}[1, 4] == 1
    o = spark.createDataFrame([(1, 2, 1, "++"), (3, 2, 2, "-+"), (1, 4, 1, "+-"), (4, 2, 0, "++")], "c1 long, c2 long, start int, ori string")
    n = spark.createDataFrame([(c, 3) for c in (1, 2, 3, 4)], "path long, n int")
    assert {(r.c1, r.c2): (r.start, r.ori) for r in flow.oriented(o.where("c1 <> 4"), n).collect()} == {(1, 2): (1, "++"), (3, 2): (2, "-+"), (1, 4): (1, "+-")}
    p = spark.createDataFrame([("h", 0, 1), ("h", 1, 2), ("h", 2, 3)], "path string, nth int, contig long")
    over = spark.createDataFrame([(1, 2, 1, "++"), (2, 3, 1, "+-")], "c1 long, c2 long, start int, ori string")
    joined = flow.joined_steps(p, over, steps).orderBy("pos").collect()
    assert [(r.node, r.ori) for r in joined] == [(1, "+"), (2, "+"), (3, "+"), (4, "+"), (5, "+")]


def test_chains_join_turned_sequences(spark):
    e = spark.createDataFrame([(1, "+", 2, "-"), (2, "-", 3, "+"), (3, "+", 4, "+"), (3, "+", 5, "+"), (6, "+", 7, "+"), (7, "+", 6, "+"), (8, "+", 8, "+")], "n1 long, o1 string, n2 long, o2 string")
    seg = spark.createDataFrame([(n, len(s), s) for n, s in ((1, "AA"), (2, "AC"), (3, "G"), (4, "T"), (5, "C"), (6, "A"), (7, "C"), (8, "G"))], "node long, len int, seq string")
    ab = spark.createDataFrame([(1, 1.0), (2, 3.0), (3, 5.0)], "node long, abundance double")
    got = {r.head: (r.nodes, r.seq, r.paths) for r in graph.merged_chains(e, seg, ab, _steps(spark, {"p": [1, 2], "q": [3]})).collect()}
    assert got == {1: (3, "AAGTG", 2), 4: (1, "T", 0), 5: (1, "C", 0), 6: (2, "AC", 0), 8: (1, "G", 0)}


def test_levels_deeper_than_any_bound(spark):
    e = spark.createDataFrame([(i, i + 1) for i in range(230)], "n1 long, n2 long").coalesce(1)
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        assert graph.topological_levels(e).agg(F.max("level")).first()[0] == 230
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert {r.node: r.number for r in paths.densely_numbered(spark.createDataFrame([(x,) for x in (5, 9, 5, -2, 10**12)], "v long").withColumnRenamed("v", "node"), "node").collect()} == {-2: 0, 5: 1, 9: 2, 10**12: 3}
