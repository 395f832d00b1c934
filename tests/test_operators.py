"""Operators that SQL cannot express, sources and streams, on hand-made fixtures."""

import itertools

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from weftline.functions import sequences as S
from weftline.operators import cycles, graph, haplotypes, solve
from weftline.sources import graph_files as files
from weftline.streaming import support


def test_gfa_round_trip(spark, tmp_path):
    text = "H\tVN:Z:1.0\nS\t1\tacgt\tDP:f:2.5\nS\t2\t\nS\t3\tGG\nL\t1\t+\t2\t-\t0M\nP\tp\t1+,3-\t*\nP\tp\t3+\t*\nP\tempty\t\t*\n"
    (tmp_path / "tiny.gfa").write_text(text)
    s, links, steps = files.read_gfa(spark, str(tmp_path / "tiny.gfa"))
    assert {(r.node_id, r.seq, r.depth) for r in s.collect()} == {("1", "ACGT", 2.5), ("2", "", None), ("3", "GG", None)}
    assert [(r.src, r.src_ori, r.dst, r.dst_ori) for r in links.collect()] == [("1", "+", "2", "-")]
    assert {(r.path, r.pos, r.node, r.ori) for r in steps.collect()} == {("p", 0, "1", "+"), ("p", 1, "3", "-"), ("p*", 0, "3", "+")}
    files.write_gfa(s, links, steps, str(tmp_path / "out"))
    _, _, again = files.read_gfa(spark, str(tmp_path / "out"))
    assert {tuple(r) for r in again.collect()} == {tuple(r) for r in steps.collect()}


def test_other_readers(spark, tmp_path):
    (tmp_path / "a.gaf").write_text("r1\t9\t0\t9\t+\t>1<22>3\t9\t0\t9\t9\t9\t60\n")
    assert [(r.node, r.ori) for r in files.read_gaf_paths(spark, str(tmp_path / "a.gaf")).orderBy("pos").collect()] == [("1", "+"), ("22", "-"), ("3", "+")]
    (tmp_path / "a.json").write_text('{"name":"u"}\n{"name":"r","path":{"mapping":[{"position":{"node_id":"5","is_reverse":true},"edit":[{"from_length":4,"to_length":3},{"to_length":2}]}]}}\n')
    assert [tuple(r) for r in files.read_gam(spark, str(tmp_path / "a.json")).collect()] == [("r", 0, "5", "-", 3.0)]
    (tmp_path / "a.fa").write_text(">a x\nAC\nGT\n>b\nTT\n")
    assert {tuple(r) for r in files.read_fasta(spark, str(tmp_path / "a.fa")).collect()} == {("a", "ACGT"), ("b", "TT")}
    (tmp_path / "a.bed").write_text("c1\t5\t9\n")
    assert tuple(files.read_bed(spark, str(tmp_path / "a.bed")).first()) == ("c1", 5, 9)
    (tmp_path / "a.paf").write_text("b\t100\t60\t100\t+\ta\t90\t0\t40\t39\t40\t60\n")
    assert tuple(files.paf_overlaps(files.read_paf(spark, str(tmp_path / "a.paf"))).first())[:3] == ("a", "b", "N")


def test_sequence_functions(spark):
    d = spark.createDataFrame([("acgn", ["1+", "2-"], "r/1"), ("xx", [], "a-b")], "s string, p array<string>, n string")
    r = d.select(S.reverse_complement(F.col("s")).alias("a"), S.reverse_complement(F.col("s"), False).alias("b"), S.flipped(F.col("p")).alias("c"), S.mate_free(F.col("n")).alias("d"), S.reverse_complement(S.reverse_complement(F.col("s"))).alias("e")).collect()
    assert (r[0].a, r[0].c, r[0].d, r[0].e, r[1].a, r[1].b, r[1].d) == ("NCGT", ["2+", "1-"], "r", "ACGN", None, "xx", "a-b")


def test_chains_and_levels(spark):
    e = spark.createDataFrame([(1, 2), (2, 3), (3, 4), (3, 5), (4, 6), (5, 6), (6, 7), (8, 9), (9, 8)], "n1 long, n2 long")
    c = {r.node: (r.head, r.rank) for r in graph.chains(e).collect()}
    assert c[3] == (1, 2) and c[7] == (6, 1) and c[4] == (4, 0) and c[9] == (8, 1) and c[8] == (8, 0)
    levels = {r.node: r.level for r in graph.topological_levels(e).collect()}
    assert levels[1] == 0 and levels[6] == 4 and levels[8] == levels[9] == -1 and graph.has_cycle(e)
    assert {r.component for r in graph.components(e).collect()} == {1, 8}


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 2**32 - 1))
def test_fits_are_not_beaten_by_a_grid(seed):
    r = np.random.default_rng(seed)
    a = (r.random((5, 3)) < 0.6).astype(float)
    x = r.integers(0, 5, 3).astype(float)
    b = a @ x
    for kind in (1, 4, 5):
        got = solve.objective(a, b, solve.fit(a, b, kind), kind)
        assert got <= min(solve.objective(a, b, np.array(g, float), kind) for g in itertools.product(range(5), repeat=3)) + 1e-6
    two = solve.choose(a, b, 2)
    assert (two > 0).sum() <= 2


def test_grouped_fits(spark):
    rows = [("g", p, n, {1: 30.0, 2: 10.0, 3: 40.0}[n]) for p, ns in ((0, (1, 3)), (1, (2, 3))) for n in ns]
    m = spark.createDataFrame(rows, "sample string, path long, node long, abundance double")
    for out in (haplotypes.fitted(m, "sample", 5), haplotypes.chosen(m, "sample", 2)):
        assert {r.path: round(r.abundance, 4) for r in out.collect()} == {0: 30.0, 1: 10.0}
    flows = spark.createDataFrame([("g", 0, 1, 30.0), ("g", 0, 2, 10.0), ("g", 1, 3, 30.0), ("g", 2, 3, 10.0)], "sample string, n1 long, n2 long, flow double")
    assert [(r.nodes, r.abundance) for r in haplotypes.peeled(flows, "sample", 1).orderBy("nth").collect()] == [("0,1,3", 30.0), ("0,2,3", 10.0)]
    ring = spark.createDataFrame([("g", 1, 2), ("g", 2, 3), ("g", 3, 1)], "sample string, n1 long, n2 long")
    assert {(r.n1, r.n2) for r in haplotypes.ranked(ring, "sample").collect()} == {(r.n1, r.n2) for r in cycles.acyclic(ring).collect()} == {(1, 2), (2, 3)}


def test_stream_equals_batch(spark, tmp_path):
    rows = spark.range(100).select((F.col("id") % 7).alias("node"), F.lit(2.0).alias("aligned"))
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    q = support.start(support.node_support(stream), "node_support_t", str(tmp_path / "cp"), "complete")
    q.awaitTermination(60)
    assert {tuple(r) for r in spark.table("node_support_t").collect()} == {tuple(r) for r in support.node_support(rows).collect()}
