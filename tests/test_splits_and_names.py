"""Graphs by contig and combined, nodes of elsewhere, reduced names."""

from pyspark.sql import functions as F

from weftline.functions import sequences
from weftline.operators import calls, cleaning, paths


def test_two_digits(spark):
    want = {"A*01:01:01": "A*01:01", "A*01:010": "A*01:01", "A*01:1": "A*01:1", "A*0123": "A*0123", "B#0*02:03:04": "B*02:03", "A*01:011#0": "A*01:01", "": ""}
    got = spark.createDataFrame([(a,) for a in want], "a string").select("a", sequences.two_digits(F.col("a")).alias("k")).collect()
    assert {r.a: r.k for r in got} == want
    rows = spark.createDataFrame([("A*01:01:02", 1), ("A*01:01:01", 2), ("A*01:013", 3), ("B*01:01", 4), (None, 5)], "allele string, n int")
    assert {(r.allele, r.n, r.key) for r in cleaning.reduced(rows).collect()} == {("A*01:013", 3, "A*01:01"), ("B*01:01", 4, "B*01:01"), (None, 5, None)}


def test_filtering_nodes(spark):
    rows = [
        ("hit", "G*1", 1, True), ("hit", "H*1", 1, False), ("hit", "H*1", 2, False), ("hit", "X/OR", 3, None),
        ("none", "H*1", 1, False), ("none", "X/OR", 1, False), ("none", "X/OR", 4, False), ("none", "H*2", 5, False),
        ("only", "X/OR", 1, False), ("only", "Y/OR", 2, None), ("plain", "H*1", 1, False),
    ]
    m = spark.createDataFrame(rows + rows, "gene string, allele string, node long, target boolean")
    assert sorted(tuple(r) for r in calls.filtering_nodes(m, "gene").collect()) == [("hit", 2), ("hit", 3), ("none", 1), ("none", 4)]
    assert calls.filtering_nodes(m.limit(0), "gene").count() == 0


def test_graphs_by_contig_come_together_again(spark):
    seqs = spark.createDataFrame([("a", "AC"), ("b", "AC"), ("c", "AC"), ("d", "GG"), ("e", None), ("nowhere", "T")], "name string, seq string")
    hits = spark.createDataFrame([("a", "c2", 5), ("a", "c1", 9), ("b", "c1", 3), ("c", "c2", 1), ("d", "c1", 1), ("d", "c2", 1), ("e", "c2", 1)], "q string, t string, matches int")
    got = {tuple(r) for r in cleaning.split_by_contig(seqs, cleaning.best_contig(hits)).collect()}
    assert got == {("c1", "a", "AC"), ("c2", "c", "AC"), ("c1", "d", "GG"), ("c2", "e", None)}
    segments = spark.createDataFrame([("c2", 7, "A"), ("c1", 9, "C"), ("c1", 7, "G"), ("c3", 1, "T")], "graph string, node long, seq string")
    steps = spark.createDataFrame([("c1", "p", 1, 9, "+"), ("c1", "p", 2, 7, "-"), ("c2", "p", 1, 7, "+")], "graph string, path string, pos int, node long, ori string")
    whole, walked = paths.combined(segments, steps)
    assert {(r.node, r.seq) for r in whole.collect()} == {(1, "G"), (2, "C"), (3, "A"), (4, "T")}
    assert {tuple(r) for r in walked.collect()} == {("p#0", 1, 2, "+"), ("p#0", 2, 1, "-"), ("p#1", 1, 3, "+")}
    spelled = {r.path: r.seq for r in paths.spelled(walked, whole).collect()}
    assert spelled == {"p#0": "CC", "p#1": "A"}
