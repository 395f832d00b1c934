"""Graphs in many small parts: solved where they lie, or by rounds where they are large; either way as whole graphs are."""

import random

import pytest
from pyspark.sql import functions as F

from weftline.operators import cycles, flow, graph, parts, paths, phasing


@pytest.fixture(scope="module")
def edges(spark):
    r = random.Random(7)
    rows = [(p, p * 100 + r.randrange(k), p * 100 + r.randrange(k)) for p in range(60) for k in (r.randint(2, 9),) for _ in range(r.randint(1, 14))]
    return spark.createDataFrame(rows, "part long, n1 long, n2 long").repartition(3).cache()


@pytest.fixture
def bound(monkeypatch):
    """Some parts are small, others large."""
    monkeypatch.setattr(parts, "SMALL_PART", 6)


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_strong_components_of_parts(edges, bound):
    assert rows(cycles.strong_components(edges, "n1 div 100")) == rows(cycles.strong_components(edges))


def test_levels_of_parts(edges, bound):
    assert rows(graph.topological_levels(edges, "part")) == rows(graph.topological_levels(edges))


def test_components_of_parts(edges, bound):
    assert rows(graph.components(edges, "part")) == rows(graph.components(edges))


def test_acyclic_edges_of_parts(edges, bound):
    assert rows(cycles.acyclic(edges, part="part")) == rows(cycles.acyclic(edges))
    assert rows(cycles.on_cycles(edges, part="part")) == rows(cycles.on_cycles(edges))


def test_chains_of_parts(spark, bound):
    links = [(p * 100 + i, p * 100 + (i + 1) % 8) for p in range(20) for i in range(8 if p % 3 == 0 else 7) if p % 3 != 1 or i != 4]
    e = spark.createDataFrame(links, "n1 long, n2 long")
    assert rows(graph.linked_chains(e, "n1 div 100")) == rows(graph.linked_chains(e))


def test_first_choice_of_parts(spark, edges, bound):
    nodes = edges.select(F.explode(F.array("n1", "n2")).alias("node")).union(spark.createDataFrame([(99999,)], "node long")).distinct()
    rank = nodes.select("node", F.struct((F.col("node") % 7).alias("a"), "node").alias("rank"), F.expr("node div 100").alias("part"))
    assert rows(graph.first_choice(rank, edges, "part")) == rows(graph.first_choice(rank, edges))


def test_extremities_of_parts(edges, bound):
    nodes = edges.select(F.explode(F.array("n1", "n2")).alias("node")).distinct()
    length = nodes.where("node % 11 > 0").select("node", (F.col("node") % 5 + 1).alias("len"))  # some are unknown
    assert rows(flow.extremities(edges, length, 8, "part")) == rows(flow.extremities(edges, length, 8))


def test_parts_over_many_batches_and_words_as_nodes(spark, bound):
    """A part that goes on over batches is whole, and one in several of them comes once."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    try:
        e = spark.createDataFrame([(f"{p}", f"{p}-{i}", f"{p}-{i + 1}") for p in range(9) for i in range(1 + 3 * (p % 5))], "part string, n1 string, n2 string")
        assert rows(graph.components(e, "part")) == rows(graph.components(e))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_jobs_do_not_grow_with_the_way(spark):
    """Rounds of joins took jobs for every node of a way."""
    def jobs(n):
        e = spark.createDataFrame([(i, i + 1) for i in range(n)], "n1 long, n2 long")
        spark.sparkContext.setJobGroup(f"way{n}", "")
        graph.topological_levels(e, "n1 div 1000").collect()
        cycles.strong_components(e, "n1 div 1000").collect()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"way{n}"))

    assert jobs(40) == jobs(3)


def test_scopes_of_parts(spark, bound):
    r = random.Random(3)
    to = {}
    for p in range(12):
        for v in range(1, r.randint(3, 12)):
            to[p * 100 + v] = p * 100 + max(v + 1 if v % 4 else v - 1, 1)
    partners = spark.createDataFrame([(v, m) for v, m in to.items() if v != m], "variant long, partner long")
    variants = partners.select(F.explode(F.array("variant", "partner")).alias("variant")).distinct()
    assert rows(phasing.scopes(variants, partners, "variant div 100")) == rows(phasing.scopes(variants, partners))


def test_paths_are_sorted_once_to_be_trimmed(spark):
    """Windows of both orders held a task's paths in several sorts at a time."""
    s = spark.createDataFrame([(1, 2, 5, "+"), (1, 1, 6, "-"), (1, 3, 7, "+")], "path long, pos int, node long, ori string")
    out = paths.trimmed(s, spark.createDataFrame([(5, 9), (6, 2), (7, None)], "node long, len long"), 3)
    assert rows(out) == [(1, 2, 5, "+")]
    windows = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert windows.count("Sort [path") == 1
