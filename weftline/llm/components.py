"""Connected components by alternating star contraction, on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, written

ROUNDS = 60


def _large_star(e: DataFrame) -> DataFrame:
    """Each node hands its larger neighbours to the smallest node it knows."""
    both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(e: DataFrame) -> DataFrame:
    """Each node hands its smaller neighbours, and itself, to the smallest of them; edges are (larger a, smaller b)."""
    low = e.groupBy("a").agg(F.min("b").alias("m"))
    kept = e.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return kept.unionByName(low.select("a", F.col("m").alias("b"))).where("a <> b").distinct()


def _state(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) of every node of the edges (a, b), longs; component is the smallest node reachable.

    Edges with a null end, loops and repeated edges change nothing.  Every round is written to the shared folder, so
    the plan stays short and a lost executor costs one round; hubs are pre-aggregated and joined, never gathered.
    """
    e = edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where(f"{a} is not null and {b} is not null and {a} <> {b}").distinct()
    e = written(e, "edges")
    before = _state(e)
    for _ in range(ROUNDS):
        if not before[0]:
            break
        after = written(_small_star(_large_star(e)), "edges")
        discard(e)
        e, now = after, _state(after)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {ROUNDS} rounds")
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
