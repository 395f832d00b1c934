"""Low nodes of paths: replaced by what reads have in their place, or the path is cut there."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .paths import holders


def alternatives(hops: DataFrame, low: DataFrame) -> DataFrame:
    """(n0, n2, instead, n): of the nodes that two-hop support (n0, n1, n2, n) puts between two others, the one most often seen that is not
    low (node); ties to the smallest."""
    fit = hops.join(low.select(F.col("node").alias("n1")).distinct(), "n1", "left_anti")
    best = fit.groupBy("n0", "n2").agg(F.min(F.struct((-F.col("n")).alias("less"), "n1")).alias("b"))
    return best.select("n0", "n2", F.col("b.n1").alias("instead"), (-F.col("b.less")).alias("n"))


def replaced(steps: DataFrame, low: DataFrame, hops: DataFrame) -> DataFrame:
    """(path, piece, pos, node, was): steps without low nodes (node).

    A low node between two others that are not low gives way to their alternative of the two-hop support; was holds it, null
    elsewhere.  Without one, or beside another low node, the path is cut there; at its ends low nodes just go.  Pieces are
    numbered from 0 along a path.  What becomes of a step depends on its neighbours alone, so no walk along the path is needed.
    """
    w = Window.partitionBy("path").orderBy("pos")
    marked = steps.join(low.select("node", F.lit(True).alias("low")).distinct(), "node", "left").withColumn("low", F.coalesce("low", F.lit(False)))
    good = F.when(~F.col("low"), F.col("node"))
    s = marked.select("path", "pos", "node", "low", F.row_number().over(w).alias("place"), F.lag(good).over(w).alias("n0"), F.lead(good).over(w).alias("n2"))
    gap = s.where("low and n0 is not null and n2 is not null").join(alternatives(hops, low), ["n0", "n2"]).select("path", "pos", "place", F.col("instead").alias("node"), F.col("node").alias("was"))
    kept = s.where("not low").select("path", "pos", "place", "node", F.lit(None).cast(s.schema["node"].dataType).alias("was")).unionByName(gap)
    follows = F.coalesce(F.lag("place").over(w) == F.col("place") - 1, F.lit(False))
    cuts = kept.withColumn("starts", F.when(follows, 0).otherwise(1))
    return cuts.select("path", (F.sum("starts").over(w) - 1).alias("piece"), "pos", "node", "was")


def without_inclusions(pieces: DataFrame, steps: DataFrame) -> DataFrame:
    """Pieces of replaced() whose nodes no other path of steps has all."""
    named = F.struct("path", "piece").alias("key")
    found = holders(pieces.select(named, "node"), steps).where("key.path <> path").select("key.path", "key.piece").distinct()
    return pieces.join(found, ["path", "piece"], "left_anti")


def low(support: DataFrame, least: Column | float) -> DataFrame:
    """(node): nodes of (node, abundance) under the least abundance."""
    return support.where(F.col("abundance") < least).select("node").distinct()
