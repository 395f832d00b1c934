"""Variants that reads show beside known alleles: flanks, support, report, pruning.

Steps are (path, pos, node, ori); links are edges (n1, n2); segments are (node, seq).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _around(steps: DataFrame) -> DataFrame:
    """(path, node, ori, before, after): every step with its neighbours on the path."""
    w = Window.partitionBy("path").orderBy("pos")
    return steps.select("path", "node", "ori", F.lag("node").over(w).alias("before"), F.lead("node").over(w).alias("after"))


def flanks(variants: DataFrame, links: DataFrame, reads: DataFrame, alleles: DataFrame) -> DataFrame:
    """(node, left, right, ori, tricky) of every variant node.

    The flanks are a node's two neighbours; with more of them, the two that are allele nodes; else the node is tricky and
    has none.  Left is the flank that more reads' steps have before the node than after it, the smaller one on ties.  The
    sign is that of most reads' steps, of those between two allele nodes if there are any, and + on ties.
    """
    v = variants.select("node").distinct()
    known = alleles.select(F.col("node").alias("other"), F.lit(True).alias("known")).distinct()
    ends = links.select(F.col("n1").alias("node"), F.col("n2").alias("other")).unionByName(links.select(F.col("n2").alias("node"), F.col("n1").alias("other")))
    ends = ends.where("node <> other").distinct().join(v, "node", "left_semi").join(known, "other", "left")
    near = ends.groupBy("node").agg(F.count("*").alias("others"), F.count("known").alias("knowns"))
    two = ends.join(near, "node").where("others = 2 or (knowns = 2 and known)").select("node", "other")

    at = _around(reads).join(v, "node", "left_semi")
    beside = at.select("node", F.col("before").alias("other"), F.lit(1).alias("way")).unionByName(at.select("node", F.col("after").alias("other"), F.lit(-1).alias("way"))).where("other is not null")
    score = beside.groupBy("node", "other").agg(F.sum("way").alias("score"))
    ranked = two.join(score, ["node", "other"], "left").withColumn("nth", F.row_number().over(Window.partitionBy("node").orderBy(F.desc(F.coalesce("score", F.lit(0))), "other")))
    pair = ranked.groupBy("node").agg(F.max(F.when(F.col("nth") == 1, F.col("other"))).alias("left"), F.max(F.when(F.col("nth") == 2, F.col("other"))).alias("right"))

    inner = at.join(known.select(F.col("other").alias("before"), F.col("known").alias("kb")), "before", "left").join(known.select(F.col("other").alias("after"), F.col("known").alias("ka")), "after", "left")
    sign = F.when(F.col("ori") == "+", 1).otherwise(-1)
    between = F.col("kb") & F.col("ka")
    signs = inner.groupBy("node").agg(F.count_if(between).alias("n"), F.sum(F.when(between, sign)).alias("inside"), F.sum(sign).alias("every"))
    signs = signs.select("node", F.when(F.when(F.col("n") > 0, F.col("inside")).otherwise(F.col("every")) < 0, "-").otherwise("+").alias("ori"))
    out = v.join(pair, "node", "left").join(signs, "node", "left")
    return out.select("node", "left", "right", F.coalesce("ori", F.lit("+")).alias("ori"), F.col("left").isNull().alias("tricky"))


def support(placed: DataFrame, reads: DataFrame) -> DataFrame:
    """(node, reads): distinct reads that go left, node, right or back, of flanks() that are not tricky; 0 where none does."""
    p = placed.where("not tricky").select("node", "left", "right")
    hit = _around(reads).join(p, "node").where("(before = left and after = right) or (before = right and after = left)")
    return p.select("node").join(hit.groupBy("node").agg(F.count_distinct("path").alias("reads")), "node", "left").fillna(0, ["reads"])


def report(placed: DataFrame, segments: DataFrame, reads: DataFrame, references: DataFrame) -> DataFrame:
    """(node, reads, length, overlap, seq): support, the node's own length, how many reference paths go the same way, and the local sequence."""
    seq = lambda as_: segments.select(F.col("node").alias(as_), F.col("seq").alias(f"{as_}_seq"))
    p = placed.where("not tricky").join(seq("node"), "node").join(seq("left"), "left").join(seq("right"), "right")
    overlap = support(placed, references).withColumnRenamed("reads", "overlap")
    return p.join(support(placed, reads), "node").join(overlap, "node").select("node", "reads", F.length("node_seq").alias("length"), "overlap", (F.col("overlap") == 0).alias("novel"), F.concat("left_seq", "node_seq", "right_seq").alias("seq"))


def pruned(steps: DataFrame, edges: DataFrame, weak: DataFrame, protected: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(steps, edges) without weak variants (node, left, right).

    Every path through a weak node goes but the protected ones (path); a node that none of these uses goes with its two edges.
    """
    held = steps.join(protected.select("path"), "path", "left_semi").select("node").distinct()
    through = steps.join(weak.select("node"), "node", "left_semi").select("path").distinct().join(protected.select("path"), "path", "left_anti")
    gone = weak.join(held, "node", "left_anti")
    cut = gone.select(F.explode(F.array(F.struct(F.col("left").alias("n1"), F.col("node").alias("n2")), F.struct(F.col("node").alias("n1"), F.col("right").alias("n2")))).alias("e")).select("e.*")
    cut = cut.unionByName(cut.select(F.col("n2").alias("n1"), F.col("n1").alias("n2"))).distinct()
    return steps.join(through, "path", "left_anti"), edges.join(cut, ["n1", "n2"], "left_anti")


def pruning_depths(variants: DataFrame, depth: str = "depth") -> DataFrame:
    """variants with `prune` (depth exactly 0, 1 or 2), `phase` (not from 1 up to under 3) and `phase_deletion` (not exactly 1 or 2)."""
    d = F.col(depth)
    return variants.select("*", d.isin(0, 1, 2).alias("prune"), (~((d >= 1) & (d < 3))).alias("phase"), (~d.isin(1, 2)).alias("phase_deletion"))
