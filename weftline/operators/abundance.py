"""Node and edge support of aligned steps, and what is derived from it.

Steps are (path, pos, node, ori, aligned, kind); segments are (node, len, seq, gene).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def node_abundance(segments: DataFrame, steps: DataFrame) -> DataFrame:
    """Aligned bases over node length; 0 for nodes without alignments or bases."""
    got = steps.groupBy("node").agg(F.sum("aligned").alias("bases"))
    value = F.when(F.col("len") > 0, F.coalesce("bases", F.lit(0.0)) / F.col("len")).otherwise(0.0)
    return segments.join(got, "node", "left").select("node", value.alias("abundance"))


def clipped_steps(steps: DataFrame, segments: DataFrame) -> DataFrame:
    """(path, pos, node, aligned): bases of each step of an alignment (path, pos, node, start, end) that lie between its start and end,
    which count along the path; so the first and last nodes count in part."""
    w = Window.partitionBy("path").orderBy("pos")
    j = steps.join(segments.select("node", F.col("len").cast("long").alias("len")), "node")
    j = j.withColumn("upto", F.sum("len").over(w))
    inside = F.least("end", "upto") - F.greatest("start", F.col("upto") - F.col("len"))
    return j.select("path", "pos", "node", F.greatest(inside, F.lit(0)).cast("double").alias("aligned"))


def adjacent(steps: DataFrame) -> DataFrame:
    """(path, pos, n1, o1, n2, o2): every two consecutive steps of a path; pos is the second's."""
    w = Window.partitionBy("path").orderBy("pos")
    pairs = steps.select("path", "pos", F.lag("node").over(w).alias("n1"), F.lag("ori").over(w).alias("o1"), F.col("node").alias("n2"), F.col("ori").alias("o2"))
    return pairs.where("n1 is not null")


def edge_support(steps: DataFrame, oriented: bool = False) -> DataFrame:
    """How many paths' steps cross each edge; oriented: an edge into a reverse step counts the other way round."""
    e = adjacent(steps)
    if oriented:
        back = F.col("o2") == "-"
        e = e.select(F.when(back, F.col("n2")).otherwise(F.col("n1")).alias("n1"), F.when(back, F.col("n1")).otherwise(F.col("n2")).alias("n2"))
    return e.groupBy("n1", "n2").agg(F.count("*").alias("n"))


def with_support(edges: DataFrame, support: DataFrame) -> DataFrame:
    """edges (n1, n2) with their support, 0 where there is none."""
    return edges.join(support, ["n1", "n2"], "left").withColumn("n", F.coalesce("n", F.lit(0)).cast("long"))


def two_hop_support(steps: DataFrame) -> DataFrame:
    """(n0, n1, n2, n): how often a node stands between two others in a path."""
    w = Window.partitionBy("path").orderBy("pos")
    t = steps.select(F.lag("node", 2).over(w).alias("n0"), F.lag("node", 1).over(w).alias("n1"), F.col("node").alias("n2"))
    return t.where("n0 is not null").groupBy("n0", "n1", "n2").agg(F.count("*").alias("n"))


def edge_filter(support: DataFrame, least: int, branching_only: bool = True) -> DataFrame:
    """Edges that stay: supported by `least`, or, if branching_only, the only one out of n1 and the only one into n2."""
    out = support.groupBy("n1").agg(F.count("*").alias("outs"))
    into = support.groupBy("n2").agg(F.count("*").alias("ins"))
    weak = F.col("n") < least
    if branching_only:
        weak = weak & ((F.col("outs") > 1) | (F.col("ins") > 1))
    return support.join(out, "n1").join(into, "n2").where(~weak).select("n1", "n2", "n")


def paths_per_node(steps: DataFrame) -> DataFrame:
    return steps.groupBy("node").agg(F.count_distinct("path").alias("paths"))


def signatures(steps: DataFrame, path: str = "path") -> DataFrame:
    """Each node's set of paths as text, for few paths."""
    return steps.groupBy("node").agg(F.array_join(F.array_sort(F.collect_set(F.col(path).cast("string"))), ",").alias("signature"))


def first_of_signature(signed: DataFrame, k: int) -> DataFrame:
    """The k smallest nodes of every signature."""
    w = Window.partitionBy("signature").orderBy("node")
    return signed.withColumn("nth", F.row_number().over(w)).where(F.col("nth") <= k).select("signature", "node", "nth")


def signature_mean(signed: DataFrame, abundance: DataFrame, segments: DataFrame, scale: int = 1) -> DataFrame:
    """Length-weighted mean abundance of every signature's nodes, times `scale`, which is multiplied before the division: a mean that lies
    between two whole numbers is then told as it is and not as its nearest fraction times the scale."""
    j = signed.join(abundance, "node").join(segments.select("node", "len"), "node")
    return j.groupBy("signature").agg((F.sum(F.col("abundance") * F.col("len")) * scale / F.sum("len")).alias("abundance"), F.count("*").alias("nodes"))


def rarity_weights(per_node: DataFrame, group: str) -> DataFrame:
    """max(paths)/paths of each node, scaled to 0..1 in its group; null where a group is constant."""
    w = Window.partitionBy(group)
    raw = F.max("paths").over(w) / F.col("paths")
    r = per_node.withColumn("raw", raw)
    low, high = F.min("raw").over(w), F.max("raw").over(w)
    return r.select(group, "node", F.when(high > low, (F.col("raw") - low) / (high - low)).alias("weight"))


def depth_summary(values: DataFrame, key: str, value: str) -> DataFrame:
    """Mean and sample deviation by key."""
    return values.groupBy(key).agg(F.avg(value).alias("mean"), F.stddev_samp(value).alias("sd"), F.count("*").alias("n"))


def cluster_depth_to_genes(clusters: DataFrame, members: DataFrame) -> DataFrame:
    """(cluster, mean, sd) and (cluster, gene): each gene's mean of its clusters' means, and of their deviations."""
    return members.distinct().join(clusters, "cluster").groupBy("gene").agg(F.avg("mean").alias("mean"), F.avg("sd").alias("sd"))


def error_summary(pairs: DataFrame) -> DataFrame:
    """(estimate, truth): mean absolute and relative errors, extremes, and counts over and under."""
    d = F.col("estimate") - F.col("truth")
    return pairs.agg(
        F.count("*").alias("n"), F.avg(F.abs(d)).alias("mean_abs"), F.avg(F.when(F.col("truth") != 0, F.abs(d) / F.col("truth"))).alias("mean_rel"),
        F.max(d).alias("largest"), F.min(d).alias("smallest"), F.count_if(d > 0).alias("over"), F.count_if(d < 0).alias("under"),
    )


ERROR_EDGES = (1, 5, 10, 25, 50, 100)


def error_bins(pairs: DataFrame) -> DataFrame:
    """Counts in 14 signed bins of the error: 0 to ERROR_EDGES and beyond, on either side of zero."""
    d = F.col("estimate") - F.col("truth")
    size = sum(((F.abs(d) >= e).cast("int") for e in ERROR_EDGES), F.lit(0))
    return pairs.select(F.when(d < 0, -(size + 1)).otherwise(size + 1).alias("bin")).groupBy("bin").agg(F.count("*").alias("n"))
