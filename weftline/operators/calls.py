"""Call rules, naming, variants and phasing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .abundance import adjacent


def passed_calls(calls: DataFrame, group: list[str]) -> DataFrame:
    """calls (allele, coverage, freq) with `passed`: freq at least 0.1, coverage at least 2 and over a quarter of the group's
    largest; where that fails all of a group, coverage at least 2 and freq at least 0.2."""
    w = Window.partitionBy(*group)
    strict = (F.col("freq") >= 0.1) & (F.col("coverage") >= 2) & (F.col("coverage") * 4 > F.max("coverage").over(w))
    c = calls.withColumn("_strict", strict)
    return c.withColumn("passed", F.when(F.bool_or("_strict").over(w), F.col("_strict")).otherwise((F.col("coverage") >= 2) & (F.col("freq") >= 0.2))).drop("_strict")


def frequencies(calls: DataFrame, group: list[str], least: float) -> DataFrame:
    """calls of at least `least` coverage with freq, the whole part of the coverage over the group's sum."""
    kept = calls.where(F.col("coverage") >= least)
    return kept.withColumn("freq", F.floor("coverage") / F.sum("coverage").over(Window.partitionBy(*group)))


def strains(calls: DataFrame, group: list[str], least: float = 0.001) -> DataFrame:
    """How many contigs of a group have abundance, and at least 2."""
    return calls.groupBy(*group).agg(F.greatest(F.count_if(F.col("coverage") >= least), F.lit(2)).alias("max_strains"))


def missing(worklist: DataFrame, calls: DataFrame, key: str) -> DataFrame:
    """Worked genes without a call, as deletions: coverage 0, not passed."""
    return worklist.select(key).distinct().join(calls, key, "left_anti").select(key, F.concat(key, F.lit(":deletion")).alias("allele"), F.lit(0.0).alias("coverage"), F.lit(False).alias("passed"))


def off_target(members: DataFrame, target: Column) -> DataFrame:
    """Nodes (node, gene) of other genes that the target's do not have."""
    return members.where(~target).select("node").distinct().join(members.where(target).select("node"), "node", "left_anti")


def filtering_nodes(members: DataFrame, group: str) -> DataFrame:
    """(group, node) that tell reads of elsewhere, from members (group, allele, node, target).

    Where a group has target alleles: nodes of its others that no target has.  Where it has none: nodes of its orphons, alleles with
    a slash in their names, since they lie on another part of the graph; but none if all of the group are orphons.
    """
    flags = members.select(group, "node", F.coalesce("target", F.lit(False)).alias("on"), F.coalesce(F.contains("allele", F.lit("/")), F.lit(False)).alias("orphon"))
    nodes = flags.groupBy(group, "node").agg(F.bool_or("on").alias("on"), F.bool_or("orphon").alias("orphon"))
    groups = flags.groupBy(group).agg(F.bool_or("on").alias("some"), F.bool_and("orphon").alias("only"))
    return nodes.join(groups, group).where(F.when(F.col("some"), ~F.col("on")).otherwise(F.col("orphon") & ~F.col("only"))).select(group, "node")


def seen_twice(rows: DataFrame, key: str, least: int = 2) -> DataFrame:
    return rows.groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") >= least)


def novel_nodes(reads: DataFrame, alleles: DataFrame) -> DataFrame:
    """Nodes of reads' steps, not of alleles', with at least two edge ends, two of them on edges that touch allele nodes."""
    known = alleles.select("node").distinct()
    fresh = reads.select("node").distinct().join(known, "node", "left_anti")
    e = adjacent(reads).select("n1", "n2").distinct()
    ends = e.select(F.col("n1").alias("node"), F.col("n2").alias("other")).unionByName(e.select(F.col("n2").alias("node"), F.col("n1").alias("other")))
    ends = ends.join(known.select(F.col("node").alias("other"), F.lit(1).alias("touch")), "other", "left")
    good = ends.groupBy("node").agg(F.count("*").alias("ends"), F.count("touch").alias("touching")).where("ends >= 2 and touching >= 2")
    return fresh.join(good, "node").select("node", "ends", "touching")


def deletions(reads: DataFrame, alleles: DataFrame, over: int) -> DataFrame:
    """(n1, n2, n): pairs of allele nodes adjacent in over `over` reads' places and in no allele."""
    known = alleles.select("node").distinct()
    pairs = adjacent(reads).groupBy("n1", "n2").agg(F.count("*").alias("n")).where(F.col("n") > over)
    pairs = pairs.join(known.select(F.col("node").alias("n1")), "n1", "left_semi").join(known.select(F.col("node").alias("n2")), "n2", "left_semi")
    return pairs.join(adjacent(alleles).select("n1", "n2").distinct(), ["n1", "n2"], "left_anti").select("n1", "n2", "n")


def pruned_paths(steps: DataFrame, weak: DataFrame, protected: Column) -> DataFrame:
    """Steps without weak nodes; a node on a protected path stays."""
    held = steps.where(protected).select("node").distinct()
    gone = weak.select("node").distinct().join(held, "node", "left_anti")
    return steps.join(gone, "node", "left_anti")


def support_matrix(reads: DataFrame, alleles: DataFrame, group: str) -> DataFrame:
    """(group, allele, reads): distinct reads that share a node with an allele, by group.  Both sides are (node, path) and group."""
    a = alleles.select("node", F.col("path").alias("allele")).distinct()
    return reads.select("node", "path", group).distinct().join(a, "node").groupBy(group, "allele").agg(F.count_distinct("path").alias("reads"))


def best_allele(support: DataFrame, group: str) -> DataFrame:
    """(group, allele, reads): the allele most reads support, or `ambiguous` if several do, or at most one read does."""
    w = Window.partitionBy(group)
    top = support.withColumn("_m", F.max("reads").over(w)).where("reads = _m")
    agg = top.groupBy(group).agg(F.count("*").alias("n"), F.min(F.col("allele").cast("string")).alias("a"), F.max("reads").alias("reads"))
    return agg.select(group, F.when((F.col("n") > 1) | (F.col("reads") <= 1), "ambiguous").otherwise(F.col("a")).alias("allele"), "reads")


def residual_alleles(alleles: DataFrame) -> DataFrame:
    """(allele, depth, variant_depth, all_phased): what is left of an allele once its variants took their share.

    Depth over 5: under two thirds taken keeps it as exact_ (all phased) or ambiguous_exact_ with the rest; over two
    thirds drops it; else, and at depths up to 5, it stays.
    """
    share = F.col("variant_depth") / F.col("depth")
    deep = F.col("depth") > 5
    label = F.when(deep & (share < 0.667), F.when(F.col("all_phased"), F.concat(F.lit("exact_"), "allele")).otherwise(F.concat(F.lit("ambiguous_exact_"), "allele")))
    out = alleles.where(~(deep & (share > 0.667)))
    return out.select(F.coalesce(label, "allele").alias("allele"), F.when(label.isNotNull(), F.col("depth") - F.col("variant_depth")).otherwise(F.col("depth")).alias("depth"))


def by_form(queries: DataFrame, answer) -> DataFrame:
    """answer(queries) for queries (id, ..), asked once for all ids that have the same rows: its work is that of the different rows, and
    what it answers reaches the ids in a join."""
    rows = F.struct(*(c for c in queries.columns if c != "id"))
    own = queries.groupBy("id").agg(F.sort_array(F.collect_set(rows)).alias("form"))
    asked = own.select("form").distinct().select(F.col("form").alias("id"), F.explode("form").alias("row")).select("id", "row.*")
    got = answer(asked)
    return own.join(got.withColumnRenamed("id", "form"), "form").select(*got.columns)


def nearest(queries: DataFrame, catalogue: DataFrame, distance: Column, group: list[str]) -> DataFrame:
    """Each query's (id) nearest catalogue entries (name) of its group by distance; ties joined by ` or `."""
    j = queries.join(catalogue, group).withColumn("distance", distance).where("distance is not null")
    low = F.min("distance").over(Window.partitionBy("id"))
    return j.withColumn("_m", low).where("distance = _m").groupBy("id").agg(F.array_join(F.array_sort(F.collect_set("name")), " or ").alias("name"), F.min("distance").alias("distance"))
