"""Operators on paths of oriented steps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.sequences import oriented, reverse_complement
from .lineage import cut


def spelled(steps: DataFrame, segments: DataFrame) -> DataFrame:
    """(path, seq): the steps' oriented sequences, joined in order."""
    j = steps.join(segments.select("node", "seq"), "node").select("path", "pos", oriented(F.col("seq"), F.col("ori")).alias("s"))
    return j.groupBy("path").agg(F.array_sort(F.collect_list(F.struct("pos", "s"))).alias("a")).select("path", F.array_join(F.transform("a", lambda x: x["s"]), "").alias("seq"))


def step_arrays(steps: DataFrame) -> DataFrame:
    """(path, nodes, signed): nodes, and steps like 12+, in order."""
    a = steps.groupBy("path").agg(F.array_sort(F.collect_list(F.struct("pos", "node", "ori"))).alias("a"))
    return a.select("path", F.transform("a", lambda x: x["node"]).alias("nodes"), F.transform("a", lambda x: F.concat(x["node"].cast("string"), x["ori"])).alias("signed"))


def split_at(steps: DataFrame, removed: DataFrame) -> DataFrame:
    """(path, piece, pos, node): paths cut wherever two consecutive steps are a removed edge (n1, n2), either way round."""
    w = Window.partitionBy("path").orderBy("pos")
    s = steps.select("path", "pos", "node", F.lag("node").over(w).alias("before"))
    gone = removed.select(F.col("n1").alias("a"), F.col("n2").alias("b"))
    gone = gone.unionByName(gone.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct().withColumn("cut", F.lit(1))
    j = s.join(gone, (F.col("before") == F.col("a")) & (F.col("node") == F.col("b")), "left")
    return j.select("path", F.coalesce(F.sum("cut").over(w), F.lit(0)).alias("piece"), "pos", "node")


def trimmed(steps: DataFrame, segments: DataFrame, trim: int, low: DataFrame | None = None) -> DataFrame:
    """Steps left when whole nodes go from both ends while their running length is at most trim, or while they are low."""
    j = steps.select("path", "pos", "node", "ori").join(segments.select("node", F.coalesce("len", F.lit(0)).alias("len")), "node")
    j = j.join(low.select("node", F.lit(True).alias("low")), "node", "left") if low is not None else j.withColumn("low", F.lit(None).cast("boolean"))
    # all windows have one order, so a task sorts its paths once
    w = Window.partitionBy("path").orderBy("pos")
    upto, whole = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    j = j.withColumn("_upto", F.sum("len").over(upto)).withColumn("_all", F.sum("len").over(whole))
    front, back = F.col("_upto") > trim, F.col("_all") - F.col("_upto") + F.col("len") > trim
    high = F.col("low").isNull()
    j = j.withColumn("_first", F.min(F.when(front & high, F.col("pos"))).over(whole)).withColumn("_last", F.max(F.when(back & high, F.col("pos"))).over(whole))
    return j.where("pos between _first and _last").select("path", "pos", "node", "ori")


def densely_numbered(df: DataFrame, column: str) -> DataFrame:
    """(column, number): its distinct values numbered from 0 in their order.

    Values are sorted in ranges, numbered in each, and the ranges' counts, one for each range, summed up.
    """
    part = cut(df.select(column).distinct().repartitionByRange(column).sortWithinPartitions(column).withColumn("part", F.spark_partition_id()))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = part.groupBy("part").count().select("part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    return part.join(F.broadcast(base), "part").select(column, (F.col("base") + F.row_number().over(Window.partitionBy("part").orderBy(column)) - 1).alias("number"))


def genome_graph(steps: DataFrame, abundance: DataFrame) -> DataFrame:
    """(path, pos, node): steps of paths with abundance over 0, nodes numbered densely in their order."""
    s = steps.join(abundance.where("abundance > 0").select("path"), "path", "left_semi")
    return s.join(densely_numbered(s, "node"), "node").select("path", "pos", F.col("number").alias("node"))


def combined(segments: DataFrame, steps: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One graph of several that share no node: (node, ..) of segments (graph, node, ..) and (path, pos, node, ori) of steps (graph, path, pos,
    node, ori).

    Nodes are numbered from 1 by graph and their number there; paths get # and their graph's place, from 0, appended.
    """
    at = F.struct("graph", "node").alias("at")
    nodes = cut(densely_numbered(segments.select(at), "at").select("at.graph", "at.node", (F.col("number") + 1).alias("new")))
    graphs = densely_numbered(segments, "graph").select("graph", F.col("number").alias("place"))
    named = steps.join(nodes, ["graph", "node"]).join(graphs, "graph")
    whole = segments.join(nodes, ["graph", "node"]).drop("graph", "node").withColumnRenamed("new", "node")
    return whole, named.select(F.concat(F.col("path").cast("string"), F.lit("#"), F.col("place").cast("string")).alias("path"), "pos", F.col("new").alias("node"), "ori")


def contained(seqs: DataFrame, k: int = 12, key: str = "id", seq: str = "seq") -> DataFrame:
    """(inner, outer): sequences contained in longer ones, or in their reverse complement's strand, or equal with a larger key.

    Candidates share the inner one's first k letters at some place of the outer one, so no pair is compared otherwise;
    sequences of under k letters are looked up whole by their length.
    """
    s = seqs.select(F.col(key).alias("id"), F.upper(seq).alias("seq")).where("length(seq) > 0")
    short = [r[0] for r in s.where(F.length("seq") < k).select(F.length("seq")).distinct().collect()]  # fewer than k lengths
    both = s.select("id", "seq").unionByName(s.select("id", reverse_complement(F.col("seq")).alias("seq")).where("seq is not null"))
    out = None
    for n in [*sorted(short), k]:
        inner = s.where(F.length("seq") == n if n < k else F.length("seq") >= k).select(F.col("id").alias("inner"), F.col("seq").alias("iseq"), F.left("seq", F.lit(n)).alias("seed"))
        grams = both.where(F.length("seq") >= n).select(F.col("id").alias("outer"), F.col("seq").alias("oseq"))
        grams = grams.select("outer", "oseq", F.explode(F.array_distinct(F.transform(F.sequence(F.lit(1), F.length("oseq") - n + 1), lambda i: F.substr("oseq", i, F.lit(n))))).alias("seed"))
        hit = inner.join(grams, "seed").where("inner <> outer and contains(oseq, iseq) and (length(oseq) > length(iseq) or outer > inner)").select("inner", "outer")
        out = hit if out is None else out.unionByName(hit)
    return out.distinct()


def found_in(items: DataFrame, texts: DataFrame, k: int = 24) -> DataFrame:
    """(item_id, doc_id): items (item_id, item) that stand whole in texts (doc_id, text), once for each pair.

    What an item has between its first and last space stands in a text between spaces too, so items of four words or more
    are looked up by their second and third word; others by their first k letters, or all they have.  Only hashes or short
    seeds meet; the texts of hits are fetched for the check.
    """
    i = items.where(F.length("item") > 0).withColumn("w", F.split("item", " "))
    t = texts.where(F.length("text") > 0)
    long = i.where(F.size("w") >= 4).select("item_id", "item", F.xxhash64(F.col("w")[1], F.col("w")[2]).alias("seed"))
    pairs = F.split("text", " ")
    pairs = F.transform(F.array(pairs), lambda w: F.when(F.size(w) >= 2, F.array_distinct(F.transform(F.sequence(F.lit(1), F.size(w) - 1), lambda n: F.xxhash64(F.element_at(w, n), F.element_at(w, n + 1))))))[0]
    places = t.select("doc_id", F.explode(pairs).alias("seed")).join(long, "seed").select("item_id", "item", "doc_id")
    short = i.where(F.size("w") < 4).select("item_id", "item", F.left("item", F.lit(k)).alias("seed"))
    for n in sorted(r[0] for r in short.select(F.length("seed")).distinct().collect()):  # at most k lengths
        cuts = F.transform(F.sequence(F.lit(1), F.length("text") - n + 1), lambda p: F.substr("text", p, F.lit(n)))  # noqa: B023
        hits = t.where(F.length("text") >= n).select("doc_id", F.explode(F.array_distinct(cuts)).alias("seed")).join(short.where(F.length("seed") == n), "seed")
        places = places.unionByName(hits.select("item_id", "item", "doc_id"))
    return places.distinct().join(t, "doc_id").where(F.contains("text", "item")).select("item_id", "doc_id").distinct()


def overlaps(steps: DataFrame, proposed: DataFrame | None = None) -> DataFrame:
    """(p1, p2, start): p2's nodes from its first on are p1's from position start on, until one of them ends.

    Joined on p2's first node, then verified on the arrays.
    """
    a = steps.groupBy("path").agg(F.array_sort(F.collect_list(F.struct("pos", "node"))).alias("x")).select("path", F.transform("x", lambda v: v["node"]).alias("nodes"))
    one = a.select(F.col("path").alias("p1"), F.col("nodes").alias("n1"), F.posexplode("nodes").alias("start", "node"))
    two = a.select(F.col("path").alias("p2"), F.col("nodes").alias("n2"), F.element_at("nodes", 1).alias("node"))
    j = one.join(two, "node").where("p1 <> p2")
    if proposed is not None:
        j = j.join(proposed, ["p1", "p2"], "left_semi")
    n = F.least(F.size("n1") - F.col("start"), F.size("n2"))
    j = j.where(F.slice("n1", F.col("start") + 1, n) == F.slice("n2", 1, n))
    return j.groupBy("p1", "p2").agg(F.min("start").alias("start"))


def reads_with_any(steps: DataFrame, nodes: DataFrame) -> DataFrame:
    return steps.join(nodes, "node", "left_semi").select("path").distinct()


def holders(sets: DataFrame, paths: DataFrame) -> DataFrame:
    """(key, path): paths (path, node) that hold every node of a key's set (key, node); a set with a node of no path, or null, has none.

    A set is looked up by that of its nodes which the fewest paths have; only there keys and paths meet.
    """
    have = paths.select("path", "node").distinct()
    need = sets.select("key", "node").distinct()
    rare = need.join(have.groupBy("node").agg(F.count("*").alias("on")), "node", "left").groupBy("key").agg(F.min(F.struct(F.coalesce("on", F.lit(0)).alias("on"), "node")).alias("r"), F.collect_set("node").alias("need"))
    held = have.groupBy("path").agg(F.collect_set("node").alias("held"))
    meet = rare.select("key", F.col("r.node").alias("node")).join(have, "node").select("key", "path")
    both = meet.join(rare.select("key", "need"), "key").join(held, "path")
    return both.where(F.size(F.array_except("need", "held")) == 0).select("key", "path")


def reads_with_all(steps: DataFrame, wanted: DataFrame) -> DataFrame:
    """(path, key): paths that hold every node of a key's set (key, node)."""
    return holders(wanted, steps).select("path", "key")


def first_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in the given order."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")


def numbered(df: DataFrame, name: str, order: list[Column]) -> DataFrame:
    """Names that occur more than once get -1, -2, ... appended, in the given order."""
    w = Window.partitionBy(name)
    many = F.count("*").over(w) > 1
    return df.withColumn("numbered", F.when(many, F.concat(F.col(name).cast("string"), F.lit("-"), F.row_number().over(w.orderBy(*order)).cast("string"))).otherwise(F.col(name).cast("string")))
