"""From overlaps of contigs to a flow graph, and from its paths to node paths.

Overlaps are (c1, c2, start, ori): contig c2 begins at step `start` of c1, from 0, and ori is the two contigs' signs there,
like ++ or +-.  Contig steps are (path, pos, node, ori).
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import graph, parts
from .lineage import cut
from .paths import densely_numbered


def _signed(steps: DataFrame, low: DataFrame | None) -> DataFrame:
    """(path, x): a path's steps as an array of (node, ori, low)."""
    s = steps.select("path", "pos", "node", "ori")
    s = s.join(low.select("node").distinct().withColumn("low", F.lit(True)), "node", "left") if low is not None else s.withColumn("low", F.lit(None).cast("boolean"))
    x = F.array_sort(F.collect_list(F.struct("pos", "node", "ori", F.coalesce("low", F.lit(False)).alias("low"))))
    return s.groupBy("path").agg(x.alias("a")).select("path", F.transform("a", lambda v: F.struct(v["node"], v["ori"], v["low"])).alias("x"))


def _back(x: Column) -> Column:
    return F.transform(F.reverse(x), lambda v: F.struct(v["node"].alias("node"), F.when(v["ori"] == "-", "+").otherwise("-").alias("ori"), v["low"].alias("low")))


def _begin(x: Column, y: Column) -> Column:
    """Where y begins in x, from 0: the least place from which both are alike until one ends; low nodes are like any."""
    first = F.array_min(F.filter(F.sequence(F.lit(1), F.size(y)), lambda i: ~F.element_at(y, i)["low"]))
    same = lambda a, b: a["low"] | b["low"] | ((a["node"] == b["node"]) & (a["ori"] == b["ori"]))
    fits = lambda i: F.forall(F.sequence(F.lit(0), F.least(F.size(x) - i, F.size(y) - first)), lambda k: same(F.element_at(x, i + k), F.element_at(y, first + k)))
    found = F.filter(F.sequence(F.lit(1), F.size(x)), lambda i: (F.element_at(x, i)["node"] == F.element_at(y, first)["node"]) & (i >= first) & fits(i))
    return F.when(first.isNotNull(), F.array_min(found) - first)


def overlaps(steps: DataFrame, proposed: DataFrame, low: DataFrame | None = None) -> DataFrame:
    """Overlaps of the proposed pairs (c1, c2, way), way + or -, whose steps agree; of several proposals of a pair the first way that
    fits, by nth if the proposals have one, else + before -.

    For + both contigs are read forwards; for - c2 is read backwards, and if that fails c1.
    """
    a = _signed(steps, low)
    order = F.col("nth") if "nth" in proposed.columns else F.lit(0)
    j = proposed.where("c1 <> c2").groupBy("c1", "c2", "way").agg(F.min(order).alias("nth")).join(a.select(F.col("path").alias("c1"), F.col("x").alias("x1")), "c1").join(a.select(F.col("path").alias("c2"), F.col("x").alias("x2")), "c2")
    j = j.withColumn("fwd", F.when(F.col("way") == "+", _begin(F.col("x1"), F.col("x2"))).otherwise(_begin(F.col("x1"), _back(F.col("x2")))))
    j = j.withColumn("rev", F.when((F.col("way") == "-") & F.col("fwd").isNull(), _begin(_back(F.col("x1")), F.col("x2"))))
    start = F.coalesce("fwd", "rev")
    ori = F.when(F.col("way") == "+", "++").when(F.col("fwd").isNotNull(), "+-").otherwise("-+")
    hit = j.where(start.isNotNull()).select("c1", "c2", F.struct("nth", "way").alias("turn"), start.alias("start"), ori.alias("ori"))
    return hit.groupBy("c1", "c2").agg(F.min_by(F.struct("start", "ori"), "turn").alias("b")).select("c1", "c2", "b.*")


def oriented(edges: DataFrame, lengths: DataFrame, groups: DataFrame | None = None) -> DataFrame:
    """Overlaps whose signs agree with one sign for each contig; lengths are (path, n) in steps.

    A component's smallest contig is read forwards and the others as overlaps from it tell, found as components of a graph
    of (contig, sign); where a cycle of overlaps contradicts itself, both signs of a contig fall into one component and it is
    read forwards.  Overlaps with both signs wrong are turned, c2 before c1, and those with one wrong are dropped.  Contigs may lie
    in groups (path and one more column) that no overlap joins.
    """
    group = next(c for c in groups.columns if c != "path") if groups is not None else None
    if group:
        edges = cut(edges.join(groups.select(F.col("path").alias("c1"), F.col(group).alias("_of")), "c1"))
    of = ["_of"] if group else []
    signed = lambda c, sign: F.col(c) * 2 + (sign == "-").cast("long")
    s1, s2 = F.substring("ori", 1, 1), F.substring("ori", 2, 1)
    other = lambda s: F.when(s == "+", "-").otherwise("+")
    doubled = edges.select(*of, signed("c1", s1).alias("n1"), signed("c2", s2).alias("n2")).unionByName(edges.select(*of, signed("c1", other(s1)).alias("n1"), signed("c2", other(s2)).alias("n2")))
    label = graph.components(doubled, *of).withColumn("contig", F.floor(F.col("node") / 2).cast("long")).groupBy("contig").agg(F.min_by("component", "node").alias("plus"), F.max_by("component", "node").alias("minus"))
    sign = label.select("contig", F.when(F.col("plus") <= F.col("minus"), "+").otherwise("-").alias("sign"))
    size = lambda c: lengths.select(F.col("path").alias(c), F.col("n").alias(f"n_{c}"))
    j = edges.join(sign.select(F.col("contig").alias("c1"), F.col("sign").alias("g1")), "c1").join(sign.select(F.col("contig").alias("c2"), F.col("sign").alias("g2")), "c2").join(size("c1"), "c1").join(size("c2"), "c2")
    good, turned = (s1 == F.col("g1")) & (s2 == F.col("g2")), (s1 != F.col("g1")) & (s2 != F.col("g2"))
    kept = j.where(good).select("c1", "c2", "start", "ori")
    flipped = j.where(turned).select(F.col("c2").alias("c1"), F.col("c1").alias("c2"), (F.col("n_c2") - F.col("n_c1") + F.col("start")).cast("int").alias("start"), F.concat("g2", "g1").alias("ori"))
    return kept.unionByName(flipped)


SOURCE, SINK = 0, 1


def flow_graph(contigs: DataFrame, overlaps: DataFrame) -> DataFrame:
    """(src, dst, weight, kind, c1, c2): a contig is an edge of weight 1 between two nodes of its own, 2 + 2i and 3 + 2i for the
    i-th contig (c) in order; an overlap one of weight -1; contigs without one before or behind hang on source 0 and sink 1, weight 0."""
    number = densely_numbered(contigs, "c").select("c", (F.col("number") * 2 + 2).alias("i"))
    e = overlaps.select("c1", "c2").distinct()
    own = number.select(F.col("i").alias("src"), (F.col("i") + 1).alias("dst"), F.lit(1).alias("weight"), F.lit("contig").alias("kind"), F.col("c").alias("c1"), F.col("c").alias("c2"))
    at = lambda c, name: number.select(F.col("c").alias(c), F.col("i").alias(name))
    over = e.join(at("c1", "i1"), "c1").join(at("c2", "i2"), "c2").select((F.col("i1") + 1).alias("src"), F.col("i2").alias("dst"), F.lit(-1).alias("weight"), F.lit("overlap").alias("kind"), "c1", "c2")
    none = F.lit(None).cast(contigs.schema["c"].dataType)
    sink = number.join(e.select(F.col("c1").alias("c")), "c", "left_anti").select((F.col("i") + 1).alias("src"), F.lit(SINK).cast("long").alias("dst"), F.lit(0).alias("weight"), F.lit("sink").alias("kind"), F.col("c").alias("c1"), none.alias("c2"))
    source = number.join(e.select(F.col("c2").alias("c")), "c", "left_anti").select(F.lit(SOURCE).cast("long").alias("src"), F.col("i").alias("dst"), F.lit(0).alias("weight"), F.lit("source").alias("kind"), none.alias("c1"), F.col("c").alias("c2"))
    return own.unionByName(over).unionByName(sink).unionByName(source)


def node_edges(steps: DataFrame, overlaps: DataFrame) -> DataFrame:
    """(node, c1, c2, weight): the flow edges that a node's abundance is made of: contigs that hold it, less overlaps in which it lies."""
    own = steps.select("node", F.col("path").alias("c1"), F.col("path").alias("c2")).distinct().withColumn("weight", F.lit(1))
    n = steps.groupBy("path").agg(F.max("pos").alias("last"), F.min("pos").alias("first"))
    inside = overlaps.join(n.select(F.col("path").alias("c1"), "first", "last"), "c1").join(steps.select(F.col("path").alias("c1"), "pos", "node"), "c1")
    inside = inside.join(n.select(F.col("path").alias("c2"), (F.col("last") - F.col("first") + 1).alias("n2")), "c2")
    place = F.when(F.substring("ori", 1, 1) == "-", F.col("last") - F.col("pos")).otherwise(F.col("pos") - F.col("first"))
    return own.unionByName(inside.where((place >= F.col("start")) & (place < F.col("start") + F.col("n2"))).select("node", "c1", "c2").distinct().withColumn("weight", F.lit(-1)))


def contig_flows(edges: DataFrame, flows: DataFrame) -> DataFrame:
    """(c, abundance): the flow (src, dst, flow) on each contig's own edge."""
    return edges.where("kind = 'contig'").join(flows, ["src", "dst"]).select(F.col("c1").alias("c"), F.col("flow").alias("abundance"))


def joined_steps(paths: DataFrame, overlaps: DataFrame, steps: DataFrame) -> DataFrame:
    """(path, pos, node, ori) of paths of contigs (path, nth, contig), laid over one another at their overlaps.

    A contig begins `start` steps behind the beginning of the one before it and is read with the sign that its overlap gives
    it, the first contig with that of its overlap to the second, or forwards; of a place that several cover, the first has it.
    """
    w = Window.partitionBy("path").orderBy("nth")
    p = paths.select("path", "nth", "contig", F.lag("contig").over(w).alias("c1"), F.lead("contig").over(w).alias("behind"))
    o = overlaps.select("c1", F.col("c2").alias("contig"), "start", F.substring("ori", 2, 1).alias("sign"))
    p = p.join(o, ["c1", "contig"], "left").join(overlaps.select(F.col("c1").alias("contig"), F.col("c2").alias("behind"), F.substring("ori", 1, 1).alias("own")), ["contig", "behind"], "left")
    sign = F.coalesce(F.when(F.col("nth") == F.min("nth").over(Window.partitionBy("path")), F.col("own")).otherwise(F.col("sign")), F.lit("+"))
    p = p.select("path", "nth", "contig", sign.alias("sign"), F.sum(F.coalesce("start", F.lit(0))).over(w).alias("begin"))
    n = steps.groupBy("path").agg(F.min("pos").alias("first"), F.max("pos").alias("last"))
    p = p.join(n.select(F.col("path").alias("contig"), "first", "last"), "contig")
    reach = F.max(F.col("begin") + F.col("last") - F.col("first") + 1).over(w.rowsBetween(Window.unboundedPreceding, -1))
    p = p.withColumn("covered", F.coalesce(reach, F.lit(0)))
    j = p.join(steps.select(F.col("path").alias("contig"), "pos", "node", "ori"), "contig")
    back = F.col("sign") == "-"
    place = F.col("begin") + F.when(back, F.col("last") - F.col("pos")).otherwise(F.col("pos") - F.col("first"))
    turned = F.when(back, F.when(F.col("ori") == "+", "-").otherwise("+")).otherwise(F.col("ori"))
    return j.where(place >= F.col("covered")).select("path", place.cast("long").alias("pos"), "node", turned.alias("ori"))


def contig_order(contigs: DataFrame, overlaps: DataFrame, group: str) -> DataFrame:
    """(group, c, nth): the order in which contigs (group, c, len) are laid out: the longest left, the smallest name first among equals,
    then by name all contigs left that overlap it (c1, c2), and so on.

    The contigs that others are laid behind are what a walk from the longest on chooses when it passes over those that overlap a
    chosen one (graph.first_choice(); overlaps join contigs of one group only); every other contig stands behind the first of them that it overlaps.
    """
    e = cut(overlaps.select("c1", "c2").unionByName(overlaps.select(F.col("c2").alias("c1"), F.col("c1").alias("c2"))).where("c1 <> c2").distinct())
    contigs = cut(contigs.select(group, "c", "len"))
    rank = contigs.select(group, "c", F.struct((-F.col("len")).alias("n"), F.col("c").alias("name")).alias("rank"))
    lead = graph.first_choice(rank.select(F.col("c").alias("node"), "rank", group), e.where("c1 < c2").select(F.col("c1").alias("n1"), F.col("c2").alias("n2")), group)
    lead = graph._cut(rank.join(lead.select(F.col("node").alias("c")), "c", "left_semi"))
    behind = e.join(lead.select(F.col("c").alias("c1"), "rank"), "c1").groupBy(F.col("c2").alias("c")).agg(F.min("rank").alias("first"))
    at = contigs.select(group, "c").join(lead.select("c", F.col("rank").alias("own")), "c", "left").join(behind, "c", "left")
    w = Window.partitionBy(group).orderBy(F.coalesce("own", "first"), F.col("own").isNull(), "c")
    return at.select(group, "c", (F.row_number().over(w) - 1).alias("nth"))


def enumerated(edges: DataFrame, group: str, most: int, nodes: DataFrame | None = None) -> DataFrame:
    """(group, nodes): all source-to-sink paths of a group's edges (group, n1, n2), without a node twice, of up to `most` edges; of
    nodes (group, node), if given, those without an edge are paths of their own.

    The bound is the feature: the paths of a graph may be exponentially many, and longer ones are not asked for.
    """
    e = edges.select(group, "n1", "n2").where("n1 <> n2").distinct()
    heads = e.join(e.select(group, F.col("n2").alias("n1")).distinct(), [group, "n1"], "left_anti").select(group, F.col("n1").alias("node")).distinct()
    ends = e.join(e.select(group, F.col("n1").alias("n2")).distinct(), [group, "n2"], "left_anti").select(group, F.col("n2").alias("node"), F.lit(True).alias("end")).distinct()
    open_ = heads.select(group, F.array("node").alias("nodes"), "node")
    done = None
    if nodes is not None:
        on = e.select(group, F.col("n1").alias("node")).unionByName(e.select(group, F.col("n2").alias("node")))
        done = nodes.select(group, "node").distinct().join(on, [group, "node"], "left_anti").select(group, F.array("node").alias("nodes"))
    for _ in range(most):
        step = open_.join(e.select(group, F.col("n1").alias("node"), "n2"), [group, "node"]).where(~F.array_contains("nodes", F.col("n2")))
        open_ = graph._cut(step.select(group, F.array_append("nodes", F.col("n2")).alias("nodes"), F.col("n2").alias("node")))
        at_end = open_.join(ends, [group, "node"]).select(group, "nodes")
        done = at_end if done is None else done.unionByName(at_end)
    return done


def extremities(edges: DataFrame, lengths: DataFrame, least: int, part: str | None = None) -> DataFrame:
    """(node): nodes fewer than `least` bases, their own with them, from a source or a sink, by the shortest way; lengths are (node, len).

    Edges may lie in parts that none of them joins, told by a column.
    """
    if part is not None:
        return _extremities_of_parts(edges, lengths, least, part)
    e = edges.select("n1", "n2").where("n1 <> n2").distinct()
    length = lengths.select("node", F.col("len").cast("long").alias("len"))

    def reached(a: str, b: str) -> DataFrame:
        heads = e.select(F.col(a).alias("node")).distinct().join(e.select(F.col(b).alias("node")), "node", "left_anti")
        near = graph._cut(heads.join(length, "node").select("node", F.col("len").alias("depth")).where(F.col("depth") < least))
        fresh = near
        while fresh.limit(1).count():  # a node comes again only with less depth, so at most `least` times
            step = fresh.join(e, fresh.node == F.col(a)).select(F.col(b).alias("node"), "depth").join(length, "node")
            step = step.groupBy("node").agg(F.min(F.col("depth") + F.col("len")).alias("new")).where(F.col("new") < least)
            better = step.join(near, "node", "left").where("depth is null or new < depth").select("node", F.col("new").alias("depth"))
            fresh = graph._cut(better)
            near = graph._cut(near.join(fresh.select("node"), "node", "left_anti").unionByName(fresh))
        return near.select("node")

    return reached("n1", "n2").unionByName(reached("n2", "n1")).distinct()


def _extremities_of_parts(edges: DataFrame, lengths: DataFrame, least: int, part: str) -> DataFrame:
    e = edges.select(F.col(part).alias("_of"), "n1", "n2").where("n1 <> n2")
    ends = e.select("_of", F.col("n1").alias("node")).unionByName(e.select("_of", F.col("n2").alias("node"))).distinct()
    # a node's length is a row with itself
    own = ends.join(lengths.select("node", F.col("len").cast("double").alias("len")), "node").select("_of", F.col("node").alias("n1"), F.col("node").alias("n2"), "len")

    def solve(n1, n2, length):
        nodes, a, b = parts.coded(n1, n2)
        known = np.full(len(nodes), np.nan)
        loop = n1 == n2
        known[a[loop]] = length[loop]
        a, b = a[~loop], b[~loop]
        return {"node": nodes[parts.near_heads(a, b, known, least) | parts.near_heads(b, a, known, least)]}

    done, large = parts.solved(e.withColumn("len", F.lit(None).cast("double")).unionByName(own), "_of", solve, {"node": edges.schema["n1"].dataType.simpleString()})
    return done if large is None else done.unionByName(extremities(large, large.where("n1 = n2").select(F.col("n1").alias("node"), "len"), least))
