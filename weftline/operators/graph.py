"""Graph operators on edges (n1, n2)."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.sequences import common_subsequence, oriented
from . import parts
from .lineage import cut as _cut

MAX_ROUNDS = 200


def _labelled(edges: DataFrame, part: str, label: str, kind: str | None, small, rounds) -> DataFrame:
    """(node, label) of edges (n1, n2) that lie in parts: by small() where these are small, else by rounds()."""
    e = edges.where("n1 is not null and n2 is not null")
    node = e.schema["n1"].dataType.simpleString()

    def solve(n1, n2):
        nodes, a, b = parts.coded(n1, n2)
        got = small(a, b, len(nodes))
        return {"node": nodes, label: got if kind else nodes[got]}

    done, large = parts.solved(e.select("n1", "n2", F.expr(part).alias("_of")), "_of", solve, {"node": node, label: kind or node})
    return done if large is None else done.unionByName(rounds(large))


def components(edges: DataFrame, part: str | None = None) -> DataFrame:
    """(node, component): component is the smallest node reachable.  Edges may lie in parts that none of them joins, told by `part`.

    Edges contract to stars: in turn every node ties its larger neighbours to the smallest node it knows, and its smaller
    ones, with itself, to the smallest of these.  A node's links are pre-aggregated, never gathered, and rounds grow with the
    logarithm of the graph.
    """
    if part is not None:
        return _labelled(edges, part, "component", None, parts.component, components)
    ends = edges.select("n1", "n2").where("n1 is not null and n2 is not null")
    nodes = ends.select(F.col("n1").alias("node")).unionByName(ends.select(F.col("n2").alias("node"))).distinct()
    e = _cut(ends.select(F.greatest("n1", "n2").alias("a"), F.least("n1", "n2").alias("b")).where("a <> b").distinct())
    before = None
    for _ in range(MAX_ROUNDS):
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(down.select("a", F.col("m").alias("b")))
        e = _cut(small.where("a <> b").distinct())
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    return nodes.join(e.select(F.col("a").alias("node"), F.col("b").alias("low")), "node", "left").select("node", F.coalesce("low", "node").alias("component"))


def topological_levels(edges: DataFrame, part: str | None = None) -> DataFrame:
    """(node, level): nodes peeled in rounds from those without edges into them; nodes in or behind a cycle have level -1.

    There are as many rounds as levels, however many; each passes over what is left only.  Edges may lie in parts (components()).
    """
    if part is not None:
        return _labelled(edges, part, "level", "int", parts.levels, topological_levels)
    left = _cut(edges.select("n1", "n2").distinct())
    nodes = _cut(edges.select(F.col("n1").alias("node")).unionByName(edges.select(F.col("n2").alias("node"))).distinct())
    done, level = None, -1
    while True:
        level += 1
        into = left.select(F.col("n2").alias("node")).distinct()
        free = nodes.join(into, "node", "left_anti")
        got = free.withColumn("level", F.lit(level))
        if free.limit(1).count() == 0:
            rest = nodes.withColumn("level", F.lit(-1))
            return rest if done is None else done.unionByName(rest)
        done = _cut(got if done is None else done.unionByName(got))
        nodes, left = _cut(nodes.join(free, "node", "left_anti")), _cut(left.join(free.withColumnRenamed("node", "n1"), "n1", "left_anti"))


def has_cycle(edges: DataFrame) -> bool:
    return topological_levels(edges).where("level = -1").limit(1).count() > 0


def _by_degree(edges: DataFrame) -> DataFrame:
    """(lo, hi): each unordered edge from its end of lower degree to that of higher, the smaller node on ties.

    A node has at most sqrt(2 E) edges to ends of higher degree, so pairs of these grow far slower than those of a hub.
    """
    e = edges.select(F.least("n1", "n2").alias("x"), F.greatest("n1", "n2").alias("y")).where("x < y").distinct()
    degree = e.select(F.col("x").alias("node")).unionByName(e.select(F.col("y").alias("node"))).groupBy("node").count()
    j = e.join(degree.select(F.col("node").alias("x"), F.col("count").alias("dx")), "x").join(degree.select(F.col("node").alias("y"), F.col("count").alias("dy")), "y")
    low = (F.col("dx") < F.col("dy")) | (F.col("dx") == F.col("dy"))
    return j.select(F.when(low, F.col("x")).otherwise(F.col("y")).alias("lo"), F.when(low, F.col("y")).otherwise(F.col("x")).alias("hi"))


def triangles(edges: DataFrame) -> DataFrame:
    """(a, b, c), a < b < c: nodes of which every two are joined.  Wedges open at the node of lowest degree."""
    e = _by_degree(edges)
    wedge = e.select("lo", F.col("hi").alias("p")).join(e.select("lo", F.col("hi").alias("q")), "lo").where("p < q")
    third = e.select(F.least("lo", "hi").alias("p"), F.greatest("lo", "hi").alias("q"))
    x = wedge.join(third, ["p", "q"], "left_semi").select(F.sort_array(F.array("lo", "p", "q")).alias("x"))
    return x.select(F.col("x")[0].alias("a"), F.col("x")[1].alias("b"), F.col("x")[2].alias("c"))


def transitive_edges(edges: DataFrame) -> DataFrame:
    """Edges (n1, n2) that a path n1 -> m -> n2 makes redundant: those of a triangle of which the other two lead that way."""
    e = _cut(edges.select("n1", "n2").where("n1 <> n2").distinct())
    t = triangles(e)
    ways = [(x, y, z) for x, y, z in (("a", "b", "c"), ("a", "c", "b"), ("b", "a", "c"), ("b", "c", "a"), ("c", "a", "b"), ("c", "b", "a"))]
    asked = t.select(F.explode(F.array(*(F.struct(F.col(x).alias("n1"), F.col(m).alias("m"), F.col(y).alias("n2")) for x, m, y in ways))).alias("w")).select("w.*")
    found = asked.join(e, ["n1", "n2"], "left_semi").join(e.select("n1", F.col("n2").alias("m")), ["n1", "m"], "left_semi").join(e.select(F.col("n1").alias("m"), "n2"), ["m", "n2"], "left_semi")
    return found.select("n1", "n2").distinct()


def branch_check(edges: DataFrame) -> DataFrame:
    """(n1, n2) to discard: at a node with over two edges into it, if some come from a triangle with it or from a node
    without other edges out, all others."""
    e = edges.select("n1", "n2").where("n1 <> n2").distinct()
    ins = e.groupBy("n2").agg(F.count("*").alias("ins")).where("ins > 2").select("n2")
    outs = e.groupBy("n1").agg(F.count("*").alias("outs"))
    near = e.join(ins, "n2", "left_semi").join(outs, "n1")
    corners = [F.struct(F.col(v).alias("n2"), F.col(x).alias("x"), F.col(y).alias("y")) for v, x, y in (("a", "b", "c"), ("b", "a", "c"), ("c", "a", "b"))]
    t = triangles(e).select(F.explode(F.array(*corners)).alias("t")).select("t.*").join(ins, "n2", "left_semi")
    t = t.join(e.select("n2", F.col("n1").alias("x")), ["n2", "x"], "left_semi").join(e.select("n2", F.col("n1").alias("y")), ["n2", "y"], "left_semi")
    cliques = t.select("n2", F.explode(F.array("x", "y")).alias("n1")).distinct()
    kept = near.join(cliques.withColumn("in_clique", F.lit(True)), ["n1", "n2"], "left").withColumn("good", F.coalesce("in_clique", F.lit(False)) | (F.col("outs") == 1))
    some = F.max("good").over(Window.partitionBy("n2"))
    return kept.withColumn("some", some).where("some and not good").select("n1", "n2")


def duplicate_siblings(edges: DataFrame, segments: DataFrame) -> DataFrame:
    """(n1, seq, nodes): successors of one node that spell the same."""
    j = edges.select("n1", "n2").distinct().join(segments.select(F.col("node").alias("n2"), "seq"), "n2")
    return j.groupBy("n1", "seq").agg(F.count("*").alias("nodes")).where("nodes > 1")


def chains(edges: DataFrame) -> DataFrame:
    """(node, head, rank): maximal runs of nodes joined by an edge that is the only one out of its source and into its target.

    Pointers to the chain's head double their reach each round.  A ring of such edges has no head and is cut before its smallest node.
    """
    e = edges.select("n1", "n2").where("n1 <> n2").distinct()
    simple = e.join(e.groupBy("n1").count().where("count = 1").select("n1"), "n1", "left_semi").join(e.groupBy("n2").count().where("count = 1").select("n2"), "n2", "left_semi")
    nodes = e.select(F.col("n1").alias("node")).unionByName(e.select(F.col("n2").alias("node"))).distinct()
    return nodes.join(linked_chains(simple), "node", "left").select("node", F.coalesce("head", "node").alias("head"), F.coalesce("rank", F.lit(0)).cast("long").alias("rank"))


def linked_chains(simple: DataFrame, part: str | None = None) -> DataFrame:
    """(node, head, rank) of the nodes of links (n1, n2) of which each node has one out and one in at most; they may lie in parts."""
    if part is not None:
        node = simple.schema["n1"].dataType.simpleString()

        def solve(n1, n2):
            nodes, a, b = parts.coded(n1, n2)
            head, rank = parts.on_chain(a, b, len(nodes))
            return {"node": nodes, "head": nodes[head], "rank": rank}

        done, large = parts.solved(simple.select("n1", "n2", F.expr(part).alias("_of")), "_of", solve, {"node": node, "head": node, "rank": "bigint"})
        return done if large is None else done.unionByName(linked_chains(large))
    nodes = simple.select(F.col("n1").alias("node")).unionByName(simple.select(F.col("n2").alias("node"))).distinct()
    label = _cut(components(simple))
    size = label.groupBy("component").agg(F.count("*").alias("size"))
    links = label.join(simple.withColumnRenamed("n1", "node"), "node").groupBy("component").agg(F.count("*").alias("links"))
    ring = size.join(links, "component").where("size = links").select(F.col("component").alias("n2"))
    simple = simple.join(ring, "n2", "left_anti")
    up = _cut(nodes.join(simple.select(F.col("n2").alias("node"), F.col("n1").alias("up")), "node", "left").select("node", F.coalesce("up", "node").alias("head"), F.col("up").isNotNull().cast("long").alias("rank")))
    for _ in range(MAX_ROUNDS):
        far = up.select(F.col("node").alias("_n"), F.col("head").alias("_h"), F.col("rank").alias("_r"))
        new = _cut(up.join(far, F.col("head") == F.col("_n")).select("node", F.col("_h").alias("head"), (F.col("rank") + F.col("_r")).alias("rank")))
        if new.agg(F.sum("rank")).first() == up.agg(F.sum("rank")).first():
            return new
        up = new
    raise RuntimeError("chains did not settle")


def neighbourhood(edges: DataFrame, start: DataFrame, hops: int) -> DataFrame:
    """(node, hop): nodes within so many edges of the start, either way."""
    both = edges.select("n1", "n2").unionByName(edges.select(F.col("n2").alias("n1"), F.col("n1").alias("n2"))).distinct()
    seen = start.select("node").distinct().withColumn("hop", F.lit(0))
    for h in range(1, hops + 1):
        step = seen.where(F.col("hop") == h - 1).join(both, F.col("node") == F.col("n1")).select(F.col("n2").alias("node")).distinct()
        seen = _cut(seen.unionByName(step.join(seen, "node", "left_anti").withColumn("hop", F.lit(h))))
    return seen


def simple_edges(edges: DataFrame) -> DataFrame:
    """Oriented edges (n1, o1, n2, o2) along which two nodes are one: the only one out of n1 and into n2, and in line with the
    simple edge into n1, which must enter it with the sign that this one leaves it with."""
    e = edges.select("n1", "o1", "n2", "o2").where("n1 <> n2").distinct()
    outs, ins = e.groupBy("n1").agg(F.count("*").alias("outs")), e.groupBy("n2").agg(F.count("*").alias("ins"))
    one = e.join(outs, "n1").join(ins, "n2").where("outs = 1 and ins = 1").select("n1", "o1", "n2", "o2")
    before = one.select(F.col("n2").alias("n1"), F.col("o2").alias("entered"))
    return one.join(before, "n1", "left").where("entered is null or entered = o1").select("n1", "o1", "n2", "o2")


def placed_on_chains(edges: DataFrame, part: str | None = None) -> DataFrame:
    """(node, head, rank, ori): each node's chain of simple_edges(), its place there from 0, and the sign with which the chain reads it.

    A `part` that edges may lie in is an expression on n1.
    """
    simple = _cut(simple_edges(edges))
    every = edges.select(F.col("n1").alias("node")).unionByName(edges.select(F.col("n2").alias("node"))).distinct()
    placed = every.join(linked_chains(simple.select("n1", "n2"), part), "node", "left").select("node", F.coalesce("head", "node").alias("head"), F.coalesce("rank", F.lit(0)).alias("rank"))
    entered, left = simple.select(F.col("n2").alias("node"), F.col("o2").alias("in_sign")), simple.select(F.col("n1").alias("node"), F.col("o1").alias("out_sign"))
    sign = F.when(F.col("rank") > 0, F.col("in_sign")).otherwise(F.coalesce("out_sign", F.lit("+")))
    return placed.join(entered, "node", "left").join(left, "node", "left").select("node", "head", "rank", sign.alias("ori"))


def merged_chains(edges: DataFrame, segments: DataFrame, abundance: DataFrame, steps: DataFrame, part: str | None = None) -> DataFrame:
    """(head, nodes, len, seq, abundance, paths): maximal chains of simple_edges() as one node each, of oriented edges
    (n1, o1, n2, o2), segments (node, len, seq), abundance (node, abundance) and steps (path, node).

    Sequences are joined as the chain reads them, abundances weighted by length, and the number of paths through any of the
    nodes is that of their union.  Nodes without a simple edge are chains of one.
    """
    placed = _cut(placed_on_chains(edges, part))
    j = placed.join(segments.select("node", "len", "seq"), "node").join(abundance, "node", "left")
    part = F.struct("rank", oriented(F.col("seq"), F.col("ori")).alias("s"))
    out = j.groupBy("head").agg(F.count("*").alias("nodes"), F.sum("len").alias("len"), F.array_sort(F.collect_list(part)).alias("parts"), (F.sum(F.coalesce("abundance", F.lit(0.0)) * F.col("len")) / F.sum("len")).alias("abundance"))
    through = steps.select("node", "path").distinct().join(placed.select("node", "head"), "node").groupBy("head").agg(F.count_distinct("path").alias("paths"))
    seq = F.array_join(F.transform("parts", lambda x: x["s"]), "")
    return out.join(through, "head", "left").select("head", "nodes", "len", seq.alias("seq"), "abundance", F.coalesce("paths", F.lit(0)).cast("long").alias("paths"))


def _on_chain(node_sign: Column, chain_sign: Column) -> Column:
    return F.when(node_sign == chain_sign, "+").otherwise("-")


def rewritten_steps(steps: DataFrame, placed: DataFrame) -> DataFrame:
    """(path, pos, node, ori, first, last): steps (path, pos, node, ori) over the merged nodes of placed_on_chains().

    Steps that follow a chain, forwards or turned, become one step on its head; a chain that is entered anew, turned about or
    left and met again is a step of its own, and no path is cut short.  first and last are the ranks between which the chain is
    read, for paths that begin or end inside it.  Nodes that are on no chain stay as they are.
    """
    w = Window.partitionBy("path").orderBy("pos")
    j = steps.select("path", "pos", "node", "ori").join(placed.withColumnRenamed("ori", "sign"), "node", "left")
    j = j.select("path", "pos", F.coalesce("head", "node").alias("head"), F.coalesce("rank", F.lit(0)).alias("rank"), _on_chain(F.col("ori"), F.coalesce("sign", F.lit("+"))).alias("ori"))
    before = F.lag(F.struct("head", "ori", (F.col("rank") + F.when(F.col("ori") == "+", 1).otherwise(-1)).alias("rank"))).over(w)
    j = j.withColumn("new", (~before.eqNullSafe(F.struct("head", "ori", "rank"))).cast("int")).withColumn("nth", F.sum("new").over(w))
    out = j.groupBy("path", "nth").agg(F.first("head").alias("node"), F.first("ori").alias("ori"), F.min("rank").alias("first"), F.max("rank").alias("last"))
    return out.select("path", F.col("nth").cast("int").alias("pos"), "node", "ori", "first", "last")


def rewritten_edges(edges: DataFrame, placed: DataFrame) -> DataFrame:
    """(n1, o1, n2, o2): oriented edges between the merged nodes; those along a chain, either way, are gone."""
    side = lambda k: placed.select(F.col("node").alias(f"n{k}"), F.col("head").alias(f"h{k}"), F.col("rank").alias(f"r{k}"), F.col("ori").alias(f"s{k}"))
    j = edges.select("n1", "o1", "n2", "o2").distinct().join(side(1), "n1").join(side(2), "n2")
    a, b = _on_chain(F.col("o1"), F.col("s1")), _on_chain(F.col("o2"), F.col("s2"))
    along = (F.col("h1") == F.col("h2")) & (a == b) & (F.col("r2") - F.col("r1") == F.when(a == "+", 1).otherwise(-1))
    return j.where(~along).select(F.col("h1").alias("n1"), a.alias("o1"), F.col("h2").alias("n2"), b.alias("o2")).distinct()


def first_choice(ranks: DataFrame, edges: DataFrame, part: str | None = None) -> DataFrame:
    """(node): what a walk through the nodes in order of `rank` (node, rank; unique) keeps when it passes over those joined to a kept one.

    In rounds: a node that comes before all its neighbours still open is kept, and they are passed over; that is the same choice
    as one by one, and rounds grow with the logarithm of the nodes when ranks are in no order.  Nodes may lie in parts that no edge
    joins, told by a column of ranks.
    """
    if part is not None:
        return _first_in_parts(ranks, edges, part)
    e = edges.select("n1", "n2").unionByName(edges.select(F.col("n2").alias("n1"), F.col("n1").alias("n2"))).where("n1 <> n2").distinct()
    open_, kept = _cut(ranks.select("node", "rank")), None
    e = _cut(e)
    while open_.limit(1).count():
        ahead = e.join(open_.select(F.col("node").alias("n2"), F.col("rank").alias("other")), "n2").groupBy("n1").agg(F.min("other").alias("least"))
        now = _cut(open_.join(ahead, open_.node == ahead.n1, "left").where("least is null or rank < least").select("node"))
        kept = now if kept is None else kept.unionByName(now)
        passed = e.join(now.withColumnRenamed("node", "n1"), "n1", "left_semi").select(F.col("n2").alias("node")).unionByName(now)
        open_ = _cut(open_.join(passed.distinct(), "node", "left_anti"))
    return ranks.select("node").where("false") if kept is None else kept


def _first_in_parts(ranks: DataFrame, edges: DataFrame, part: str) -> DataFrame:
    numbered = ranks.select("node", part, F.row_number().over(Window.partitionBy(part).orderBy("rank")).cast("long").alias("rank"))
    side = lambda k: numbered.select(F.col("node").alias(f"n{k}"), F.col("rank").alias(f"r{k}"))
    e = edges.select("n1", "n2").where("n1 <> n2").join(side(1), "n1").join(side(2), "n2")
    # a node is a row with itself, so that one without edges is told as well
    rows = e.join(numbered.select(F.col("node").alias("n1"), F.col(part).alias("_of")), "n1").unionByName(numbered.select(F.col("node").alias("n1"), F.col("node").alias("n2"), F.col("rank").alias("r1"), F.col("rank").alias("r2"), F.col(part).alias("_of")))

    def solve(n1, n2, r1, r2):
        nodes, a, b = parts.coded(n1, n2)
        rank = np.empty(len(nodes), np.int64)
        rank[a], rank[b] = r1, r2
        a, b = a[n1 != n2], b[n1 != n2]
        return {"node": nodes[parts.chosen_first(rank, np.concatenate([a, b]), np.concatenate([b, a]))]}

    done, large = parts.solved(rows.select("n1", "n2", "r1", "r2", "_of"), "_of", solve, {"node": ranks.schema["node"].dataType.simpleString()})
    return done if large is None else done.unionByName(first_choice(large.where("n1 = n2").select(F.col("n1").alias("node"), F.col("r1").alias("rank")), large))


def merged_siblings(edges: DataFrame, segments: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(edges, names): successors of one node that spell the same become the smallest of them; names are (node, kept) of those that go."""
    twins = edges.select("n1", "n2").distinct().join(segments.select(F.col("node").alias("n2"), "seq"), "n2")
    first = twins.groupBy("n1", "seq").agg(F.min("n2").alias("kept"), F.count("*").alias("n")).where("n > 1")
    ties = twins.join(first, ["n1", "seq"]).select(F.col("n2"), F.col("kept").alias("n1")).where("n1 <> n2")
    names = components(ties).where("node <> component").select("node", F.col("component").alias("kept"))
    one, two = names.select(F.col("node").alias("n1"), F.col("kept").alias("k1")), names.select(F.col("node").alias("n2"), F.col("kept").alias("k2"))
    out = edges.select("n1", "n2").join(one, "n1", "left").join(two, "n2", "left").select(F.coalesce("k1", "n1").alias("n1"), F.coalesce("k2", "n2").alias("n2"))
    return out.distinct(), names


def within_bases(edges: DataFrame, lengths: DataFrame, start: DataFrame, radius: int) -> DataFrame:
    """(node, distance): nodes at most `radius` bases from a start node, either way; the way counts the lengths of the nodes between."""
    both = _cut(edges.select("n1", "n2").unionByName(edges.select(F.col("n2").alias("n1"), F.col("n1").alias("n2"))).where("n1 <> n2").distinct())
    length = lengths.select("node", F.col("len").cast("long").alias("len"))
    near = _cut(start.select("node").distinct().withColumn("distance", F.lit(0).cast("long")).withColumn("len", F.lit(0).cast("long")))
    fresh = near
    while fresh.limit(1).count():  # a node comes again only at less distance
        step = fresh.join(both, F.col("node") == F.col("n1")).groupBy(F.col("n2").alias("node")).agg(F.min(F.col("distance") + F.col("len")).alias("new")).where(F.col("new") <= radius)
        better = step.join(near.select("node", "distance"), "node", "left").where("distance is null or new < distance").select("node", F.col("new").alias("distance"))
        fresh = _cut(better.join(length, "node"))
        near = _cut(near.join(fresh.select("node"), "node", "left_anti").unionByName(fresh))
    return near.select("node", "distance")


def reached(edges: DataFrame, start: DataFrame) -> DataFrame:
    """(start, node): every node that a start node leads to along edges, itself too; a pair is followed up once."""
    e = _cut(edges.select("n1", "n2").distinct())
    seen = fresh = _cut(start.select(F.col("node").alias("start"), "node").distinct())
    while fresh.limit(1).count():
        step = fresh.join(e, F.col("node") == F.col("n1")).select("start", F.col("n2").alias("node")).distinct()
        fresh = _cut(step.join(seen, ["start", "node"], "left_anti"))
        seen = _cut(seen.unionByName(fresh))
    return seen


def parallel_nodes(edges: DataFrame, segments: DataFrame) -> DataFrame:
    """(n1, a, b, score), a < b: successors of one node whose longest common subsequence is over half of the longer one.

    Successors are compared by pairs, of one node's only; a node's successors are the branches of a bubble.
    """
    j = edges.select("n1", "n2").where("n1 <> n2").distinct().join(segments.select(F.col("node").alias("n2"), "seq"), "n2")
    pairs = j.select("n1", F.col("n2").alias("a"), F.col("seq").alias("sa")).join(j.select("n1", F.col("n2").alias("b"), F.col("seq").alias("sb")), "n1").where("a < b")
    scored = pairs.withColumn("score", common_subsequence(F.col("sa"), F.col("sb")))
    return scored.where(F.col("score") * 2 > F.greatest(F.length("sa"), F.length("sb"))).select("n1", "a", "b", "score")
