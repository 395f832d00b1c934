"""Strongly connected components and acyclic graphs of edges (n1, n2), by joins in rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import parts
from .graph import _labelled
from .lineage import cut

#: Nodes without an edge in or out are taken away for as long as at least one edge in so many goes with them.
TRIM_WHILE = 10
#: Nodes up to which a round sends them to every task; more are shuffled, and the edges with them.
BROADCAST_ROWS = 400_000


def _links(edges: DataFrame) -> DataFrame:
    return edges.select("n1", "n2").where("n1 is not null and n2 is not null and n1 <> n2").distinct()


def _nodes(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("n1").alias("node")).unionByName(edges.select(F.col("n2").alias("node"))).distinct()


def _ends(edges: DataFrame) -> DataFrame:
    """(node, outs, ins, low) of every node: its edges out and in, and the smallest node with an edge into it."""
    source = edges.select(F.col("n1").alias("node"), F.lit(1).alias("outs"), F.lit(0).alias("ins"), F.lit(None).cast(edges.schema["n1"].dataType).alias("low"))
    target = edges.select(F.col("n2").alias("node"), F.lit(0).alias("outs"), F.lit(1).alias("ins"), F.col("n1").alias("low"))
    return cut(source.unionByName(target).groupBy("node").agg(F.sum("outs").alias("outs"), F.sum("ins").alias("ins"), F.min("low").alias("low")))


def _trimmed(edges: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """The edges without those whose source has no edge in or whose target none out, again and again while that pays; their ends and number."""
    while True:
        ends = _ends(edges)
        n, gone = ends.agg(F.coalesce(F.sum("outs"), F.lit(0)), F.coalesce(F.sum(F.when((F.col("outs") == 0) | (F.col("ins") == 0), F.col("outs") + F.col("ins"))), F.lit(0))).first()
        if not n or gone * TRIM_WHILE < n:
            return edges, ends, n
        into, out = ends.where("ins > 0").select(F.col("node").alias("n1")), ends.where("outs > 0").select(F.col("node").alias("n2"))
        edges = cut(edges.join(into, "n1", "left_semi").join(out, "n2", "left_semi").select("n1", "n2"))


def _sent(nodes: DataFrame) -> DataFrame | None:
    """The nodes, sent to every task where they have been counted to be few, so that edges are only read; None if there are none."""
    n = nodes.count()
    return None if not n else F.broadcast(nodes) if n <= BROADCAST_ROWS else nodes


def coloured(edges: DataFrame, ends: DataFrame | None = None) -> DataFrame:
    """(node, colour, steps): the smallest node that leads to each node, itself too, and how many edges that takes at least.

    Only nodes whose colour has just changed send it on, the smallest one for each target; there are as many rounds as edges on
    the longest of the shortest ways.  A colour comes to a node by its shortest way first, so the round is its number of steps.
    The edges' ends tell the first round; the edges are read in each other one.
    """
    lower = F.coalesce(F.col("low") < F.col("node"), F.lit(False))
    told, steps = cut((_ends(edges) if ends is None else ends).select("node", F.least("node", "low").alias("colour"), lower.cast("int").alias("steps"), lower.alias("new"))), 1
    while (new := _sent(told.where("new").select("node", "colour"))) is not None:
        steps += 1
        sent = new.join(edges, F.col("node") == F.col("n1")).groupBy(F.col("n2").alias("node")).agg(F.min("colour").alias("sent"))
        better = F.coalesce(F.col("sent") < F.col("colour"), F.lit(False))
        told = cut(told.join(sent, "node", "left").select("node", F.least("colour", "sent").alias("colour"), F.when(better, steps).otherwise(F.col("steps")).alias("steps"), better.alias("new")))
    return told.select("node", "colour", "steps")


def _inside(edges: DataFrame, label: DataFrame, by: list[str], how: str = "inner") -> DataFrame:
    """edges with both ends' values of `by`, as by_1 and by_2."""
    side = lambda k: label.select(F.col("node").alias(f"n{k}"), *(F.col(c).alias(f"{c}_{k}") for c in by))
    return edges.join(side(1), "n1", how).join(side(2), "n2", how)


def _told(edges: DataFrame) -> DataFrame:
    """(n1, n2, inner, steps_1, steps_2) of edges with their ends' components and steps: inner ones have both ends in one component."""
    return edges.select("n1", "n2", F.coalesce(F.col("component_1") == F.col("component_2"), F.lit(False)).alias("inner"), "steps_1", "steps_2")


def _strong(edges: DataFrame) -> tuple[DataFrame | None, DataFrame | None]:
    """(node, component, steps) of every node on a cycle of the given links, and maybe of others, or None: the smallest node that it
    leads to and that leads to it, and how many edges it takes from there at least.  All ways between two nodes of a component
    lie in it, so these are the steps of the colour.  With it, where the first round finds all: the links as _told() tells them."""
    rest, found = edges, None
    while True:
        rest, ends, n = _trimmed(rest)
        if not n:
            return found, None
        colour = coloured(rest, ends)
        told = cut(_told(_inside(rest, colour.withColumnRenamed("colour", "component"), ["component", "steps"])))
        same = told.where("inner").select("n1", "n2")
        back = fresh = cut(colour.where("node = colour").select("node"))
        nodes = ends.count()
        while back.count() < nodes and (new := _sent(fresh)) is not None:
            before = new.join(same, F.col("node") == F.col("n2")).select(F.col("n1").alias("node")).distinct()
            fresh = cut(before.join(back, "node", "left_anti"))
            back = back.unionByName(fresh)
        back = cut(colour.join(back, "node", "left_semi").select("node", F.col("colour").alias("component"), "steps"))
        found = back if found is None else found.unionByName(back)
        if back.count() == nodes:
            return found, told if rest is edges else None
        gone = back.select("node")
        rest = cut(rest.join(gone.withColumnRenamed("node", "n1"), "n1", "left_anti").join(gone.withColumnRenamed("node", "n2"), "n2", "left_anti").select("n1", "n2"))


def strong_components(edges: DataFrame, part: str | None = None) -> DataFrame:
    """(node, component) of every node: the smallest node that it leads to and that leads to it.

    In rounds: nodes without an edge in or out are trimmed; every other node gets the colour of the smallest node that leads
    to it; edges between colours lie on no cycle, and the nodes of a colour that lead back to its node are a component.
    No component passes through one task, but those of small parts: edges may lie in parts that none of them joins, told by `part`.
    """
    if part is not None:
        return _labelled(edges, part, "component", None, parts.strong, strong_components)
    every, found = _nodes(edges.where("n1 is not null and n2 is not null")), _strong(cut(_links(edges)))[0]
    if found is None:
        return every.select("node", F.col("node").alias("component"))
    return every.join(found, "node", "left").select("node", F.coalesce("component", "node").alias("component"))


def _edges_of_parts(edges: DataFrame, part: str, small, rounds) -> DataFrame:
    """(n1, n2): the edges that small() picks of numbered ones where their part is small, and rounds() elsewhere."""
    e = edges.where("n1 is not null and n2 is not null and n1 <> n2")
    node = e.schema["n1"].dataType.simpleString()

    def solve(n1, n2):
        nodes, a, b = parts.coded(n1, n2)
        a, b = small(a, b, len(nodes))
        return {"n1": nodes[a], "n2": nodes[b]}

    done, large = parts.solved(e.select("n1", "n2", F.expr(part).alias("_of")), "_of", solve, {"n1": node, "n2": node})
    return done if large is None else done.unionByName(rounds(large))


def _inner(a, b, n):
    a, b = parts.distinct(a, b, n)
    label = parts.strong(a, b, n)
    same = label[a] == label[b]
    return a[same], b[same]


def on_cycles(edges: DataFrame, component: DataFrame | None = None, part: str | None = None) -> DataFrame:
    """Edges (n1, n2) inside a strongly connected component: exactly those that lie on a cycle, loops not counted."""
    if part is not None:
        return _edges_of_parts(edges, part, _inner, on_cycles)
    return _inside(_links(edges), strong_components(edges) if component is None else component, ["component"]).where("component_1 = component_2").select("n1", "n2")


def acyclic(edges: DataFrame, component: DataFrame | None = None, part: str | None = None) -> DataFrame:
    """(n1, n2): the edges less some of those on cycles, so that no cycle is left; edges between components all stay.

    Inside a component nodes are ranked: by how many edges lead there from its smallest node at least, then by how many more
    edges go out than come in, most first, then by node; edges to a smaller rank are cut.  Every node can still be reached from
    the component's smallest one.  Edges may lie in parts that none of them joins, told by `part`.
    """
    if part is not None:
        return _edges_of_parts(edges, part, parts.kept_acyclic, acyclic)
    e = cut(_links(edges))
    if component is None:
        label, told = _strong(e)
        if label is None:
            return e
    else:
        label, told = component.join(coloured(cut(on_cycles(e, component))).select("node", "steps"), "node"), None
    if told is None:
        told = cut(_told(_inside(e, label, ["component", "steps"], "left")))
    ends = told.where("inner").select(F.col("n1").alias("node"), F.lit(-1).alias("w")).unionByName(told.where("inner").select(F.col("n2").alias("node"), F.lit(1).alias("w")))
    more = cut(ends.groupBy("node").agg(F.sum("w").alias("more_in")))
    level = told.where("inner and steps_1 = steps_2").select("n1", "n2")
    level = _inside(level, more, ["more_in"]).where("struct(more_in_1, n1) < struct(more_in_2, n2)").select("n1", "n2")
    return told.where("not inner or steps_1 < steps_2").select("n1", "n2").unionByName(level)
