"""Cycles are broken over all edges, under the labels of those very edges."""

import os
from collections import defaultdict

import pytest

from weftline.plans import bindings, catalog

SF = "/root/testdata/sf0.001"


def _query(spark, monkeypatch, edges):
    paths = [(i, p, n, "A") for i, e in enumerate(edges) for p, n in enumerate(e)]
    steps = spark.createDataFrame(paths, "path long, pos int, node long, kind string").selectExpr("*", "'+' as ori", "1.0 as aligned")
    monkeypatch.setattr(bindings, "steps", lambda *_: steps)
    monkeypatch.setattr(bindings, "segments", lambda *_: steps.select("node").distinct())
    return [(r.n1, r.n2) for r in catalog.queries()["broken_cycles"](spark, "").collect()]


def test_cycle_broken_and_other_edges_kept(spark, monkeypatch):
    ring, other = [(9, 2), (2, 5), (5, 9)], [(1, 9), (5, 7), (7, 8), (30, 20), (20, 10)]
    kept = _query(spark, monkeypatch, ring + other)
    assert sorted(e for e in kept if e in other) == sorted(other)
    assert len(kept) == len(set(kept)) == len(ring) + len(other) - 1


@pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are not here")
def test_no_cycle_left_and_nothing_lost_for_no_cycle(spark):
    paths = defaultdict(list)
    for r in bindings.steps(spark, SF).orderBy("path", "pos").collect():
        paths[r.path].append(r.node)
    edges = {(u, v) for x in paths.values() for u, v in zip(x, x[1:], strict=False) if u != v}
    got = catalog.queries()["broken_cycles"](spark, SF).select("n1", "n2").collect()
    kept = {tuple(r) for r in got}
    assert len(kept) == len(got) and kept <= edges
    out, into = defaultdict(set), defaultdict(int)
    for u, v in kept:
        out[u].add(v)
        into[v] += 1
    free, done = [u for u in out if not into[u]], 0
    while free:
        u = free.pop()
        for v in out[u]:
            done += 1
            into[v] -= 1
            if not into[v]:
                free.append(v)
    assert done == len(kept)  # every edge is peeled: no cycle
    outgoing = defaultdict(set)
    for u, v in edges:
        outgoing[u].add(v)
    for u, v in edges - kept:  # each dropped edge lies on a cycle of the graph as given
        seen, stack = {v}, [v]
        while stack and u not in seen:
            new = outgoing[stack.pop()] - seen
            seen |= new
            stack += new
        assert u in seen
