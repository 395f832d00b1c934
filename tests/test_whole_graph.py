"""Graph queries over all edges, against brute force on the smallest tables."""

import os
from collections import defaultdict

import pytest

from weftline.plans import bindings, catalog

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are not here")


@pytest.fixture(scope="module")
def edges(spark):
    paths = defaultdict(list)
    for r in bindings.steps(spark, SF).orderBy("path", "pos").collect():
        paths[r.path].append(r.node)
    return {e for x in paths.values() for e in zip(x, x[1:], strict=False)}


def test_components_of_all_edges(spark, edges):
    label = {n: n for e in edges for n in e}
    changed = True
    while changed:
        changed = False
        for u, v in edges:
            low = min(label[u], label[v])
            changed |= label[u] != low or label[v] != low
            label[u] = label[v] = low
    assert {r.node: r.component for r in catalog.queries()["components_whole"](spark, SF).collect()} == label


def test_levels_of_all_edges(spark, edges):
    left, nodes, want, level = set(edges), {n for e in edges for n in e}, {}, 0
    while free := nodes - {v for _, v in left}:
        want |= dict.fromkeys(free, level)
        nodes, left, level = nodes - free, {e for e in left if e[0] not in free}, level + 1
    want |= dict.fromkeys(nodes, -1)
    assert {r.node: r.level for r in catalog.queries()["topological_levels_whole"](spark, SF).collect()} == want


def test_chains_of_all_edges(spark, edges):
    outs, ins = defaultdict(set), defaultdict(set)
    for u, v in edges:
        if u != v:
            outs[u].add(v)
            ins[v].add(u)
    up = {v: u for v, us in ins.items() for u in us if len(us) == 1 and len(outs[u]) == 1}
    want = {}
    for n in set(outs) | set(ins):
        seen = [n]
        while seen[-1] in up and up[seen[-1]] not in seen:
            seen.append(up[seen[-1]])
        if seen[-1] in up:  # a ring: cut before its smallest node
            seen = seen[: seen.index(min(seen)) + 1]
        want[n] = (seen[-1], len(seen) - 1)
    assert {r.node: (r.head, r.rank) for r in catalog.queries()["chain_compression"](spark, SF).collect()} == want
