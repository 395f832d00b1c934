"""Components, acyclic graphs, exact flows, peeled paths and the ladder against slow versions on random graphs."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from weftline.operators import cycles, graph, haplotypes, solve

R = random.Random(8)


def _closure(edges):
    out = {}
    for u, v in edges:
        out.setdefault(u, set()).add(v)
    reach = {}
    for u in {x for e in edges for x in e}:
        seen, stack = set(), [u]
        while stack:
            for v in out.get(stack.pop(), ()):
                if v not in seen:
                    seen.add(v)
                    stack.append(v)
        reach[u] = seen
    return reach


def _graphs():
    """Several random graphs side by side, nodes apart, and a ring, a loop and a chain."""
    edges = []
    for k in range(8):
        n = R.randint(2, 14)
        edges += [(100 * k + R.randrange(n), 100 * k + R.randrange(n)) for _ in range(R.randint(1, 3 * n))]
    return [*edges, (901, 902), (902, 903), (903, 901), (903, 910), (910, 911), (920, 920), (911, 920)]


def test_components_and_acyclic(spark):
    edges = _graphs()
    e = spark.createDataFrame([*edges, *edges[:3], (None, 5), (6, None)], "n1 long, n2 long")
    reach = _closure(edges)
    want = {u: min([v for v in reach[u] if u in reach[v]] + [u]) for u in reach}
    assert {r.node: r.component for r in cycles.strong_components(e).collect()} == want
    links = {x for x in edges if x[0] != x[1]}
    inner = {(u, v) for u, v in links if want[u] == want[v]}
    assert {tuple(r) for r in cycles.on_cycles(e).collect()} == inner
    got = [tuple(r) for r in cycles.acyclic(e).collect()]
    kept = set(got)
    assert len(kept) == len(got) and kept <= links and links - kept <= inner
    again = _closure(kept)
    assert all(u not in again[u] for u in again)
    for c in set(want.values()):  # every node can still be reached from its component's smallest
        assert {u for u in want if want[u] == c} - {c} <= again.get(c, set())
    assert cycles.acyclic(e.limit(0)).collect() == [] and cycles.strong_components(e.limit(0)).collect() == []


def test_acyclic_plan_has_no_group_in_one_task(spark):
    e = spark.createDataFrame(_graphs(), "n1 long, n2 long")
    plan = cycles.acyclic(e)._jdf.queryExecution().executedPlan().toString()
    assert "Pandas" not in plan and "Arrow" not in plan and "Window" not in plan


def test_first_choice_equals_a_walk(spark):
    nodes = list(range(80))
    rank = {n: R.random() for n in nodes}
    edges = [(R.randrange(80), R.randrange(80)) for _ in range(150)]
    kept = set()
    for n in sorted(nodes, key=rank.get):
        if not any(a != b and (a == n and b in kept or b == n and a in kept) for a, b in edges):
            kept.add(n)
    got = graph.first_choice(spark.createDataFrame([(n, rank[n]) for n in nodes], "node long, rank double"), spark.createDataFrame(edges, "n1 long, n2 long"))
    assert sorted(r.node for r in got.collect()) == sorted(kept)


def _slow_greedy(edges, least, mode, loose):
    flow = {(u, v): f for u, v, f in edges}
    sources, sinks = {u for u, _ in flow} - {v for _, v in flow}, {v for _, v in flow} - {u for u, _ in flow}
    if mode != "hops":
        flow |= {e: max(flow.values()) for e in flow if e in loose}
    out = []
    while True:
        paths, stack = [], [(s,) for s in sources]
        while stack:
            p = stack.pop()
            if p[-1] in sinks:
                paths.append(p)
            stack += [(*p, v) for u, v in flow if u == p[-1]]
        if not paths:
            return out
        cost = lambda p: sum({"most": -flow[e], "least": flow[e], "hops": 1.0}[mode] for e in zip(p, p[1:]))  # noqa: B023, E731
        best = min(map(cost, paths))
        path = min(p for p in paths if cost(p) == best)
        low = min(flow[e] for e in zip(path, path[1:]))
        for e in zip(path, path[1:]):
            flow[e] -= low
            if flow[e] < max(1, least):
                del flow[e]
        if low >= least:
            out.append((path, low))


@pytest.mark.parametrize("mode", ["most", "least", "hops"])
def test_greedy_paths_run_from_source_to_sink(mode):
    for _ in range(100):
        n = R.randint(2, 8)
        edges = sorted({(u, v): float(R.randint(1, 9)) for u, v in ((R.randrange(n), R.randrange(n)) for _ in range(14)) if u < v}.items()) or [((0, 1), 3.0)]
        edges = [(u, v, f) for (u, v), f in edges]
        loose = {(u, v) for u, v, _ in edges if R.random() < 0.3}
        got = solve.greedy_paths(edges, 2, mode, loose)
        assert [p for _, p in got] == [p for _, p in _slow_greedy(edges, 2, mode, loose)]
        sources, sinks = {u for u, *_ in edges} - {v for _, v, _ in edges}, {v for _, v, _ in edges} - {u for u, *_ in edges}
        assert all(p[0] in sources and p[-1] in sinks for p, _ in got)
    assert solve.greedy_paths([(1, 2, 5.0), (2, 3, 3.0)], 1) == [((1, 2, 3), 3.0)]
    with pytest.raises(ValueError):
        solve.greedy_paths([(1, 2, 5.0), (2, 1, 3.0)], 1)


def test_all_modes(spark):
    rows = [("g", 0, 1, 5.0, False), ("g", 1, 3, 2.0, False), ("g", 0, 2, 3.0, False), ("g", 2, 3, 3.0, True)]
    got = haplotypes.peeled(spark.createDataFrame(rows, "sample string, n1 long, n2 long, flow double, loose boolean"), "sample", 1, "all").orderBy("nth").collect()
    assert [(r.nodes, r.abundance) for r in got] == [("0,2,3", 3.0), ("0,1,3", 2.0)]


def test_flow_is_the_best_of_all_vertices():
    """Against every basis of the linear programme on small graphs, with prices that prove it."""
    r = np.random.default_rng(3)
    for _ in range(40):
        edges = sorted({(0, 2), (2, 1), *((int(u), int(v)) for u, v in r.integers(2, 5, (4, 2)) if u < v), *((0, int(v)) for v in r.integers(2, 5, 2)), *((int(v), 1) for v in r.integers(2, 5, 2))})
        nodes = [(float(r.integers(0, 9)), [(int(e), float(r.choice([1, 1, -1]))) for e in r.choice(len(edges), 2, replace=False)]) for _ in range(3)]
        x, y, z = solve.flow_fit(nodes, edges)
        a = np.zeros((3, len(edges)))
        for i, (_, terms) in enumerate(nodes):
            for e, w in terms:
                a[i, e] += w
        b = np.array([v for v, _ in nodes])
        c = np.array([[(v == n) - (u == n) for u, v in edges] for n in sorted(z)], float)
        whole, rhs = np.block([[a, np.eye(3), -np.eye(3)], [c, np.zeros((len(c), 6))]]), np.r_[b, np.zeros(len(c))]
        rank, best = np.linalg.matrix_rank(whole), np.inf
        for cols in itertools.combinations(range(whole.shape[1]), rank):
            s, *_ = np.linalg.lstsq(whole[:, cols], rhs, rcond=None)
            if (s > -1e-9).all() and np.abs(whole[:, cols] @ s - rhs).max() < 1e-7:
                full = np.zeros(whole.shape[1])
                full[list(cols)] = s
                best = min(best, full[len(edges) :].sum())
        value = np.abs(a @ x - b).sum()
        assert abs(value - best) < 1e-6 and np.abs(c @ x).max() < 1e-9 and (x >= 0).all()
        assert np.abs(y).max() <= 1 + 1e-9 and (a.T @ y + c.T @ np.array([z[n] for n in sorted(z)]) < 1e-7).all() and abs(b @ y - value) < 1e-6


def test_fits_drop_paths_in_their_second_phase():
    a = np.array([[1.0, 0, 1], [0, 1, 1], [1, 0, 0], [0, 1, 0]])
    b = np.array([10.0, 0.5, 10, 0.5])
    for kind in (1, 2, 3, 4, 5):
        one, two = solve.fit(a, b, kind, 0.0), solve.fit(a, b, kind, 1.0)
        assert one[1] > 0.4 and two[1] == 0 and two[0] > 9


def test_ladder_goes_on_after_the_first_round(spark):
    """Round 1 finds a strain in every group; the second chooses anew, and the third comes only where it finds none."""
    rows = [("g", 0, n, a) for n, a in ((1, 30.0), (3, 40.0))] + [("g", 1, n, a) for n, a in ((2, 10.0), (3, 40.0))] + [("weak", 0, 1, 0.05)]
    m = spark.createDataFrame(rows, "sample string, path long, node long, abundance double")
    depth = spark.createDataFrame([("g", 26.7), ("weak", 0.05)], "sample string, depth double")
    got = {(r.sample, r.path): (round(r.abundance, 6), r.round) for r in haplotypes.ladder(m, depth, "sample").collect()}
    assert got == {("g", 0): (30.0, 2), ("g", 1): (10.0, 2), ("weak", 0): (0.05, 3)}
    strict = spark.createDataFrame([("g", 230.0), ("weak", 0.05)], "sample string, depth double")  # rounded to 12, not 11.5
    got = {(r.sample, r.path): r.round for r in haplotypes.ladder(m, strict, "sample").collect()}
    assert got[("g", 0)] == 2 and ("g", 1) not in got


def test_ranked_edges_have_no_cycle(spark):
    edges = [(k, u, v) for k in "ab" for u, v in _graphs()]
    got = haplotypes.ranked(spark.createDataFrame(edges, "sample string, n1 long, n2 long").withColumn("flow", F.lit(1.0)), "sample").collect()
    for k in "ab":
        kept = [(r.n1, r.n2) for r in got if r.sample == k]
        again = _closure(kept)
        assert kept and all(u not in again[u] for u in again)
        for _, u, v in (x for x in edges if x[0] == k and x[1:] not in kept):  # what is gone closes a cycle with what stays
            assert u == v or u in again[v]


def _all_paths(nodes, edges):
    sources, sinks = nodes - {v for _, v in edges}, nodes - {u for u, _ in edges}
    out, stack = [], [(s,) for s in sorted(sources)]
    while stack:
        p = stack.pop()
        if p[-1] in sinks:
            out.append(p)
        stack += [(*p, v) for u, v in edges if u == p[-1]]
    return out


@pytest.mark.parametrize("most, kind", [(1, 1), (2, 2), (3, 2), (2, 3)])
def test_strains_equal_the_best_of_all_paths(most, kind):
    for _ in range(25):
        n = R.randint(1, 7)
        edges = sorted({(u, v) for u, v in ((R.randrange(n), R.randrange(n)) for _ in range(9)) if u < v})
        nodes = {v: float(R.choice([0, 1, 3, 5, 8, 13, 20])) for v in range(n)}
        told = [v for v in nodes if nodes[v] > 0]
        value = lambda found: sum(abs(nodes[v] - sum(f for p, f in found if v in p)) / {1: 1, 2: nodes[v], 3: nodes[v] ** 0.5}[kind] for v in told)  # noqa: B023, E731
        paths, best = _all_paths(set(nodes), edges), value([])
        b = np.array([nodes[v] for v in told])
        w = {1: np.ones(len(b)), 2: 1 / np.maximum(b, 1e-9), 3: 1 / np.sqrt(np.maximum(b, 1e-9))}[kind]
        for k in range(1, most + 1):
            for some in itertools.combinations(paths, k):
                a = np.array([[float(v in p) for p in some] for v in told]).reshape(len(told), k)
                best = min(best, solve.least_weighted(a, b, w)[3])
        got = solve.strains(nodes, edges, most, kind)
        assert len(got) <= most and {p for p, _ in got} <= set(paths) and abs(value(got) - best) < 1e-6


def test_acyclic_stores_all_links_twice_only_and_sends_few_nodes(spark, monkeypatch):
    nodes = list(range(40))
    edges = {(u, (u + 1) % 40) for u in nodes} | {(R.choice(nodes), R.choice(nodes)) for _ in range(60)}
    e, stored, plans = spark.createDataFrame(list(edges), "n1 long, n2 long"), [], []

    def cut(df):
        stored.append(df.columns)
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return keep(df)

    keep = cycles.cut
    monkeypatch.setattr(cycles, "cut", cut)
    got = sorted(map(tuple, cycles.acyclic(e).collect()))
    assert sum({"n1", "n2"} <= set(c) for c in stored) == 2  # the links, and these with their ends' components
    assert not any("min(struct" in p for p in plans)  # which Spark aggregates by sorting all that is sent
    monkeypatch.setattr(cycles, "BROADCAST_ROWS", 0)
    assert sorted(map(tuple, cycles.acyclic(e).collect())) == got
    steps, front = {0: 0}, [0]
    for u in front:
        for v in sorted(v for x, v in edges if x == u and v not in steps):
            steps[v] = steps[u] + 1
            front.append(v)
    links = {x for x in edges if x[0] != x[1]}
    rank = {u: (steps[u], sum(v == u for _, v in links) - sum(v == u for v, _ in links), u) for u in nodes}
    assert got == sorted((u, v) for u, v in links if rank[u] < rank[v])
