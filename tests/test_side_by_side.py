"""Searches that share their work: sets told once, programmes solved beside each other."""

import numpy as np
import pyarrow as pa
import pytest

from weftline.operators import haplotypes, solve


def _graph(r, n):
    edges = [(i, j) for i in range(n) for j in range(i + 1, min(n, i + 4)) if r.random() < 0.6]
    return {i: float(r.integers(0, 40)) for i in range(n)}, edges


def test_programmes_side_by_side_are_exact():
    r = np.random.default_rng(11)
    made = []
    for k, m in ((1, 1), (3, 5), (8, 2), (12, 9), (5, 0), (20, 30), (0, 3)):
        a, b = (r.random((k, m)) < 0.4).astype(float), r.integers(1, 60, k).astype(float)
        made.append((a, b, 1 / np.maximum(b, 1)))
    given = [solve._Weighted(b, w, list(a.T)) for a, b, w in made]
    for p, (x, value), (a, b, w) in zip(given, solve.explained(given), made, strict=True):
        want = solve.least_weighted(a, b, w)[3] if len(b) else 0.0
        assert value == pytest.approx(want) and (x >= 0).all()
        assert (np.abs(p.y) <= w + 1e-9).all() and (a.T @ p.y <= 1e-9).all() and b @ p.y == pytest.approx(want)
    p = given[3]
    p.add(np.ones(12))
    (x, value), (a, b, w) = solve.explained([p])[0], made[3]
    assert value == pytest.approx(solve.least_weighted(np.column_stack([a, np.ones(12)]), b, w)[3])


def test_searches_do_not_depend_on_each_other():
    r = np.random.default_rng(12)
    graphs = [_graph(r, int(n)) for n in r.integers(1, 12, 90)] + [({}, []), ({1: 0.0}, [])]
    for most in (1, 2, 3):
        assert solve.strains_together(graphs, most) == [solve.strains(*g, most) for g in graphs]


def test_groups_in_slices(monkeypatch):
    monkeypatch.setattr(haplotypes, "TOGETHER", 3)
    monkeypatch.setattr(haplotypes, "ROWS_TOGETHER", 10)
    lists = [[1] * n for n in (2, 2, 2, 2, 9, 1, 30, 1, 1)]
    batch = pa.RecordBatch.from_pydict({"k": list(range(9)), "rows": lists})
    assert [s.column(0).to_pylist() for s in haplotypes._slices(batch)] == [[0, 1, 2], [3], [4, 5], [6], [7, 8]]
