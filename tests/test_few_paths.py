"""One path or two chosen without a search."""

from itertools import combinations

import numpy as np

from weftline.operators import solve


def _listed(a, b, most, kind):
    best, value = np.zeros(a.shape[1]), solve.objective(a, b, np.zeros(a.shape[1]), kind)
    for size in range(1, most + 1):
        for cols in combinations(range(a.shape[1]), size):
            x = np.zeros(a.shape[1])
            x[list(cols)] = solve.fit(a[:, list(cols)], b, kind)
            if (v := solve.objective(a, b, x, kind)) < value - 1e-9:
                best, value = x, v
    return best


def test_chosen_as_from_a_list_of_all_sets():
    r = np.random.default_rng(3)
    for n in (1, 2, 4, 6):
        for k in range(40):
            a = (r.random((7, n)) < 0.5).astype(float)
            b = np.round(r.random(7) * 50) * (r.random(7) < 0.9)
            if k % 3 == 0:
                a[:, -1] = a[:, 0]
            if k % 5 == 0:
                b = a @ np.round(r.random(n) * 9)
            for most in range(1, min(3, n) + 1):
                for kind in (4, 5):
                    assert np.array_equal(solve.choose(a, b, most, kind), _listed(a, b, most, kind))
    assert not solve.choose(np.ones((3, 2)), np.zeros(3), 2).any()


def test_fits_do_not_grow_with_paths(monkeypatch):
    r, calls, nnls = np.random.default_rng(5), [], solve.nnls
    monkeypatch.setattr(solve, "nnls", lambda *a: calls.append(1) or nnls(*a))
    solve.choose((r.random((40, 14)) < 0.2).astype(float), r.integers(1, 50, 40).astype(float), 2)
    assert len(calls) < 5


def test_a_choice_solves_each_set_once(monkeypatch):
    r, asked, least = np.random.default_rng(13), [], solve.least_weighted
    monkeypatch.setattr(solve, "least_weighted", lambda a, *x: asked.append(a.tobytes()) or least(a, *x))
    a, b = (r.random((25, 7)) < 0.4).astype(float), r.integers(1, 60, 25).astype(float)
    x = solve.choose(a, b, 4, 2)
    assert len(asked) <= len(set(asked)) + 2  # its own fit comes on top
    assert 0 < (x > 0).sum() <= 4
