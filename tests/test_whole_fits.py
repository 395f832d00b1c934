"""Fits over all paths of a group, and the exact choice among more than 14 of them."""

import itertools
import os

import numpy as np
import pytest

from weftline.operators import solve
from weftline.plans import bindings, catalog

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("seed", range(6))
def test_choice_among_many_paths_is_exact(seed):
    r = np.random.default_rng(seed)
    a = (r.random((12, 17)) < 0.4).astype(float)
    b = a @ np.where(r.random(17) < 0.3, r.integers(1, 9, 17), 0).astype(float) + r.random(12)
    for most, kind in ((2, 5), (3, 5), (2, 4)):
        got = solve.objective(a, b, solve.choose(a, b, most, kind), kind)
        want = np.inf
        for cols in itertools.chain.from_iterable(itertools.combinations(range(17), k) for k in range(1, most + 1)):
            x = np.zeros(17)
            x[list(cols)] = solve.fit(a[:, list(cols)], b, kind)
            want = min(want, solve.objective(a, b, x, kind))
        assert got <= want + 1e-8


def test_greedy_choice_would_miss_the_best_pair():
    """Path 0 alone explains most, but only paths 1 and 2 together explain all; 15 paths."""
    a = np.zeros((4, 15))
    a[:3, 0], a[:2, 1], a[2:, 2] = 1, 1, 1
    assert set(np.flatnonzero(solve.choose(a, np.full(4, 5.0), 2))) == {1, 2}


@pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are not here")
def test_fits_take_all_orders(spark):
    o = bindings.table(spark, SF, "orders").selectExpr("o_orderkey as path", "o_custkey as sample")
    want = {(r.sample, r.path) for r in bindings.steps(spark, SF).join(o, "path").select("sample", "path").distinct().collect()}
    assert {(r.sample, r.path) for r in catalog.queries()["fit_abundance"](spark, SF).select("sample", "path").collect()} == want
