"""Groups go to Python in batches, sets of paths are fitted once, and least squares do without converging singular values."""

import numpy as np
import pytest

from weftline.operators import haplotypes as H
from weftline.operators import solve


def test_groups_are_gathered_and_not_sent_one_by_one(spark, capsys):
    e = spark.createDataFrame([(g, g + u, g + u + 1, 3.0) for g in range(0, 5000, 10) for u in (1, 2, 3)], "sample long, n1 long, n2 long, flow double")
    got = H.peeled(H.ranked(e, "sample"), "sample", 1, "all")
    got.explain()
    plan = capsys.readouterr().out
    assert "InPandas" not in plan and "MapInArrow" in plan
    assert {(r.sample, r.nth, r.nodes, r.abundance) for r in got.collect()} == {(g, 0, ",".join(str(g + u) for u in (1, 2, 3, 4)), 3.0) for g in range(0, 5000, 10)}


def test_keys_of_any_kind_and_empty_groups(spark):
    e = spark.createDataFrame([("a", 1, 2), ("a", 2, 1), ("b", 1, 2), (None, 3, 4)], "sample string, n1 int, n2 int")
    assert {tuple(r) for r in H.without_cycles(e, "sample").collect()} == {("b", 1, 2), (None, 3, 4)}
    assert H.without_cycles(e, "sample").schema.simpleString() == "struct<sample:string,n1:int,n2:int>"
    assert {tuple(r) for r in H.ranked(e, "sample").collect()} == {("a", 1, 2), ("b", 1, 2), (None, 3, 4)}


@pytest.mark.parametrize("kind", [6, 7])
def test_a_set_of_paths_is_fitted_once(monkeypatch, kind):
    asked, fit = [], solve.fit

    def counting(a, b, k, *rest):
        if k == kind:
            return fit(a, b, k, *rest)
        asked.append(a.tobytes())
        return fit(a, b, k, *rest)

    monkeypatch.setattr(solve, "fit", counting)
    a = np.array([[1, 0, 0, 1], [1, 1, 0, 0], [0, 1, 1, 0], [0, 0, 1, 1], [1, 0, 1, 0.0]])
    solve.penalised(a, np.array([7.0, 9, 4, 6, 8]), kind)
    assert len(asked) == len(set(asked)) > 1


def test_least_squares_without_singular_values(monkeypatch):
    a, b = np.array([[1, 1, 0], [1, 1, 1], [0, 0, 1.0]]), np.array([4.0, 7, 3])  # two paths alike
    want = np.abs(a @ solve.nnls(a, b) - b).max()

    def fails(*args, **more):
        raise np.linalg.LinAlgError("SVD did not converge")

    monkeypatch.setattr(np.linalg, "lstsq", fails)
    x = solve._normal(a.T @ a, a.T @ b, a, b)
    assert np.abs(a @ x - b).max() < 1e-5 and want < 1e-9
    assert np.abs(a @ solve.nnls(a, b) - b).max() < 1e-5
