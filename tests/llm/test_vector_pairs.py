"""Near vectors against the cosine of all pairs."""

import random

import duckdb
import numpy as np
import pytest

from weftline.llm import vector_pairs

G, R = np.random.default_rng(4), random.Random(4)
SCHEMA = "vec_id long, embedding array<float>, label int, key string, size string, tile int, id long"


def _near(x, noise):
    return (x + noise * G.normal(size=len(x)) * np.linalg.norm(x) / len(x) ** 0.5).tolist()


def _vectors():
    out = []
    for label in (1, 2, 3):
        base = G.normal(size=(60, 24)) * np.r_[np.full(4, 4.0), np.ones(20)]
        out += [(v.tolist(), label) for v in base]
        out += [(_near(base[i % 20], R.choice([0.1, 0.25, 0.35, 0.4])), label) for i in range(90)]
        out += [(_near(base[0], 0.2), label) for _ in range(70)] + [(base[1].tolist(), label)] * 5 + [((base[2] * 7).tolist(), label), ((-base[3]).tolist(), label)]
    nan, inf = float("nan"), float("inf")
    out += [(None, 1), ([], 1), ([0.0] * 24, 1), ([0.0] * 24, 1), ([1.0, None] * 12, 1), ([1.0, nan] * 12, 2), ([inf] * 24, 2), (out[0][0], None), (out[0][0], None), ([1.0, 2.0], 1), ([1.0, 2.0], 1), ([1.0, 2.01], 1), ([1e-30] * 24, 2), ([1e30] * 24, 2), ([0.0, -1.0], 3), ([-0.0, -1.0], 3)]
    return [(i, v, label, "x", "y", 1, 2) for i, (v, label) in enumerate(out)]


ROWS = _vectors()
ROWS += [ROWS[5], ROWS[5], (None, *ROWS[7][1:]), (None, [9.0, 1.0], 9, "x", "y", 1, 2)]


def _brute(rows, threshold):
    n = len(rows)
    ok = []
    for _, v, label, *_ in rows:
        x = None if v is None or label is None or None in v else np.array(v, np.float32).astype(float)
        ok.append(x if x is not None and len(x) and np.isfinite(x).all() and x.any() else None)
    links, root = [0] * n, list(range(n))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(n):
        for j in range(i):
            a, b = ok[i], ok[j]
            if a is not None and b is not None and rows[i][2] == rows[j][2] and len(a) == len(b) and a @ b >= threshold * np.sqrt(a @ a) * np.sqrt(b @ b):
                links[i] += 1
                links[j] += 1
                root[top(i)] = top(j)
    least = {}
    for i in range(n):
        if rows[i][0] is not None:
            least[top(i)] = min(least.get(top(i), rows[i][0]), rows[i][0])
    return [(r[0], links[i], least.get(top(i)), r[0] is not None and least.get(top(i)) == r[0]) for i, r in enumerate(rows)]


@pytest.mark.parametrize("threshold", [0.93, 0.8])
def test_near(spark, monkeypatch, threshold):
    monkeypatch.setattr(vector_pairs, "TILE_VALUES", 64 * 24)  # 64 vectors a tile: labels are several tiles
    monkeypatch.setattr(vector_pairs, "BLOCK", 40)
    got = vector_pairs.near(spark.createDataFrame(ROWS, SCHEMA).repartition(5), threshold)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    want = _brute(ROWS, threshold)
    assert sum(w[1] for w in want) > 1000
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_empty_and_unusable(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert vector_pairs.near(empty).collect() == []
    rows = [(1, None, 1, "x", "y", 1, 2), (2, [1.0], None, "x", "y", 1, 2)]
    assert sorted(map(tuple, vector_pairs.near(spark.createDataFrame(rows, SCHEMA)).collect())) == [(1, 0, 1, True), (2, 0, 2, True)]


def test_doubles(spark):
    rows = [(1, [1.0, 0.0], "a"), (2, [1.0, 1e-12], "a"), (3, [1.0, 1e-12], "b")]
    got = vector_pairs.near(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string"))
    assert sorted(map(tuple, got.collect())) == [(1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True)]


def test_linked_equals_products():
    for _ in range(20):
        x, y = (vector_pairs._unit([v.tobytes() for v in G.normal(size=(n, 20)) * np.r_[np.full(3, 5.0), np.ones(17)]], np.float64) for n in (50, 70))
        turn = np.linalg.eigh(x.T @ x)[1][:, ::-1]
        for threshold in (0.5, 0.8, 0.95):
            assert (vector_pairs.linked(x, y, x @ turn, y @ turn, threshold) == (x @ y.T >= threshold)).all()


def test_sql():
    c = duckdb.connect()
    c.execute("CREATE TABLE embeddings (vec_id BIGINT, embedding FLOAT[], label INT)")
    rows = [r for r in ROWS[:-4]]
    c.executemany("INSERT INTO embeddings VALUES (?, ?, ?)", [r[:3] for r in rows])
    got = c.execute(vector_pairs.NEAR_SQL).fetchall()
    assert sorted(got) == sorted(_brute(rows, 0.93))
