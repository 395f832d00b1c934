"""The filter audit against every order applied to every document."""

import random
import re
from itertools import permutations
from math import factorial

import duckdb
import numpy as np
import pytest

from weftline.llm import filter_audit

R = random.Random(5)
WORDS = ["".join(R.choices("abcdeABxyz", k=R.randint(1, 6))) for _ in range(80)]
TEXTS = [" ".join(R.choices(WORDS[: R.choice([5, 80])], k=R.choice([0, 3, 49, 50, 51, 90]))) + R.choice(["", "", " #", "\x0b$ x", " é", "\n\t"]) for _ in range(120)]
TEXTS += [None, "", "  \t", "a" * 200_000, "WORD " * 60, *TEXTS[:25], *[TEXTS[3]] * 30]
SCHEMA = "doc_id long, text string, source string, part string, mask int, key string, first long, n long"


def _rows():
    rows = [(i, t, R.choice([None, "", "s1", "s1", "s2"]), "x", 9, "k", 7, 1) for i, t in enumerate(TEXTS)]
    return [*rows, rows[4], rows[4], (None, TEXTS[3], "s2", "x", 9, "k", 7, 1), (None, "only here", "s3", "x", 9, "k", 7, 1)]


ROWS = _rows()
LABELS = [(i, R.choice([0, 1, None]), R.choice([0, 1, None])) for i in range(0, 150, 2)] + [(2, 1, 0), (2, 0, 1), (None, 1, 1)]


def _brute():
    lowest = {}
    for i, t, *_ in ROWS:
        if i is not None:
            lowest[t or ""] = min(lowest.get(t or "", i), i)
    good, toxic = {i for i, q, _ in LABELS if q == 1} - {None}, {i for i, _, x in LABELS if x == 1} - {None}
    parts = {}
    for i, t, source, *_ in ROWS:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {"A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t), "D": bool(re.search("[#$%&*|]", t)), "E": i is not None and i > lowest[t]}
        parts.setdefault(source or "", []).append((fails, i in good, i in toxic))
    out, taken = {}, {}
    for part, docs in parts.items():
        for order in permutations("ABCDE"):
            left = docs
            for step, f in enumerate(order, 1):
                gone = [d for d in left if d[0][f]]
                left = [d for d in left if not d[0][f]]
                failing = sum(d[0][f] for d in docs)
                alone = sum(d[0][f] and sum(d[0].values()) == 1 for d in docs)
                out[part, "".join(order), step] = [len(left), len(gone), failing - len(gone), alone, sum(d[1] for d in gone), sum(d[2] for d in gone)]
                taken[part, f] = taken.get((part, f), 0) + len(gone)
    return {k: (*v, taken[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def test_audit(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA).repartition(4)
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    got = filter_audit.audit(docs, labels)
    assert got.columns == ["part", "filter_order", "step", *filter_audit.COUNTS]
    got = {(r.part, r.filter_order, r.step): tuple(r[c] for c in filter_audit.COUNTS) for r in got.collect()}
    assert got == _brute()


def test_audit_sql():
    c = duckdb.connect()
    c.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    c.execute("CREATE TABLE labels (doc_id BIGINT, quality INT, toxic INT)")
    c.executemany("INSERT INTO documents VALUES (?, ?, ?)", [r[:3] for r in ROWS])
    c.executemany("INSERT INTO labels VALUES (?, ?, ?)", LABELS)
    got = c.execute(f"SELECT part, filter_order, step, {', '.join(filter_audit.COUNTS)} FROM ({filter_audit.AUDIT_SQL})").fetchall()
    assert {tuple(r[:3]): tuple(r[3:]) for r in got} == _brute()


def test_empty(spark):
    docs, labels = spark.createDataFrame([], SCHEMA), spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    assert filter_audit.audit(docs, labels).collect() == []
    docs = spark.createDataFrame(ROWS[:5], SCHEMA)
    assert filter_audit.audit(docs, labels.limit(0)).count() == 600 * len({r[2] or "" for r in ROWS[:5]})


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 6])
def test_swaps_visit_all_orders(n):
    order = list(range(n))
    seen = {tuple(order)}
    for i in filter_audit.swaps(n):
        order[i], order[i + 1] = order[i + 1], order[i]
        assert tuple(order) not in seen
        seen.add(tuple(order))
    assert len(seen) == factorial(n)


def test_shapley_shares_all_removals():
    table = np.random.default_rng(1).integers(0, 50, (3, 8, 3))
    orders, out = filter_audit.walk(table, "xyz")
    removed = table[:, 1:, 0].sum(1)
    for o in range(len(orders)):
        assert (out[:, o, :, 1].sum(1) == removed).all() and (out[:, o, :, 6].sum(1) == removed * len(orders)).all()
