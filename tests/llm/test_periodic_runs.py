"""Periodic runs against a search of every period of every document."""

import hashlib
import random
import re
import time
import zlib

import numpy as np
import pytest

from weftline.llm import periodic_runs

R = random.Random(2)


def _slow(w, least=6, exponent=4):
    found = {}
    for q in range(1, len(w) // exponent + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, exponent * q):
                found.setdefault((i, j + q - i), q)
            i = max(i + 1, j)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def _words(most):
    k = R.choice([1, 2, 3, 5, 40])
    w = [R.randrange(k) for _ in range(R.randint(0, most))]
    for _ in range(R.randint(0, 3)):
        p = [R.randrange(k) for _ in range(R.randint(1, 14))]
        at = R.randint(0, len(w))
        w[at:at] = (p * 9)[: R.randint(1, 9 * len(p))]
    return w


@pytest.mark.parametrize("exponent, least", [(4, 6), (4, 2), (5, 9), (7, 1)])
def test_runs(exponent, least):
    for _ in range(400):
        docs = [_words(R.choice([0, 3, 12, 40, 150])) for _ in range(R.randint(1, 5))]
        got = periodic_runs.runs([np.array(d, np.int64) for d in docs], least, exponent)
        assert got == [_slow(d, least, exponent) for d in docs]


def test_z_function():
    for _ in range(300):
        s = [R.randrange(2) for _ in range(R.randint(0, 30))]
        z = [0] + [next((k for k in range(len(s) - i) if s[k] != s[i + k]), len(s) - i) for i in range(1, len(s))]
        assert periodic_runs.z_function(s) == z[: len(s)]


def _digest(doc_id, text):
    w = re.findall("[^\x20\x09-\x0d]+", text or "")
    n = len(w)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        a = h // 10 % n
        p = 1 + (n - a) // (3 + h // 10 % 8)
        w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
    found = _slow(w)
    top = sorted(found, key=lambda r: (-r[1], r[0], r[2]))[:1]
    told = (*top[0], top[0][1] * 1000 // top[0][2]) if top else (None,) * 4
    stay = [x for i, x in enumerate(w) if not any(s + q <= i < s + m for s, m, q in found)]
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(found), *told, sha("".join(f"{s},{m},{q}\n" for s, m, q in found)), sha(" ".join(stay)))


NAMES = ["alpha", "b", "ç", "a b", "\x1fz", " "]
TEXTS = [R.choice([" ", "\n\t", "  "]).join(NAMES[i % len(NAMES)] for i in _words(120)) for _ in range(90)] + [None, "", " \x0b ", "x", "la " * 5, "la " * 6, "a b c " * 4, "a b c " * 3 + "a b", "z " * 20_000, " ".join(map(str, range(30_000)))]
SCHEMA = "doc_id long, text string, n_runs int, start string, length long"


def test_digest(spark):
    rows = [(i, t, 1, "s", 2) for i, t in enumerate(TEXTS)]
    rows += [rows[2], rows[2], (None, "y " * 40, 1, "s", 2), (-5, "y w " * 40, 1, "s", 2)]
    assert sum(zlib.crc32(str(r[0]).encode()) % 10 == 0 for r in rows) > 3
    got = periodic_runs.digest(spark.createDataFrame(rows, SCHEMA).repartition(3))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    want = {}
    for r in rows:
        if not (r[1] or "").startswith("0 1"):
            want.setdefault(_digest(*r[:2]), []).append(r)
    found = [tuple(r) for r in got.collect()]
    assert len(found) == len(rows)
    for row in want:
        assert found.count(row) == len(want[row])


def test_spans(spark):
    docs = spark.createDataFrame([(7, "q " + "la li " * 5, 1, "s", 2), (8, None, 1, "s", 2), (8, "no runs here", 1, "s", 2)], SCHEMA)
    assert [tuple(r) for r in periodic_runs.spans(docs).collect()] == [(7, 1, 10, 2)]
    assert periodic_runs.spans(docs.limit(0)).collect() == [] and periodic_runs.digest(docs.limit(0)).collect() == []


@pytest.mark.parametrize("make", [lambda n: [0] * n, lambda n: ([0] * 100 + [1]) * (n // 101), lambda n: [x for i in range(n // 101) for x in [0] * 100 + [i + 1]], lambda n: [R.randrange(2) for _ in range(n)]], ids=["one word", "period 101", "stretches", "two words"])
def test_time_grows_in_proportion(make):
    def seconds(n):
        words, best = np.array(make(n), np.int64), 1e9
        for _ in range(3):
            began = time.process_time()
            periodic_runs.runs([words])
            best = min(best, time.process_time() - began)
        return best

    assert seconds(40_000) < 4 * seconds(20_000) + 0.2
