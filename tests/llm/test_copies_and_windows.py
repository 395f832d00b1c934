"""Which rows stay of copies, hot signatures over many slices, and windows of all lengths in one pass."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from weftline.llm import decontaminate, ngram_join

R = random.Random(14)
WORDS = ["".join(R.choices("abcdefghiklmnoprstu", k=R.randint(2, 8))) for _ in range(400)]
SCHEMA = "doc_id long, text string, _row long, key long, doc_id2 long"


def _text(n=60):
    return " ".join(R.choices(WORDS, k=n))


def test_rows_that_share_an_id_or_have_none(spark):
    a, b, c = _text(), _text(), _text()
    near = a.rsplit(" ", 1)[0] + " zzz"
    rows = [(5, a), (5, b), (3, near), (None, b), (None, c), (None, c), (9, c), (7, None), (7, ""), (None, ""), (2**53 + 1, _text()), (3, near)]
    d = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], SCHEMA).repartition(4)
    got = ngram_join.deduplicated(d)
    assert got.columns == d.columns
    want = [(3, near), (5, b), (9, c), (7, None), (7, ""), (None, ""), rows[10]]
    assert sorted(map(str, ((r.doc_id, r.text) for r in got.collect()))) == sorted(map(str, want))
    assert ngram_join.deduplicated(d.limit(0)).collect() == []
    again = sorted(map(str, ((r.doc_id, r.text) for r in ngram_join.deduplicated(d.repartition(2)).collect())))
    assert again == sorted(map(str, want))


def test_hot_signatures_over_many_slices(spark, monkeypatch):
    """Classes of unlike texts that share many shingles, more rows than a slice in one task, with the hot table full and not."""
    base = _text(80).split()
    texts = [" ".join(base[:78] + [w, "x"]) for w in WORDS[:300]] + [_text(40) for _ in range(900)] + [" ".join(base) for _ in range(900)]
    rows = [(i, t) for i, t in enumerate(texts)]
    d = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    sets = [frozenset(zip(*(t.split()[i:] for i in range(3)), strict=False)) for t in texts]
    unlike = {}
    for i, s in enumerate(sets):
        unlike.setdefault(s, i)
    heads = sorted(unlike.values())
    root = {i: i for i in heads}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for n, i in enumerate(heads):
        for j in heads[:n]:
            both = len(sets[i] & sets[j])
            if 100 * both >= 90 * (len(sets[i]) + len(sets[j]) - both):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    want = {i: find(unlike[s]) for i, s in enumerate(sets)}
    assert {r.doc_id: r.component_id for r in ngram_join.classes(d).collect()} == want
    route = ngram_join._route(3, 90, 100, np.empty(0, np.uint64))
    import pyarrow as pa

    table = pa.RecordBatch.from_pydict({"text": texts})
    sigs = np.concatenate([b.column("sig").to_numpy() for b in route(iter([table]))])
    assert np.unique(sigs, return_counts=True)[1].max() <= 1000  # a tie is of one slice


@pytest.mark.parametrize("few", [0, 200_000])
def test_windows_of_all_lengths(spark, few):
    items = [(k, " ".join(WORDS[20 * k : 20 * k + k])) for k in range(1, 15)]
    texts = [" ".join([_text(5), items[k - 1][1], _text(5), items[(k * 3) % 14][1]]) for k in range(1, 15)] + [None, "", WORDS[20]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    windows = decontaminate.benchmark_windows(bench)
    got = {(r.doc_id, r.pos, r.span, i) for r in decontaminate.hits(docs, windows, broadcast_windows=few).collect() for i in r["items"]}
    want = set()
    for doc, t in enumerate(texts):
        w = (t or "").split()
        for item, s in items:
            k = min(10, len(s.split()))
            for a in range(len(s.split()) - k + 1):
                win = s.split()[a : a + k]
                want |= {(doc, p + 1, k, item) for p in range(len(w) - k + 1) if w[p : p + k] == win}
    assert got == want and {x[2] for x in got} == set(range(1, 11))
    plan = decontaminate.hits(docs, windows)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD [doc_id") == 1  # the texts are read once
    assert decontaminate.contamination(docs, bench).agg(F.sum("n_hit")).first()[0] > 0
