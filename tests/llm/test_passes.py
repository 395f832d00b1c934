"""Signatures sent in passes, and what stored tables leave on disk."""

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from weftline.llm import ngram_join
from weftline.llm.common import written

R = random.Random(41)
WORDS = ["".join(R.choices("abcdefghiklmnoprstu", k=R.randint(2, 8))) for _ in range(400)]


def _shuffle_files(spark) -> int:
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(files.apply(i).getName().startswith("shuffle_") for i in range(files.size()))


def test_passes_share_all_signatures():
    texts = [" ".join(R.choices(WORDS, k=n)) for n in (1, 2, 3, 9, 60, 60, 400)]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": texts})
    sent = lambda *a: {(s, k) for b in ngram_join._route(3, 90, 100, np.empty(0, np.uint64), *a)(iter([batch])) for s, k in zip(*(c.to_pylist() for c in b.columns), strict=True)}
    parts = [sent(nth, 3) for nth in range(3)]
    assert all(len(p) < len(sent()) * 0.6 for p in parts)
    assert sum(map(len, parts)) == len(sent()) and set().union(*parts) == sent()


def test_passes_find_the_same_classes(spark, monkeypatch):
    base = [" ".join(R.choices(WORDS, k=60)) for _ in range(60)]
    texts = [*base, *(x + " end" for x in base[:40]), *base[:10], "one", "", None, "One"]
    docs = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "doc_id long, text string").repartition(3)
    once = {tuple(r) for r in ngram_join.classes(docs).collect()}
    monkeypatch.setattr(ngram_join, "PASSES_FROM", 0)
    assert {tuple(r) for r in ngram_join.classes(docs, passes=3).collect()} == once
    assert len({c for *_, c in once}) < len(texts) - 30


def test_stored_tables_leave_no_shuffle_files(spark):
    before = _shuffle_files(spark)
    rows = written(spark.range(50_000).groupBy((F.col("id") % 1000).alias("k")).count(), "rows")
    assert _shuffle_files(spark) <= before and rows.count() == 1000
