"""Co-training over all unlabelled documents, and its accuracy on held-out labels."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from weftline.llm import quality

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, content string"


def test_metadata_view_reads_no_text(spark):
    rows = [(1, "a text", "en", "s", 5, "x"), (2, None, "en", "s", 5, "x")]
    a, b = quality._featured(quality._columns(spark.createDataFrame(rows, SCHEMA), "doc_id")).orderBy("doc_id").collect()
    assert a.metadata == b.metadata and a.content != b.content


def test_sums_over_the_table_equal_those_in_memory(spark):
    r = np.random.default_rng(2)
    views = r.normal(size=(500, 6)).astype("<f4"), r.normal(size=(500, 4)).astype("<f4")
    y = (views[0][:, 0] + views[1][:, 0] > 0).astype(float)
    models = [quality.Logistic(v[:100].astype(float)).fit(v[:100].astype(float), y[:100]) for v in views]
    labellers = [(m, m.w * 3) for m in models]
    table = spark.createDataFrame([(bytearray(a.tobytes()), bytearray(b.tobytes())) for a, b in zip(*views, strict=True)], "content binary, metadata binary").repartition(5)
    want = quality.pseudo_sums(tuple(v.astype(float) for v in views), labellers, models)
    got = quality._over_table(table)(labellers, models)
    for a, b in zip(got, want, strict=True):
        assert a[0] == b[0] > 50 and np.allclose(a[1], b[1], atol=1e-6) and np.allclose(a[2], b[2], atol=1e-6)
    assert all(n == 0 and not g.any() and not h.any() for n, g, h in quality._over_table(table.limit(0))(labellers, models))


def test_documents_that_share_an_id(spark):
    """The fit does not depend on row order, and one id with many rows is one row of the fit."""
    rows = [(i % 12, f"text {'good words here. ' if i % 12 < 6 else 'BAD!!! '}{i} " * 5, "en", "s", 50 + i, None) for i in range(600)]
    labels = spark.createDataFrame([(i, int(i < 6), 0) for i in range(12)], "doc_id long, quality int, toxic int")
    one = quality.train(spark.createDataFrame(rows, SCHEMA).coalesce(1), labels)
    two = quality.train(spark.createDataFrame(rows[::-1], SCHEMA).coalesce(1), labels)
    assert all(np.allclose(a.w, b.w) for a, b in zip(one.views, two.views, strict=True))


@pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are not here")
def test_accuracy_on_held_out_labels(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    seen = labels.where("doc_id % 4 <> 0")
    model = quality.train(docs, seen)
    got = quality.scored(docs, model).join(labels.where("doc_id % 4 = 0").groupBy("doc_id").agg(F.min("quality").alias("quality")), "doc_id").toPandas()
    assert len(got) > 50 and ((got["quality"] >= 1) == got["keep"]).mean() > 0.9
    for view in ("p_content", "p_metadata"):
        assert ((got["quality"] >= 1) == (got[view] >= 0.5)).mean() > 0.5


def test_ids_beside_nulls(spark):
    rows = [(2**53 + 1, "x", None, None, None, None), (None, None, None, None, None, None)]
    assert sorted(str(r.doc_id) for r in quality.scored(spark.createDataFrame(rows, SCHEMA).coalesce(1), None).collect()) == [str(2**53 + 1), "None"]
