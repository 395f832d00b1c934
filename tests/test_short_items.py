"""Benchmark items of any length are found."""

from weftline.plans import catalog


def test_items_shorter_than_a_seed(spark, tmp_path):
    long = "the quick brown fox jumps over the lazy dog"
    items = [(1, "tiny"), (2, "é"), (3, long), (4, long[:23]), (5, long[:24]), (6, ""), (7, None), (8, "not there"), (9, "tiny")]
    docs = [(1, f"x {long} tiny tiny"), (2, "tiny"), (3, "é"), (4, ""), (5, None), (6, long[:23])]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((r.item_id, r.doc_id) for r in catalog.queries()["benchmark_hits"](spark, str(tmp_path)).collect())
    assert got == sorted((i, d) for i, t in items for d, text in docs if t and text is not None and t in text)
