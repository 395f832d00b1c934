"""Many rows with the same content: asked once, counted right."""

import duckdb
from pyspark.sql import functions as F

from weftline.operators import calls as C
from weftline.operators import cleaning as K
from weftline.plans import catalog


def test_closest_compares_different_rows_only(spark, monkeypatch):
    asked, nearest = [], C.nearest

    def counting(queries, *rest):
        asked.append(queries.count())
        return nearest(queries, *rest)

    monkeypatch.setattr(K, "nearest", counting)
    q = spark.createDataFrame([(i, "g", s) for i, s in enumerate(["AAC", "AAC", "AAC", "TT", "TT", "GA"])] + [(9, "g", None), (5, "g", "CC")], "id int, gene string, seq string")
    c = spark.createDataFrame([("g", "x", "AAG"), ("g", "y", "TT"), ("g", "z", "GG")], "gene string, name string, cseq string")
    got = {tuple(r) for r in K.closest(q, c, F.levenshtein("seq", "cseq"), ["gene"]).collect()}
    # 5 has two rows, GA at 1 from z and CC at 2
    assert got == {(0, "x", 1), (1, "x", 1), (2, "x", 1), (3, "y", 0), (4, "y", 0), (5, "z", 1)}
    assert asked == [4]


def test_representatives_compare_one_of_equal_sequences(spark, monkeypatch):
    met, alike = [], K.alike

    def counting(seqs, *rest):
        met.append(seqs.count())
        return alike(seqs, *rest)

    monkeypatch.setattr(K, "alike", counting)
    rows = [("g", i, s) for i, s in enumerate(["ACGTACGGTC", "TTTTTGGGGG", "ACGTACGGTC", "TTTTTGGGGG", "CCCAAACCCAAA"])] + [("h", 9, "ACGTACGGTC"), ("g", 10, None)]
    seqs = spark.createDataFrame(rows, "gene string, name int, seq string")
    quota = spark.createDataFrame([("g", 9), ("h", 9)], "gene string, most int")
    assert {tuple(r) for r in K.representatives(seqs, quota, "gene", k=5).collect()} == {("g", 0, "ACGTACGGTC"), ("g", 1, "TTTTTGGGGG"), ("g", 4, "CCCAAACCCAAA"), ("h", 9, "ACGTACGGTC")}
    assert met == [4]


def test_counts_under_names_are_those_of_renamed_steps(spark):
    steps = spark.createDataFrame([(1, 7), (1, 7), (2, 7), (3, 8), (4, 8), (12, 8), (None, 8), (None, 8)], "path long, node long")
    names = spark.createDataFrame([(1, "a or b"), (2, "a or b"), (3, "12"), (99, "z")], "id long, name string")
    want = {tuple(r) for r in K.renamed(steps, names).groupBy("path", "node").agg(F.count("*").alias("n")).collect()}
    got = K.counted_under(steps, names)
    assert {tuple(r) for r in got.collect()} == want == {("a or b", 7, 3), ("12", 8, 2), ("4", 8, 1), (None, 8, 2)}


def test_signature_mean_between_two_numbers_is_rounded_as_in_sql(spark, tmp_path):
    bases = 323  # 323 / 80 * 1000 is 4037.4999.., 323 * 1000 / 80 is 4037.5
    con = duckdb.connect()
    con.execute("CREATE TABLE part AS SELECT * FROM (VALUES (1::BIGINT, 40, 'a', 'b'), (2::BIGINT, 40, 'a', 'b')) t(p_partkey, p_size, p_name, p_brand)")
    con.execute(f"CREATE TABLE lineitem AS SELECT * FROM (VALUES (1::BIGINT, 1::BIGINT, {bases - 1}::DOUBLE), (2::BIGINT, 2::BIGINT, 1::DOUBLE)) t(l_orderkey, l_partkey, l_quantity), (SELECT 1 AS l_linenumber, 1::BIGINT AS l_suppkey, 1::DOUBLE AS l_extendedprice, 'F' AS l_linestatus, 'A' AS l_returnflag)")
    for t in ("part", "lineitem"):
        con.execute(f"COPY {t} TO '{tmp_path}/{t}.parquet' (FORMAT parquet)")
    want = con.execute(catalog.oracle_sql()["signature_weighted_mean"]).fetchall()
    assert [tuple(r) for r in catalog.queries()["signature_weighted_mean"](spark, str(tmp_path)).select("signature", "abundance", "nodes").collect()] == want
