"""The driver's tables in the roles of graph tables.

A path is an order, a node a part, a step a line item; the data are no biological graph, they exercise the operators
against exact oracles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def segments(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select(F.col("p_partkey").alias("node"), F.col("p_size").alias("len"), F.col("p_name").alias("seq"), F.col("p_brand").alias("gene"))


def steps(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    ori = F.when(F.col("l_linestatus") == "F", "+").otherwise("-")
    return table(spark, d, "lineitem").select(F.col("l_orderkey").alias("path"), F.row_number().over(w).alias("pos"), F.col("l_partkey").alias("node"), ori.alias("ori"), F.col("l_quantity").alias("aligned"), F.col("l_returnflag").alias("kind"))


def calls(spark: SparkSession, d: str) -> DataFrame:
    """(sample, gene, allele, coverage, freq): quantities of a customer's parts, by brand."""
    li = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("sample"))
    c = li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).join(segments(spark, d).select("node", "gene"), F.col("l_partkey") == F.col("node"))
    c = c.groupBy("sample", "gene", F.col("l_partkey").alias("allele")).agg(F.sum("l_quantity").alias("coverage"))
    return c.withColumn("freq", F.col("coverage") / F.sum("coverage").over(Window.partitionBy("sample", "gene")))


def intervals(spark: SparkSession, d: str) -> DataFrame:
    """(key, id, start, end): events as seconds, as long as their value."""
    s = F.unix_seconds(F.col("ts").cast("timestamp"))
    return table(spark, d, "events").select(F.col("user_id").alias("key"), F.col("event_id").alias("id"), s.alias("start"), (s + F.floor("value")).cast("long").alias("end"))


#: The same roles for DuckDB.
SEGMENTS = "seg AS (SELECT p_partkey AS node, p_size AS len, p_name AS seq, p_brand AS gene FROM part)"
STEPS = "steps AS (SELECT l_orderkey AS path, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS INTEGER) AS pos, l_partkey AS node, CASE l_linestatus WHEN 'F' THEN '+' ELSE '-' END AS ori, l_quantity AS aligned, l_returnflag AS kind FROM lineitem)"
CALLS = "calls AS (SELECT sample, gene, allele, coverage, coverage / sum(coverage) OVER (PARTITION BY sample, gene) AS freq FROM (SELECT o_custkey AS sample, p_brand AS gene, l_partkey AS allele, sum(l_quantity) AS coverage FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey GROUP BY ALL))"
INTERVALS = 'iv AS (SELECT user_id AS key, event_id AS id, CAST(floor(epoch(ts)) AS BIGINT) AS "start", CAST(floor(epoch(ts)) AS BIGINT) + CAST(floor(value) AS BIGINT) AS "end" FROM events)'
PAIRS = "pairs AS (SELECT * FROM (SELECT path, pos, lag(node) OVER w AS n1, lag(ori) OVER w AS o1, node AS n2, ori AS o2, kind FROM steps WINDOW w AS (PARTITION BY path ORDER BY pos)) WHERE n1 IS NOT NULL)"


# A sample's own graph: a sample is a customer, its nodes the brands of the parts it ordered, as sample * 100 + brand.

#: The sample of an edge, by its first node: samples are parts that no edge joins.
SAMPLE = "n1 div 100"

ROLES = {"F": "allele", "O": "read", "P": "reference"}


def sample_steps(spark: SparkSession, d: str, only: str | None = None) -> DataFrame:
    """(sample, path, pos, node, ori, aligned, role) of every line item; an order's status says whether it is an allele, a read or a reference.

    only: of the paths of one role, left out before their steps are counted, which a filter on role cannot do.
    """
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_linestatus", "l_quantity")
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("sample"), "o_orderstatus")
    role = F.when(F.col("o_orderstatus") == "F", ROLES["F"]).when(F.col("o_orderstatus") == "O", ROLES["O"]).otherwise(ROLES["P"])
    if only is not None:
        o = o.where(role == only)
    p = table(spark, d, "part").select("p_partkey", F.substring("p_brand", 7, 9).cast("long").alias("brand"))
    j = li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).join(p, F.col("l_partkey") == F.col("p_partkey"))
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    return j.select("sample", F.col("l_orderkey").alias("path"), F.row_number().over(w).alias("pos"), (F.col("sample") * 100 + F.col("brand")).alias("node"), F.when(F.col("l_linestatus") == "F", "+").otherwise("-").alias("ori"), F.col("l_quantity").alias("aligned"), role.alias("role"))


def sample_segments(steps: DataFrame) -> DataFrame:
    """(node, len, seq) of the steps' nodes; sequences are made of the brand's number."""
    brand = (F.col("node") % 100).cast("int")
    s = steps.select("node").distinct().select("node", F.substr(F.lit("ACGTTGCAACGGTCA"), brand % 5 + 1, brand % 6 + 1).alias("seq"))
    return s.select("node", F.length("seq").alias("len"), "seq")


SAMPLE_STEPS = "ss AS (SELECT o_custkey AS sample, l_orderkey AS path, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS INTEGER) AS pos, o_custkey * 100 + CAST(substr(p_brand, 7) AS BIGINT) AS node, CASE l_linestatus WHEN 'F' THEN '+' ELSE '-' END AS ori, l_quantity AS aligned, CASE o_orderstatus WHEN 'F' THEN 'allele' WHEN 'O' THEN 'read' ELSE 'reference' END AS role FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey)"
SAMPLE_PAIRS = "sp AS (SELECT * FROM (SELECT sample, path, pos, role, lag(node) OVER w AS n1, lag(ori) OVER w AS o1, node AS n2, ori AS o2, aligned FROM ss WINDOW w AS (PARTITION BY path ORDER BY pos)) WHERE n1 IS NOT NULL)"
SAMPLE_SEGMENTS = "sg AS (SELECT node, CAST(length(seq) AS INTEGER) AS len, seq FROM (SELECT node, substr('ACGTTGCAACGGTCA', CAST(node % 100 % 5 + 1 AS INTEGER), CAST(node % 100 % 6 + 1 AS INTEGER)) AS seq FROM (SELECT DISTINCT node FROM ss)))"
