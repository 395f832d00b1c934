"""Queries of call cleaning, naming, catalogue filters, set operations and small tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import sequences as S
from ..operators import cleaning as K
from . import bindings as B
from .bindings import CALLS, SAMPLE_STEPS, SEGMENTS, STEPS
from .registry import query

_milli = lambda c: F.round(F.col(c) * 1000).cast("long").alias(c)


@query("SELECT s_suppkey, CAST(s_acctbal AS DOUBLE) AS abundance FROM supplier WHERE s_acctbal >= 1e-4")
def present_contigs(spark, d):
    return K.present(B.table(spark, d, "supplier").select("s_suppkey", F.col("s_acctbal").cast("double").alias("abundance")))


HAPS = "hp AS (SELECT p_partkey AS id, p_size AS gene, p_type || p_brand AS seq FROM part), cn AS (SELECT DISTINCT p_size AS gene, p_name AS name, p_type || CASE WHEN p_size % 2 = 0 THEN p_brand ELSE 'Brand#7' END AS cseq FROM part)"


def _haps(spark, d):
    p = B.table(spark, d, "part")
    haps = p.select(F.col("p_partkey").alias("id"), F.col("p_size").alias("gene"), F.concat("p_type", "p_brand").alias("seq"))
    contigs = p.select(F.col("p_size").alias("gene"), F.col("p_name").alias("name"), F.concat("p_type", F.when(F.col("p_size") % 2 == 0, F.col("p_brand")).otherwise("Brand#7")).alias("cseq")).distinct()
    return haps, contigs


NAMED = f"{HAPS}, ex AS (SELECT id, string_agg(DISTINCT name, ' or ' ORDER BY name) AS name FROM hp JOIN cn ON cn.gene = hp.gene AND cn.cseq = hp.seq GROUP BY id), nj AS (SELECT id, name, hamming(seq, cseq) AS dist FROM hp JOIN cn ON cn.gene = hp.gene AND length(seq) = length(cseq) WHERE id NOT IN (SELECT id FROM ex)), nm AS (SELECT id, string_agg(DISTINCT name, ' or ' ORDER BY name) || '_HammingDistBased' AS name FROM (SELECT *, min(dist) OVER (PARTITION BY id) AS low FROM nj) WHERE dist = low GROUP BY id), na AS (SELECT id, name, 'exact' AS how FROM ex UNION ALL SELECT id, name, 'nearest' FROM nm)"


def _named(spark, d):
    haps, contigs = _haps(spark, d)
    return K.named(haps, contigs, S.hamming(F.col("seq"), F.col("cseq")), "gene")


@query(f"WITH {NAMED} SELECT id, name, how FROM na")
def named_haplotypes(spark, d):
    return _named(spark, d)


@query(f"WITH {NAMED}, ca AS (SELECT hp.gene, hp.id, coalesce(name, CAST(hp.id AS VARCHAR)) AS allele, coalesce(how, 'novel') AS how, CAST(floor(p_retailprice) AS BIGINT) % 97 AS coverage FROM hp JOIN part ON p_partkey = hp.id LEFT JOIN na ON na.id = hp.id WHERE CAST(floor(p_retailprice) AS BIGINT) % 97 >= 10), fq AS (SELECT *, floor(coverage) / sum(coverage) OVER (PARTITION BY gene) AS freq FROM ca), sr AS (SELECT *, freq >= 0.1 AND coverage >= 2 AND coverage * 4 > max(coverage) OVER (PARTITION BY gene) AS ok FROM fq) SELECT gene, id, allele, how, round(freq * 1000000)::BIGINT AS micro, CASE WHEN bool_or(ok) OVER (PARTITION BY gene) THEN ok ELSE coverage >= 2 AND freq >= 0.2 END AS passed FROM sr")
def called_parts(spark, d):
    haps, contigs = _haps(spark, d)
    price = B.table(spark, d, "part").select(F.col("p_partkey").alias("id"), (F.floor("p_retailprice") % 97).alias("coverage"))
    calls = K.called(haps.join(price, "id"), contigs, S.hamming(F.col("seq"), F.col("cseq")), "gene", 10)
    return calls.select("gene", "id", "allele", "how", F.round(F.col("freq") * 1000000).cast("long").alias("micro"), "passed")


@query(f"WITH {NAMED} SELECT coalesce(name, CAST(l_suppkey AS VARCHAR)) AS path, l_partkey AS node, count(*) AS n FROM lineitem LEFT JOIN na ON id = l_suppkey GROUP BY ALL")
def renamed_paths(spark, d):
    steps = B.table(spark, d, "lineitem").select(F.col("l_suppkey").alias("path"), F.col("l_partkey").alias("node"))
    return K.counted_under(steps, _named(spark, d))


@query()
def merged_contained_haplotypes(spark, d):
    """Fold over a group's haplotypes in order, which SQL does not say; tested against a slow version."""
    p = B.table(spark, d, "part").groupBy(F.col("p_brand").alias("gene"), F.col("p_name").alias("id")).agg(F.sum("p_retailprice").alias("abundance"))
    return K.merged_haplotypes(p.withColumn("seq", F.regexp_replace("id", "^(small|large) ", "")), "gene")


DEPTH = "dp AS (SELECT 'S1.' || replace(p_name, ' ', '/') AS gene, avg(CAST(p_size AS DOUBLE)) AS mean, stddev_samp(CAST(p_size AS DOUBLE)) AS sd FROM part GROUP BY p_name)"


def _depth(spark, d):
    p = B.table(spark, d, "part")
    return p.groupBy(F.concat(F.lit("S1."), F.replace("p_name", F.lit(" "), F.lit("/"))).alias("gene")).agg(F.avg(F.col("p_size").cast("double")).alias("mean"), F.stddev_samp(F.col("p_size").cast("double")).alias("sd"))


@query(f"WITH {DEPTH} SELECT p_partkey, CAST(round(1000 * mean) AS BIGINT) AS mean, coalesce(CAST(round(1000 * sd) AS BIGINT), -1) AS sd FROM part LEFT JOIN dp ON 'S1.' || replace(p_name, ' ', '/') = dp.gene")
def calls_with_depth(spark, d):
    calls = B.table(spark, d, "part").select("p_partkey", F.concat(F.replace("p_name", F.lit(" "), F.lit("__")), F.lit("_x1")).alias("gene"))
    return K.with_depth(calls, _depth(spark, d)).select("p_partkey", _milli("mean"), F.coalesce(_milli("sd"), F.lit(-1)).alias("sd"))


@query(
    "WITH al AS (SELECT p_brand AS gene, p_type AS allele, p_brand || '*' || p_type || CASE p_size % 4 WHEN 0 THEN ':exact_' WHEN 1 THEN ':variant_DP' WHEN 2 THEN ':ambiguous_exact_' ELSE ':ambiguous_variant' END || p_size AS name, CASE p_size % 4 WHEN 0 THEN 3 WHEN 1 THEN 2 WHEN 2 THEN 1 END AS kind, p_name AS seq  FROM part), "
    "b AS (SELECT gene, allele, arg_max(name, (kind, name, seq)) AS novel, arg_max(seq, (kind, name, seq)) AS fasta FROM al WHERE kind IS NOT NULL GROUP BY ALL) "
    "SELECT p_partkey, p_brand AS gene, p_type AS allele, coalesce(novel, '') AS novel, coalesce(fasta, '') AS fasta FROM part LEFT JOIN b ON gene = p_brand AND allele = p_type"
)
def calls_with_sequences(spark, d):
    p = B.table(spark, d, "part")
    k = F.col("p_size") % 4
    kind = F.when(k == 0, ":exact_").when(k == 1, ":variant_DP").when(k == 2, ":ambiguous_exact_").otherwise(":ambiguous_variant")
    alleles = p.select(F.concat("p_brand", F.lit("*"), "p_type", kind, F.col("p_size").cast("string")).alias("name"), F.col("p_name").alias("seq"))
    return K.with_sequences(p.select("p_partkey", F.col("p_brand").alias("gene"), F.col("p_type").alias("allele")), alleles)


@query("WITH m AS (SELECT p_brand AS gene, avg(CAST(p_size AS DOUBLE)) AS mean FROM part WHERE p_size > 25 GROUP BY 1) SELECT p_partkey, CASE WHEN p_size < 10 THEN CAST(CAST(round(100 * mean) AS BIGINT) AS VARCHAR) ELSE CAST(p_size AS VARCHAR) || 'x' END AS shown FROM part JOIN m ON gene = p_brand")
def zero_coverage_depth(spark, d):
    p = B.table(spark, d, "part")
    m = p.where("p_size > 25").groupBy(F.col("p_brand").alias("gene")).agg(F.avg(F.col("p_size").cast("double")).alias("mean"))
    calls = p.select("p_partkey", F.col("p_brand").alias("gene"), F.when(F.col("p_size") < 10, "0x").otherwise(F.concat(F.col("p_size").cast("string"), F.lit("x"))).alias("shown"), "p_size")
    out = K.zero_coverage(calls, m)
    centi = F.round(F.regexp_replace("shown", "x$", "").cast("double") * 100).cast("long").cast("string")
    return out.select("p_partkey", F.when(F.col("p_size") < 10, centi).otherwise(F.col("shown")).alias("shown"))


@query("WITH b AS (SELECT event_type AS gene, value AS depth, extract(hour FROM ts) AS h FROM events), r AS (SELECT 'TTN' AS gene, depth FROM b WHERE h < 6 UNION ALL SELECT gene, depth FROM b) SELECT gene, CAST(round(1000 * avg(depth)) AS BIGINT) AS mean, CAST(round(1000 * stddev_samp(depth)) AS BIGINT) AS sd FROM r GROUP BY gene")
def control_depth(spark, d):
    e = B.table(spark, d, "events").select(F.col("event_type").alias("gene"), F.col("value").alias("depth"), F.hour(F.col("ts").cast("timestamp")).alias("h"))
    return K.locus_depths(e, F.col("h") < 6).select("gene", _milli("mean"), _milli("sd"))


@query("SELECT CAST(round(1000 * avg(value)) AS BIGINT) AS mean, CAST(round(1000 * stddev_pop(value)) AS BIGINT) AS sd FROM events")
def genome_depth(spark, d):
    return K.population_depth(B.table(spark, d, "events").select(F.col("value").alias("depth"))).select(_milli("mean"), _milli("sd"))


@query("SELECT p_partkey, p_name AS allele FROM part WHERE p_name IN (SELECT p_name FROM part WHERE p_size = 50)")
def catalogue_alleles(spark, d):
    p = B.table(spark, d, "part")
    return K.in_catalogue(p.select("p_partkey", F.col("p_name").alias("allele")), p.where("p_size = 50").select(F.col("p_name").alias("allele")), "^blue")


@query("SELECT p_partkey, p_name AS allele FROM part WHERE regexp_matches(p_name, '^blue')")
def catalogue_alleles_fallback(spark, d):
    p = B.table(spark, d, "part")
    return K.in_catalogue(p.select("p_partkey", F.col("p_name").alias("allele")), p.where("p_size < 0").select(F.col("p_name").alias("allele")), "^blue")


@query("WITH a AS (SELECT p_partkey, p_size AS gene, CASE WHEN p_brand < 'Brand#2' OR p_size < 3 THEN p_brand || '/OR' ELSE p_brand END AS allele FROM part) SELECT p_partkey, gene, allele FROM (SELECT *, bool_and(contains(allele, '/')) OVER (PARTITION BY gene) AS every FROM a) WHERE every OR NOT contains(allele, '/')")
def alleles_without_orphons(spark, d):
    a = F.when((F.col("p_brand") < "Brand#2") | (F.col("p_size") < 3), F.concat("p_brand", F.lit("/OR"))).otherwise(F.col("p_brand"))
    return K.without_orphons(B.table(spark, d, "part").select("p_partkey", F.col("p_size").alias("gene"), a.alias("allele")), "gene")


@query(f"WITH {STEPS} SELECT path, pos, node FROM steps WHERE path NOT IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT')")
def reads_without_set(spark, d):
    unwanted = B.table(spark, d, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_orderkey").alias("path"))
    return K.without_reads(B.steps(spark, d), unwanted).select("path", "pos", "node")


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem WHERE 50 - l_quantity >= 0.5 * 50 AND l_suppkey % 60 >= 20")
def alignments_filtered(spark, d):
    li = B.table(spark, d, "lineitem").withColumn("matches", 50 - F.col("l_quantity")).withColumn("block_len", F.lit(50)).withColumn("mapq", F.col("l_suppkey") % 60)
    return K.aligned_well(li, 0.5, 20).select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")


@query("SELECT DISTINCT l_partkey AS haplotype FROM lineitem JOIN part ON p_partkey = l_partkey WHERE l_linenumber = 7 OR (regexp_matches(CASE WHEN p_size % 3 = 0 THEN 'IGHD' ELSE p_brand END, '^IG.D') AND l_discount < 0.01)")
def haplotypes_kept(spark, d):
    j = B.table(spark, d, "lineitem").join(B.table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return K.kept_haplotypes(j.select(F.col("l_partkey").alias("haplotype"), F.when(F.col("p_size") % 3 == 0, "IGHD").otherwise(F.col("p_brand")).alias("gene"), (7 - F.col("l_linenumber")).alias("nm"), F.col("l_discount").alias("de")))


@query("WITH m AS (SELECT DISTINCT p_size * 100 + p_partkey % 97 AS cluster, p_partkey % 1013 AS gene FROM part), c AS (SELECT cluster, count(*) AS genes FROM m GROUP BY 1) SELECT gene FROM m JOIN c USING (cluster) GROUP BY gene HAVING count(*) > 1 OR max(genes) > 1")
def complex_genes(spark, d):
    p = B.table(spark, d, "part")
    return K.complex_genes(p.select((F.col("p_size") * 100 + F.col("p_partkey") % 97).alias("cluster"), (F.col("p_partkey") % 1013).alias("gene")))


@query("WITH q AS (SELECT p_partkey AS id, p_size AS gene, p_type AS seq FROM part), c AS (SELECT DISTINCT p_size AS gene, p_name AS name, CASE WHEN p_retailprice > 1500 THEN p_type ELSE p_brand END AS cseq FROM part), s AS (SELECT id, string_agg(DISTINCT name, ' or ' ORDER BY name) AS name, 0 AS distance FROM q JOIN c ON c.gene = q.gene AND c.cseq = q.seq GROUP BY id), j AS (SELECT id, name, levenshtein(seq, cseq) AS distance FROM q JOIN c USING (gene) WHERE id NOT IN (SELECT id FROM s)) SELECT * FROM s UNION ALL SELECT id, string_agg(DISTINCT name, ' or ' ORDER BY name), CAST(min(distance) AS INTEGER) FROM (SELECT *, min(distance) OVER (PARTITION BY id) AS low FROM j) WHERE distance = low GROUP BY id")
def closest_alleles(spark, d):
    p = B.table(spark, d, "part")
    q = p.select(F.col("p_partkey").alias("id"), F.col("p_size").alias("gene"), F.col("p_type").alias("seq"))
    c = p.select(F.col("p_size").alias("gene"), F.col("p_name").alias("name"), F.when(F.col("p_retailprice") > 1500, F.col("p_type")).otherwise(F.col("p_brand")).alias("cseq")).distinct()
    return K.closest(q, c, F.levenshtein("seq", "cseq"), ["gene"])


DOUBLES = "a AS (SELECT CAST(p_partkey AS VARCHAR) || CASE WHEN p_size = 1 THEN '/OR' ELSE '' END AS allele, p_name || p_brand AS seq FROM part)"


@query(f"WITH {DOUBLES} SELECT allele, seq FROM (SELECT *, row_number() OVER (PARTITION BY seq ORDER BY contains(allele, '/'), allele) AS n FROM a) WHERE n = 1 OR contains(allele, '/')")
def alleles_without_doubles(spark, d):
    name = F.concat(F.col("p_partkey").cast("string"), F.when(F.col("p_size") == 1, "/OR").otherwise(""))
    return K.without_doubles(B.table(spark, d, "part").select(name.alias("allele"), F.concat("p_name", "p_brand").alias("seq")))


@query("WITH p AS (SELECT c_nationkey AS gene, CASE WHEN c_acctbal > 9000 THEN 'CHM13#' WHEN c_acctbal > 5000 THEN 'grch38#' ELSE 'x' END || c_custkey AS path FROM customer), f AS (SELECT *, starts_with(path, 'CHM13') AS chm FROM p WHERE NOT starts_with(path, 'x')) SELECT gene, path FROM (SELECT *, bool_or(chm) OVER (PARTITION BY gene) AS has FROM f) WHERE chm = has")
def reference_backbone(spark, d):
    path = F.concat(F.when(F.col("c_acctbal") > 9000, "CHM13#").when(F.col("c_acctbal") > 5000, "grch38#").otherwise("x"), F.col("c_custkey").cast("string"))
    return K.backbone(B.table(spark, d, "customer").select(F.col("c_nationkey").alias("gene"), path.alias("path")), "gene")


BEST = "bt AS (SELECT l_partkey AS q, l_suppkey AS t, sum(l_quantity) AS m FROM lineitem GROUP BY ALL), bc AS (SELECT q, t FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY m DESC, t) AS n FROM bt) WHERE n = 1)"


def _best(spark, d):
    return K.best_contig(B.table(spark, d, "lineitem").select(F.col("l_partkey").alias("q"), F.col("l_suppkey").alias("t"), F.col("l_quantity").alias("matches")))


@query(f"WITH {BEST} SELECT q, t FROM bc")
def best_contig(spark, d):
    return _best(spark, d)


@query(f"WITH {BEST} SELECT t AS contig, min(q) AS name, p_type AS seq FROM bc JOIN part ON p_partkey = q GROUP BY t, p_type")
def contig_sequences(spark, d):
    return K.split_by_contig(B.table(spark, d, "part").select(F.col("p_partkey").alias("name"), F.col("p_type").alias("seq")), _best(spark, d))


@query(f"WITH {BEST}, h AS (SELECT DISTINCT p_partkey AS allele, l_partkey AS haplotype FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = o_custkey) SELECT DISTINCT haplotype FROM h JOIN bc AS a ON a.q = allele JOIN bc AS b ON b.q = haplotype WHERE a.t = b.t")
def haplotypes_on_contig(spark, d):
    best = _best(spark, d)
    j = B.table(spark, d, "lineitem").join(B.table(spark, d, "orders"), F.col("o_orderkey") == F.col("l_orderkey")).join(B.table(spark, d, "part"), F.col("p_partkey") == F.col("o_custkey"))
    return K.on_same_contig(best, best, j.select(F.col("p_partkey").alias("allele"), F.col("l_partkey").alias("haplotype")).distinct())


@query("WITH s AS (SELECT p_partkey, p_brand || '*' || p_type || '#0' || CASE WHEN p_size % 5 = 0 THEN '1' ELSE '' END AS name, p_brand AS gene, p_size FROM part) SELECT p_partkey, name FROM s WHERE gene IN (SELECT p_brand FROM part WHERE p_size = 50) AND p_size % 5 <> 0")
def sequences_matching(spark, d):
    p = B.table(spark, d, "part")
    name = F.concat("p_brand", F.lit("*"), "p_type", F.lit("#0"), F.when(F.col("p_size") % 5 == 0, "1").otherwise(""))
    return K.matching(p.select("p_partkey", name.alias("name")), p.where("p_size = 50").select(F.col("p_brand").alias("gene")))


@query("WITH d AS (SELECT p_brand AS gene, p_partkey AS name, p_name || p_type AS seq FROM part), u AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY gene, seq ORDER BY name) AS k FROM d) WHERE k = 1), q AS (SELECT p_brand AS gene, count(DISTINCT p_size) AS most FROM part WHERE p_size > 45 GROUP BY 1) SELECT gene, name, seq FROM (SELECT u.*, row_number() OVER (PARTITION BY gene ORDER BY length(seq) DESC, name) AS n FROM u) JOIN q USING (gene) WHERE n <= most")
def top_by_quota(spark, d):
    p = B.table(spark, d, "part")
    quota = p.where("p_size > 45").groupBy(F.col("p_brand").alias("gene")).agg(F.count_distinct("p_size").alias("most"))
    return K.top_by_quota(p.select(F.col("p_brand").alias("gene"), F.col("p_partkey").alias("name"), F.concat("p_name", "p_type").alias("seq")), quota, "gene")


@query()
def representatives(spark, d):
    """Of each brand's parts, named and typed, as many that are unlike each other as the brand has sizes; tested against a slow walk."""
    p = B.table(spark, d, "part")
    quota = p.groupBy(F.col("p_brand").alias("gene")).agg(F.count_distinct("p_size").alias("most"))
    return K.representatives(p.select(F.col("p_brand").alias("gene"), F.col("p_partkey").alias("name"), F.concat("p_name", "p_type").alias("seq")), quota, "gene", k=5)


@query(f"WITH {SEGMENTS} SELECT gene, count(*) AS n, min(length(seq)) AS shortest, CAST(round(1000 * avg(length(seq))) AS BIGINT) AS mean, max(length(seq)) AS longest FROM seg GROUP BY gene")
def sequence_stats(spark, d):
    return K.sequence_stats(B.segments(spark, d), "gene").select("gene", "n", "shortest", _milli("mean"), "longest")


@query("SELECT l_partkey AS node, CAST(round(sum(o_totalprice) * 100) AS BIGINT) AS weight FROM (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem) JOIN orders ON o_orderkey = l_orderkey GROUP BY 1")
def node_path_weights(spark, d):
    w = K.path_weights(B.steps(spark, d), B.table(spark, d, "orders").select(F.col("o_orderkey").alias("path"), F.col("o_totalprice").cast("decimal(18,2)").alias("weight")))
    return w.select("node", F.round(F.col("weight") * 100).cast("long").alias("weight"))


@query("WITH k AS (SELECT p_size AS component, count(DISTINCT p_brand) - 20 AS k FROM part GROUP BY 1) SELECT p_partkey AS node, CAST(round(1000 * CASE WHEN k > 0 THEN p_retailprice / (k / (k + 1)) ELSE p_retailprice END) AS BIGINT) AS abundance FROM part JOIN k ON component = p_size")
def component_down_weight(spark, d):
    p = B.table(spark, d, "part")
    genes = p.groupBy(F.col("p_size").alias("component")).agg((F.count_distinct("p_brand") - 20).alias("k"))
    out = K.down_weighted(p.select(F.col("p_partkey").alias("node"), F.col("p_retailprice").alias("abundance")), p.select(F.col("p_partkey").alias("node"), F.col("p_size").alias("component")), genes)
    return out.select("node", _milli("abundance"))


@query("SELECT least(l_partkey, l_suppkey) AS a, greatest(l_partkey, l_suppkey) AS b, max(greatest(l_quantity, l_linenumber * 8)) AS length FROM lineitem GROUP BY ALL")
def overlap_matrix(spark, d):
    li = B.table(spark, d, "lineitem")
    return K.overlap_lengths(li.select(F.col("l_partkey").alias("id_a"), F.col("l_suppkey").alias("id_b"), F.col("l_quantity").alias("ola"), (F.col("l_linenumber") * 8).cast("double").alias("olb")))


@query(f"WITH {SAMPLE_STEPS}, pr AS (SELECT DISTINCT x.path AS a, y.path AS b FROM ss AS x JOIN ss AS y ON x.node = y.node AND x.pos = 1 AND y.pos = 1 AND x.path < y.path), s AS (SELECT DISTINCT path, node FROM ss), n AS (SELECT path, count(*) AS n FROM s GROUP BY 1), c AS (SELECT a, b, count(*) AS n FROM pr JOIN s AS x ON x.path = a JOIN s AS y ON y.path = b AND y.node = x.node GROUP BY ALL) SELECT pr.a, pr.b, x.n - coalesce(c.n, 0) AS only_a, y.n - coalesce(c.n, 0) AS only_b FROM pr LEFT JOIN c ON c.a = pr.a AND c.b = pr.b JOIN n AS x ON x.path = pr.a JOIN n AS y ON y.path = pr.b")
def path_node_differences(spark, d):
    """Of the paths of a sample that begin with the same node."""
    s = B.sample_steps(spark, d)
    first = s.where("pos = 1").select("node", "path")
    pairs = first.select("node", F.col("path").alias("a")).join(first.select("node", F.col("path").alias("b")), "node").where("a < b").select("a", "b")
    return K.node_differences(s, pairs)


@query("SELECT l_partkey AS node, count(DISTINCT l_orderkey) AS strains, sum(l_suppkey % 3 + abs(l_linenumber - l_quantity)) AS differences, sum(greatest(l_linenumber - l_quantity, 0)) AS inserted, sum(greatest(l_quantity - l_linenumber, 0)) AS deleted FROM lineitem GROUP BY 1")
def strains_per_node(spark, d):
    li = B.table(spark, d, "lineitem")
    return K.strains_per_node(li.select(F.col("l_orderkey").alias("path"), F.col("l_partkey").alias("node"), F.col("l_quantity").alias("from_length"), F.col("l_linenumber").cast("double").alias("to_length"), (F.col("l_suppkey") % 3).alias("changed")))


@query("SELECT event_id, user_id, sum(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS segment FROM events")
def marked_segments(spark, d):
    e = B.table(spark, d, "events").select("event_id", "user_id", "event_type")
    return K.marked_segments(e, "user_id", [F.col("event_id")], F.col("event_type") == "signup").drop("event_type")


# Set operations


@query("SELECT p_name AS seq, p_brand AS gene FROM part WHERE p_size < 20 UNION ALL SELECT p_name, NULL FROM part WHERE p_size > 10")
def union_all_rows(spark, d):
    p = B.table(spark, d, "part")
    return K.united([p.where("p_size < 20").select(F.col("p_name").alias("seq"), F.col("p_brand").alias("gene")), p.where("p_size > 10").select(F.col("p_name").alias("seq"))])


@query("WITH u AS (SELECT 0 AS part, p_partkey AS id, p_name AS seq FROM part WHERE p_size < 20 UNION ALL SELECT 1, p_partkey, p_name FROM part WHERE p_size > 10) SELECT id, seq FROM (SELECT *, row_number() OVER (PARTITION BY seq ORDER BY part, id) AS n FROM u) WHERE n = 1")
def union_dedup(spark, d):
    p = B.table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("seq"), "p_size")
    return K.united_first([p.where("p_size < 20").drop("p_size"), p.where("p_size > 10").drop("p_size")], ["seq"], ["id"])


@query(f"WITH {STEPS} SELECT node FROM steps WHERE kind = 'A' AND ori = '+' INTERSECT SELECT node FROM steps WHERE kind = 'R' AND ori = '-'")
def common_nodes(spark, d):
    s = B.steps(spark, d)
    return s.where("kind = 'A' and ori = '+'").select("node").intersect(s.where("kind = 'R' and ori = '-'").select("node"))


@query(f"WITH {STEPS}, a AS (SELECT DISTINCT node FROM steps WHERE kind = 'A'), b AS (SELECT DISTINCT node FROM steps WHERE kind = 'R') SELECT count(*) FILTER (b.node IS NULL) AS only_a, count(*) FILTER (a.node IS NULL) AS only_b FROM a FULL OUTER JOIN b USING (node)")
def symmetric_difference(spark, d):
    s = B.steps(spark, d)
    a, b = s.where("kind = 'A'").select("node", F.lit(1).alias("a")).distinct(), s.where("kind = 'R'").select("node", F.lit(1).alias("b")).distinct()
    return a.join(b, "node", "full").agg(F.count_if(F.col("b").isNull()).alias("only_a"), F.count_if(F.col("a").isNull()).alias("only_b"))


@query(f"WITH {CALLS} SELECT sample, gene, allele, coverage FROM calls ORDER BY coverage DESC, sample, gene, allele LIMIT 20")
def top_strains(spark, d):
    """The report of the 20 strains with the most coverage; the limit is the feature."""
    return B.calls(spark, d).select("sample", "gene", "allele", "coverage").orderBy(F.desc("coverage"), "sample", "gene", "allele").limit(20)


# Functions on names and sequences


@query("SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN substr(p_brand, 1, 4) END AS family, replace(p_name, ' ', '/') AS gene, replace(p_name, ' ', '__') AS file, CASE WHEN p_size % 3 = 0 THEN 'HLA:01' ELSE 'HLA' END AS two, greatest(100, CAST(floor(p_size * 30 / 10 + 0.5) AS BIGINT)) AS segment, CASE p_size % 5 WHEN 0 THEN 'reference' WHEN 1 THEN 'call' WHEN 2 THEN 'allele' ELSE 'read' END AS role FROM part")
def name_functions(spark, d):
    p = B.table(spark, d, "part")
    slash = F.replace("p_name", F.lit(" "), F.lit("/"))
    size = F.col("p_size")
    path = F.when(size % 5 == 0, "GRCh38#0").when(size % 5 == 1, "S#1#x_variant_1").when(size % 5 == 2, "IMGT#1#IGHV").otherwise("read7")
    return p.select(
        "p_partkey", S.gene_family(F.when(size % 2 == 0, F.concat(F.lit("IMGT#1#"), F.substring("p_brand", 1, 4), F.lit("3*01"))).otherwise("plain")).alias("family"), S.gene_name(S.file_name(slash)).alias("gene"), S.file_name(slash).alias("file"),
        S.two_field(F.when(size % 3 == 0, "HLA:01:02:03").otherwise("HLA")).alias("two"), S.overlap_segment(size * 30).alias("segment"), S.path_role(path).alias("role"),
    )


@query("SELECT c_custkey, 'G' || c_nationkey || '*01' AS allele, c_custkey AS path, CAST(abs(round(c_acctbal, 2)) AS DOUBLE) AS coverage, 0.25 AS freq, CASE WHEN c_custkey % 2 = 0 THEN 'nearest' ELSE 'exact' END AS how FROM customer")
def call_header_fields(spark, d):
    c = B.table(spark, d, "customer")
    header = F.concat(F.lit(">G"), F.col("c_nationkey").cast("string"), F.lit("*01:path"), F.col("c_custkey").cast("string"), F.lit(" "), F.abs(F.round("c_acctbal", 2)).cast("decimal(18,2)").cast("string"), F.lit("x freq=0.25"), F.when(F.col("c_custkey") % 2 == 0, "_HammingDistBased").otherwise(""))
    return c.select("c_custkey", S.call_fields(header).alias("f")).select("c_custkey", "f.allele", F.col("f.path").cast("long").alias("path"), "f.coverage", "f.freq", "f.how")


@query("SELECT k AS key, min(a) AS allele FROM (SELECT 'G' || p_size || '*' || lpad(CAST(p_partkey % 7 AS VARCHAR), 2, '0') || ':' || p_partkey || CASE WHEN p_partkey % 2 = 0 THEN ':03#0' ELSE '' END AS a, 'G' || p_size || '*' || lpad(CAST(p_partkey % 7 AS VARCHAR), 2, '0') || ':' || substr(CAST(p_partkey AS VARCHAR), 1, 2) AS k FROM part) GROUP BY k")
def reduced_alleles(spark, d):
    """Parts as alleles of their size; every other one has #0 and a third field."""
    p, text = B.table(spark, d, "part"), lambda c: c.cast("string")
    name = F.concat(F.lit("G"), text(F.col("p_size")), F.lit("*"), F.lpad(text(F.col("p_partkey") % 7), 2, "0"), F.lit(":"), text(F.col("p_partkey")))
    full = F.when(F.col("p_partkey") % 2 == 0, F.concat(name, F.lit(":03#0"))).otherwise(name)
    return K.reduced(p.select(full.alias("allele"))).select("key", "allele")


@query("SELECT p_size, min(p_partkey) AS p_partkey FROM part GROUP BY p_size")
def first_of_key(spark, d):
    return B.table(spark, d, "part").groupBy("p_size").agg(F.min("p_partkey").alias("p_partkey"))


@query("SELECT event_id FROM events WHERE value >= 36")
def reads_long_enough(spark, d):
    return B.table(spark, d, "events").where(F.col("value") >= S.LEAST_READ).select("event_id")


@query("WITH a AS (SELECT p_partkey AS id, p_size AS g, upper(p_name) AS s FROM part), m AS (SELECT DISTINCT p_size AS g, replace(upper(p_type), 'A', 'N') AS t FROM part) SELECT id, t, regexp_matches(s || 'STANDARD', replace(t, 'N', '.')) AS found FROM a JOIN m USING (g)")
def containment_with_n(spark, d):
    p = B.table(spark, d, "part")
    t = p.select(F.col("p_size").alias("g"), F.replace(F.upper("p_type"), F.lit("A"), F.lit("N")).alias("t")).distinct()
    return p.select(F.col("p_partkey").alias("id"), F.col("p_size").alias("g"), F.concat(F.upper("p_name"), F.lit("STANDARD")).alias("s")).join(t, "g").select("id", "t", S.contains_with_n(F.col("s"), F.col("t")).alias("found"))


@query("WITH t AS (SELECT coalesce(text, '') AS s FROM documents), k AS (SELECT unnest(list_distinct(list_transform(range(1, greatest(length(s) - 2, 0) + 1), lambda i: substr(s, i, 3)))) AS kmer FROM t) SELECT kmer, count(*) AS n FROM k GROUP BY kmer")
def kmer_profile(spark, d):
    """In how many documents each three letters stand, whole texts."""
    t = B.table(spark, d, "documents").select(F.coalesce("text", F.lit("")).alias("s"))
    return t.select(F.explode(F.array_distinct(S.kmers(F.col("s"), 3))).alias("kmer")).groupBy("kmer").agg(F.count("*").alias("n"))


@query()
def longest_common_subsequence(spark, d):
    """Global alignment score of a part's name and type: matches only, no penalties; tested against a table of prefixes."""
    p = B.table(spark, d, "part")
    return p.select("p_partkey", S.common_subsequence(F.col("p_name"), F.lower("p_type")).alias("score"))


@query("SELECT p_partkey AS node, CAST(p_partkey AS VARCHAR) AS name FROM part")
def strip_orientation(spark, d):
    p = B.table(spark, d, "part")
    return p.select(F.col("p_partkey").alias("node"), S.unsigned(F.concat(F.col("p_partkey").cast("string"), F.when(F.col("p_size") % 2 == 0, "+").otherwise("-"))).alias("name"))
