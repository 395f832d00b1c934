"""Queries that bind the operators to the driver's tables, with the same in DuckDB's SQL where it can say them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import sequences as S
from ..operators import abundance as A
from ..operators import calls as C
from ..operators import cycles as Y
from ..operators import graph as G
from ..operators import haplotypes as H
from ..operators import intervals as I
from ..operators import paths as P
from ..streaming import support
from . import bindings as B
from . import call_queries, flow_queries, registry, variant_queries  # noqa: F401  (each registers its own)
from .bindings import CALLS, INTERVALS, PAIRS, SAMPLE_PAIRS, SAMPLE_STEPS, SEGMENTS, STEPS
from .registry import query

def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(registry.queries)


def oracle_sql() -> dict[str, str]:
    return dict(registry.oracles)


# Abundance


@query("SELECT p_partkey AS node, coalesce(sum(l_quantity), 0) / p_size AS abundance FROM part LEFT JOIN lineitem ON l_partkey = p_partkey GROUP BY p_partkey, p_size")
def node_abundance(spark, d):
    return A.node_abundance(B.segments(spark, d), B.steps(spark, d))


@query(
    f"WITH {STEPS}, {SEGMENTS}, r AS (SELECT path, pos, steps.node, len, sum(len) OVER (PARTITION BY path ORDER BY pos) AS upto, sum(len) OVER (PARTITION BY path) AS total FROM steps JOIN seg USING (node)), "
    "c AS (SELECT node, greatest(0, least(total - o_custkey % 13, upto) - greatest(path % 11, upto - len)) AS bases FROM r JOIN orders ON o_orderkey = path), g AS (SELECT node, sum(bases) AS bases FROM c GROUP BY node) "
    "SELECT seg.node, CASE WHEN len > 0 THEN coalesce(bases, 0) / len ELSE 0.0 END AS abundance FROM seg LEFT JOIN g USING (node)"
)
def clipped_depth(spark, d):
    """Depth from alignments that begin up to 10 bases inside their path and end up to 12 before its end."""
    seg, s = B.segments(spark, d), B.steps(spark, d).select("path", "pos", "node")
    total = s.join(seg.select("node", "len"), "node").groupBy("path").agg(F.sum("len").alias("total"))
    o = B.table(spark, d, "orders").select(F.col("o_orderkey").alias("path"), (F.col("o_custkey") % 13).alias("left"))
    ends = total.join(o, "path").select("path", (F.col("path") % 11).alias("start"), (F.col("total") - F.col("left")).alias("end"))
    return A.node_abundance(seg, A.clipped_steps(s.join(ends, "path"), seg))


@query(f"WITH {STEPS}, {PAIRS} SELECT n1, n2, count(*) AS n FROM pairs GROUP BY n1, n2")
def edge_support(spark, d):
    return A.edge_support(B.steps(spark, d))


ORIENTED = f"{STEPS}, {PAIRS}, oe AS (SELECT CASE o2 WHEN '-' THEN n2 ELSE n1 END AS n1, CASE o2 WHEN '-' THEN n1 ELSE n2 END AS n2, count(*) AS n FROM pairs GROUP BY 1, 2)"


@query(f"WITH {ORIENTED} SELECT n1, n2, n FROM oe")
def edge_support_oriented(spark, d):
    return A.edge_support(B.steps(spark, d), oriented=True)


@query(f"WITH {ORIENTED} SELECT n1, n2, n FROM oe WHERE NOT (n < 2 AND ((SELECT count(*) FROM oe AS x WHERE x.n1 = oe.n1) > 1 OR (SELECT count(*) FROM oe AS x WHERE x.n2 = oe.n2) > 1))")
def edge_filter_branching(spark, d):
    return A.edge_filter(A.edge_support(B.steps(spark, d), oriented=True), 2)


@query(f"WITH {STEPS}, {PAIRS}, e AS (SELECT DISTINCT n1, n2 FROM pairs WHERE kind = 'A'), r AS (SELECT n1, n2, count(*) AS n FROM pairs WHERE kind = 'R' GROUP BY ALL) SELECT e.n1, e.n2, coalesce(r.n, 0) AS n FROM e LEFT JOIN r ON r.n1 = e.n1 AND r.n2 = e.n2")
def edge_support_with_zeros(spark, d):
    s = B.steps(spark, d)
    w = Window.partitionBy("path").orderBy("pos")
    pairs = s.select(F.lag("node").over(w).alias("n1"), F.col("node").alias("n2"), "kind").where("n1 is not null")
    return A.with_support(pairs.where("kind = 'A'").select("n1", "n2").distinct(), pairs.where("kind = 'R'").groupBy("n1", "n2").agg(F.count("*").alias("n")))


@query(f"WITH {STEPS} SELECT n0, n1, n2, count(*) AS n FROM (SELECT lag(node, 2) OVER w AS n0, lag(node, 1) OVER w AS n1, node AS n2 FROM steps WINDOW w AS (PARTITION BY path ORDER BY pos)) WHERE n0 IS NOT NULL GROUP BY ALL")
def two_hop_support(spark, d):
    return A.two_hop_support(B.steps(spark, d))


@query("SELECT l_partkey AS node, count(DISTINCT l_orderkey) AS paths FROM lineitem GROUP BY l_partkey")
def paths_per_node(spark, d):
    return A.paths_per_node(B.steps(spark, d))


SIGNED = f"{STEPS}, sig AS (SELECT node, string_agg(DISTINCT k, ',' ORDER BY k) AS signature FROM (SELECT node, kind || CAST(pos AS VARCHAR) AS k FROM steps) GROUP BY node)"


def _signed(spark, d):
    return A.signatures(B.steps(spark, d).select("node", F.concat("kind", F.col("pos").cast("string")).alias("place")), "place")


@query(f"WITH {SIGNED} SELECT signature, node, nth FROM (SELECT signature, node, CAST(row_number() OVER (PARTITION BY signature ORDER BY node) AS INTEGER) AS nth FROM sig) WHERE nth <= 2")
def path_signature_topk(spark, d):
    return A.first_of_signature(_signed(spark, d), 2)


@query(f"WITH {SIGNED}, a AS (SELECT l_partkey AS node, sum(l_quantity) AS bases FROM lineitem GROUP BY 1) SELECT signature, CAST(round(1000 * sum(bases / p_size * p_size) / sum(p_size)) AS BIGINT) AS abundance, count(*) AS nodes FROM sig JOIN a USING (node) JOIN part ON p_partkey = node GROUP BY signature")
def signature_weighted_mean(spark, d):
    m = A.signature_mean(_signed(spark, d), A.node_abundance(B.segments(spark, d), B.steps(spark, d)), B.segments(spark, d), 1000)
    return m.select("signature", F.round("abundance").cast("long").alias("abundance"), "nodes")


@query("WITH p AS (SELECT p_brand AS gene, l_partkey AS node, count(DISTINCT l_orderkey) AS paths FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY ALL), r AS (SELECT gene, node, max(paths) OVER (PARTITION BY gene) / paths AS raw FROM p) SELECT gene, node, CASE WHEN max(raw) OVER g > min(raw) OVER g THEN (raw - min(raw) OVER g) / (max(raw) OVER g - min(raw) OVER g) END AS weight FROM r WINDOW g AS (PARTITION BY gene)")
def rarity_weights(spark, d):
    return A.rarity_weights(A.paths_per_node(B.steps(spark, d)).join(B.segments(spark, d).select("node", "gene"), "node"), "gene")


@query("SELECT paths, count(*) AS nodes FROM (SELECT count(DISTINCT l_orderkey) AS paths FROM lineitem GROUP BY l_partkey) GROUP BY paths")
def path_depth_histogram(spark, d):
    return A.paths_per_node(B.steps(spark, d)).groupBy("paths").agg(F.count("*").alias("nodes"))


@query("SELECT p_brand AS gene, CAST(round(1000 * avg(l_quantity)) AS BIGINT) AS mean, CAST(round(1000 * stddev_samp(l_quantity)) AS BIGINT) AS sd, count(*) AS n FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY p_brand")
def gene_depth_mean_sd(spark, d):
    m = A.depth_summary(B.steps(spark, d).join(B.segments(spark, d).select("node", "gene"), "node"), "gene", "aligned")
    return m.select("gene", F.round(F.col("mean") * 1000).cast("long").alias("mean"), F.round(F.col("sd") * 1000).cast("long").alias("sd"), "n")


@query("WITH c AS (SELECT p_type AS cluster, avg(CAST(p_size AS DOUBLE)) AS mean, stddev_samp(CAST(p_size AS DOUBLE)) AS sd FROM part GROUP BY 1), m AS (SELECT DISTINCT p_type AS cluster, p_brand AS gene FROM part) SELECT gene, CAST(round(1000 * avg(mean)) AS BIGINT) AS mean, CAST(round(1000 * avg(sd)) AS BIGINT) AS sd FROM m JOIN c USING (cluster) GROUP BY gene")
def cluster_depth_genes(spark, d):
    part = B.table(spark, d, "part").select(F.col("p_type").alias("cluster"), F.col("p_brand").alias("gene"), F.col("p_size").cast("double").alias("size"))
    m = A.cluster_depth_to_genes(A.depth_summary(part, "cluster", "size"), part.select("cluster", "gene"))
    return m.select("gene", F.round(F.col("mean") * 1000).cast("long").alias("mean"), F.round(F.col("sd") * 1000).cast("long").alias("sd"))


PAIRED = "p AS (SELECT CAST(sum(l_quantity) AS DOUBLE) AS estimate, CAST(p_size * 15 AS DOUBLE) AS truth FROM part JOIN lineitem ON l_partkey = p_partkey GROUP BY p_partkey, p_size)"


def _paired(spark, d):
    got = B.steps(spark, d).groupBy("node").agg(F.sum("aligned").alias("estimate"))
    return got.join(B.segments(spark, d), "node").select("estimate", (F.col("len") * 15).cast("double").alias("truth"))


@query(f"WITH {PAIRED} SELECT count(*) AS n, CAST(round(1000 * avg(abs(estimate - truth))) AS BIGINT) AS mean_abs, CAST(round(1000 * avg(abs(estimate - truth) / truth)) AS BIGINT) AS mean_rel, max(estimate - truth) AS largest, min(estimate - truth) AS smallest, count(*) FILTER (estimate > truth) AS over, count(*) FILTER (estimate < truth) AS under FROM p")
def abundance_error_summary(spark, d):
    e = A.error_summary(_paired(spark, d))
    return e.withColumns({c: F.round(F.col(c) * 1000).cast("long") for c in ("mean_abs", "mean_rel")})


@query(f"WITH {PAIRED} SELECT bin, count(*) AS n FROM (SELECT CASE WHEN estimate < truth THEN -(s + 1) ELSE s + 1 END AS bin FROM (SELECT *, CAST((abs(estimate - truth) >= 1) AS INTEGER) + CAST((abs(estimate - truth) >= 5) AS INTEGER) + CAST((abs(estimate - truth) >= 10) AS INTEGER) + CAST((abs(estimate - truth) >= 25) AS INTEGER) + CAST((abs(estimate - truth) >= 50) AS INTEGER) + CAST((abs(estimate - truth) >= 100) AS INTEGER) AS s FROM p)) GROUP BY bin")
def error_bins(spark, d):
    return A.error_bins(_paired(spark, d))


# Calls


@query(f"WITH {CALLS}, s AS (SELECT *, freq >= 0.1 AND coverage >= 2 AND coverage * 4 > max(coverage) OVER (PARTITION BY sample, gene) AS strict FROM calls) SELECT sample, gene, allele, coverage, CASE WHEN bool_or(strict) OVER (PARTITION BY sample, gene) THEN strict ELSE coverage >= 2 AND freq >= 0.2 END AS passed FROM s")
def call_pass_rule(spark, d):
    return C.passed_calls(B.calls(spark, d), ["sample", "gene"]).drop("freq")


@query(f"WITH {CALLS} SELECT sample, gene, allele, floor(coverage) / sum(coverage) OVER (PARTITION BY sample, gene) AS freq FROM calls WHERE coverage >= 10")
def call_frequency(spark, d):
    return C.frequencies(B.calls(spark, d), ["sample", "gene"], 10).select("sample", "gene", "allele", "freq")


@query("SELECT p_partkey AS node, greatest(0.1, floor(p_retailprice * 0.05 + 0.5)) AS min_depth, CAST(greatest(3, floor(p_retailprice * 0.10 + 0.5)) AS BIGINT) AS augment_depth, CAST(floor(p_size * 0.9 + 0.5) AS BIGINT) AS shortest, CAST(p_size * 3 AS BIGINT) AS longest FROM part")
def min_strain_depth(spark, d):
    low, high = S.length_window(F.col("p_size"), F.col("p_size"))
    return B.table(spark, d, "part").select(F.col("p_partkey").alias("node"), S.min_strain_depth(F.col("p_retailprice")).alias("min_depth"), S.augmentation_depth(F.col("p_retailprice")).alias("augment_depth"), low.alias("shortest"), high.alias("longest"))


@query(f"WITH {CALLS} SELECT sample, gene, greatest(count(*) FILTER (coverage >= 20), 2) AS max_strains FROM calls GROUP BY ALL")
def max_strains(spark, d):
    return C.strains(B.calls(spark, d), ["sample", "gene"], 20)


@query("SELECT p_name AS gene, p_name || ':deletion' AS allele, CAST(0 AS DOUBLE) AS coverage, false AS passed FROM (SELECT DISTINCT p_name FROM part) WHERE p_name NOT IN (SELECT p_name FROM part JOIN lineitem ON l_partkey = p_partkey WHERE l_quantity > 49)")
def missing_genes(spark, d):
    seg = B.segments(spark, d).select("node", F.col("seq").alias("gene"))
    return C.missing(seg, B.steps(spark, d).where("aligned > 49").join(seg, "node"), "gene")


@query(f"WITH {STEPS}, {SEGMENTS}, r AS (SELECT DISTINCT gene, path, node FROM steps JOIN seg USING (node) WHERE kind = 'R'), a AS (SELECT DISTINCT path AS allele, node FROM steps WHERE kind = 'A') SELECT gene, allele, count(DISTINCT path) AS reads FROM r JOIN a USING (node) GROUP BY ALL")
def phase_support_matrix(spark, d):
    return _support(spark, d)


def _support(spark, d):
    s = B.steps(spark, d).join(B.segments(spark, d).select("node", "gene"), "node")
    return C.support_matrix(s.where("kind = 'R'"), s.where("kind = 'A'").select("node", "path"), "gene")


@query(f"WITH {STEPS}, {SEGMENTS}, r AS (SELECT DISTINCT gene, path, node FROM steps JOIN seg USING (node) WHERE kind = 'R'), a AS (SELECT DISTINCT path AS allele, node FROM steps WHERE kind = 'A'), m AS (SELECT gene, allele, count(DISTINCT path) AS reads FROM r JOIN a USING (node) GROUP BY ALL), t AS (SELECT *, max(reads) OVER (PARTITION BY gene) AS top FROM m) SELECT gene, CASE WHEN count(*) > 1 OR max(reads) <= 1 THEN 'ambiguous' ELSE min(CAST(allele AS VARCHAR)) END AS allele, max(reads) AS reads FROM t WHERE reads = top GROUP BY gene")
def phase_best_allele(spark, d):
    return C.best_allele(_support(spark, d), "gene")


@query(f"WITH {STEPS}, a AS (SELECT CAST(path AS VARCHAR) AS allele, sum(aligned) AS depth, sum(CASE WHEN kind = 'A' THEN aligned ELSE 0 END) AS taken, bool_and(ori = '+') AS phased FROM steps GROUP BY path) SELECT CASE WHEN depth > 5 AND taken / depth < 0.667 THEN CASE WHEN phased THEN 'exact_' || allele ELSE 'ambiguous_exact_' || allele END ELSE allele END AS allele, CASE WHEN depth > 5 AND taken / depth < 0.667 THEN depth - taken ELSE depth END AS depth FROM a WHERE NOT (depth > 5 AND taken / depth > 0.667)")
def residual_alleles(spark, d):
    s = B.steps(spark, d).groupBy("path").agg(F.sum("aligned").alias("depth"), F.sum(F.when(F.col("kind") == "A", F.col("aligned")).otherwise(0.0)).alias("variant_depth"), F.bool_and(F.col("ori") == "+").alias("all_phased"))
    return C.residual_alleles(s.select(F.col("path").cast("string").alias("allele"), "depth", "variant_depth", "all_phased"))


# Paths and names


@query(f"WITH {STEPS}, s AS (SELECT p_partkey AS node, translate(upper(p_name), 'BDEFHIJKLMOPQRSUVWXYZ #-0123456789', 'ACGTACGTACGTACGTACGTACGTACGTACGTACG') AS seq FROM part) SELECT path, string_agg(CASE ori WHEN '-' THEN translate(reverse(seq), 'ACGT', 'TGCA') ELSE seq END, '' ORDER BY pos) AS seq FROM steps JOIN s USING (node) GROUP BY path")
def path_spell(spark, d):
    return P.spelled(B.steps(spark, d), B.segments(spark, d).withColumn("seq", _bases(F.col("seq"))))


def _bases(name):
    """A name's letters as bases, so that names can be spelled and reversed."""
    return F.translate(F.upper(name), "BDEFHIJKLMOPQRSUVWXYZ #-0123456789", "ACGTACGTACGTACGTACGTACGTACGTACGTACG")


@query(f"WITH {STEPS} SELECT path, string_agg(CAST(node AS VARCHAR) || CASE ori WHEN '-' THEN '+' ELSE '-' END, ',' ORDER BY pos DESC) AS flipped, string_agg(CAST(node AS VARCHAR), ',' ORDER BY pos) AS nodes FROM steps GROUP BY path")
def path_flip(spark, d):
    a = P.step_arrays(B.steps(spark, d))
    return a.select("path", F.array_join(S.flipped(F.col("signed")), ",").alias("flipped"), S.unsigned(F.array_join("signed", ",")).alias("nodes"))


@query("SELECT p_partkey AS node, translate(reverse(translate(upper(p_name), 'BDEFHIJKLMOPQRSUVWXYZ #-0123456789', 'ACGTACGTACGTACGTACGTACGTACGTACGTACG')), 'ACGT', 'TGCA') AS rc, CAST(NULL AS VARCHAR) AS strict FROM part")
def reverse_complement(spark, d):
    s = B.segments(spark, d)
    return s.select("node", S.reverse_complement(_bases(F.col("seq"))).alias("rc"), S.reverse_complement(F.concat("seq", F.lit("#"))).alias("strict"))


@query("SELECT o_orderkey, regexp_replace(name, '[-/][12]$', '') AS name FROM (SELECT o_orderkey, o_orderpriority || CASE WHEN o_orderkey % 3 = 0 THEN '/1' WHEN o_orderkey % 3 = 1 THEN '-2' ELSE '' END AS name FROM orders)")
def mate_suffix_strip(spark, d):
    k = F.col("o_orderkey") % 3
    name = F.concat("o_orderpriority", F.when(k == 0, "/1").when(k == 1, "-2").otherwise(""))
    return B.table(spark, d, "orders").select("o_orderkey", S.mate_free(name).alias("name"))


@query(f"WITH {STEPS}, {PAIRS}, e AS (SELECT n1, n2 FROM pairs GROUP BY ALL HAVING count(*) < 2), g AS (SELECT n1 AS a, n2 AS b FROM e UNION SELECT n2, n1 FROM e), s AS (SELECT path, pos, node, lag(node) OVER (PARTITION BY path ORDER BY pos) AS before FROM steps) SELECT path, CAST(coalesce(sum(CASE WHEN g.a IS NOT NULL THEN 1 END) OVER (PARTITION BY path ORDER BY pos), 0) AS BIGINT) AS piece, pos, node FROM s LEFT JOIN g ON before = a AND node = b")
def path_split_at_edges(spark, d):
    s = B.steps(spark, d)
    return P.split_at(s, A.edge_support(s).where("n < 2"))


@query(f"WITH {STEPS}, {SEGMENTS}, j AS (SELECT path, pos, node, ori, sum(len) OVER (PARTITION BY path ORDER BY pos) > 30 AS f, sum(len) OVER (PARTITION BY path ORDER BY pos DESC) > 30 AS b FROM steps JOIN seg USING (node)) SELECT path, pos, node, ori FROM j WHERE f AND b")
def path_trim(spark, d):
    return P.trimmed(B.steps(spark, d), B.segments(spark, d), 30)


@query(f"WITH {STEPS}, s AS (SELECT * FROM steps WHERE path IN (SELECT path FROM steps GROUP BY path HAVING sum(aligned) > 100)), n AS (SELECT node, dense_rank() OVER (ORDER BY node) - 1 AS new FROM (SELECT DISTINCT node FROM s)) SELECT path, pos, CAST(new AS BIGINT) AS node FROM s JOIN n USING (node)")
def genome_graph_renumber(spark, d):
    s = B.steps(spark, d)
    return P.genome_graph(s, s.groupBy("path").agg((F.sum("aligned") - 100).alias("abundance")))


@query(f"WITH {STEPS}, p AS (SELECT path, list(node % 4 ORDER BY pos) AS x FROM steps GROUP BY path), r AS (SELECT path, x, list_min(list_filter(range(1, len(x) + 1), lambda i: list_position(x, x[i]) < i)) AS k FROM p) SELECT path, array_to_string(CASE WHEN k IS NOT NULL AND x[k:len(x)] = x[1:len(x) - k + 1] THEN x[1:k - 1] ELSE x END, ',') AS nodes FROM r")
def tandem_trim(spark, d):
    a = P.step_arrays(B.steps(spark, d).withColumn("node", F.col("node") % 4))
    return a.select("path", F.array_join(S.tandem_trimmed(F.col("nodes")), ",").alias("nodes"))


@query(f"WITH {STEPS} SELECT DISTINCT path FROM steps WHERE node IN (SELECT p_partkey FROM part WHERE p_size = 7)")
def reads_any_node(spark, d):
    return P.reads_with_any(B.steps(spark, d), B.segments(spark, d).where("len = 7"))


@query(f"WITH {STEPS}, w AS (SELECT DISTINCT path AS key, node FROM steps), n AS (SELECT key, count(*) AS need FROM w GROUP BY key), c AS (SELECT s.key AS path, w.key, count(*) AS got FROM w AS s JOIN w USING (node) GROUP BY ALL) SELECT path, key FROM c JOIN n USING (key) WHERE got = need")
def reads_all_nodes(spark, d):
    """Every path is a key."""
    s = B.steps(spark, d)
    return P.reads_with_all(s, s.select(F.col("path").alias("key"), "node"))


@query(f"WITH {STEPS}, a AS (SELECT path, list(node ORDER BY pos) AS x FROM steps GROUP BY path), j AS (SELECT p.path AS p1, q.path AS p2, i - 1 AS start FROM (SELECT path, x, unnest(range(1, len(x) + 1)) AS i FROM a) AS p JOIN a AS q ON q.x[1] = p.x[i] AND p.path <> q.path WHERE p.x[i:i + least(len(p.x) - i + 1, len(q.x)) - 1] = q.x[1:least(len(p.x) - i + 1, len(q.x))]) SELECT p1, p2, CAST(min(start) AS INTEGER) AS start FROM j GROUP BY ALL")
def path_overlaps(spark, d):
    return P.overlaps(B.steps(spark, d))


@query("SELECT doc_id, lang FROM (SELECT doc_id, lang, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS n FROM documents) WHERE n = 1")
def dedup_first(spark, d):
    return P.first_by(B.table(spark, d, "documents").select("doc_id", "lang", F.sha2("text", 256).alias("h")), ["h"], [F.col("doc_id")]).drop("h")


@query("SELECT event_id, CASE WHEN count(*) OVER (PARTITION BY user_id) > 1 THEN user_id || '-' || row_number() OVER (PARTITION BY user_id ORDER BY event_id) ELSE CAST(user_id AS VARCHAR) END AS numbered FROM events")
def duplicate_numbering(spark, d):
    return P.numbered(B.table(spark, d, "events").select("event_id", "user_id"), "user_id", [F.col("event_id")]).select("event_id", "numbered")


# Sequences


@query("SELECT a.doc_id AS a, b.doc_id AS b FROM documents AS a JOIN documents AS b ON a.text = b.text AND a.doc_id < b.doc_id")
def sequence_exact_match(spark, d):
    t = B.table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("h"))
    return t.select(F.col("doc_id").alias("a"), "h").join(t.select(F.col("doc_id").alias("b"), "h"), "h").where("a < b").select("a", "b")


@query("SELECT item_id, doc_id FROM benchmark AS i JOIN documents AS d ON contains(d.text, i.text) AND length(i.text) > 0")
def benchmark_hits(spark, d):
    """Items found whole in a document."""
    return P.found_in(B.table(spark, d, "benchmark").select("item_id", F.col("text").alias("item")), B.table(spark, d, "documents").select("doc_id", "text"))


@query("WITH s AS (SELECT item_id AS id, upper(text) AS s FROM benchmark UNION ALL SELECT 1000000 + item_id, upper(substr(text, 5, 20)) FROM benchmark WHERE length(text) > 30) SELECT a.id AS \"inner\", b.id AS \"outer\" FROM s AS a JOIN s AS b ON a.id <> b.id AND contains(b.s, a.s) AND (length(b.s) > length(a.s) OR b.id > a.id)")
def sequence_containment(spark, d):
    b = B.table(spark, d, "benchmark")
    s = b.select(F.col("item_id").alias("id"), F.col("text").alias("seq")).unionByName(b.where(F.length("text") > 30).select((F.col("item_id") + 1000000).alias("id"), F.substring("text", 5, 20).alias("seq")))
    return P.contained(s)


@query("WITH q AS (SELECT p_partkey AS id, p_brand AS gene, p_type || p_brand AS s FROM part WHERE p_size < 10), c AS (SELECT DISTINCT p_brand AS gene, p_type AS name, p_type || p_brand AS s FROM part WHERE p_size >= 40), j AS (SELECT id, name, hamming(q.s, c.s) AS distance FROM q JOIN c ON q.gene = c.gene AND length(q.s) = length(c.s)), m AS (SELECT *, min(distance) OVER (PARTITION BY id) AS low FROM j) SELECT id, string_agg(DISTINCT name, ' or ' ORDER BY name) AS name, CAST(min(distance) AS INTEGER) AS distance FROM m WHERE distance = low GROUP BY id")
def nearest_by_hamming(spark, d):
    p = B.table(spark, d, "part")
    s = F.concat("p_type", "p_brand")
    q = p.where("p_size < 10").select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("gene"), s.alias("qs"))
    c = p.where("p_size >= 40").select(F.col("p_brand").alias("gene"), F.col("p_type").alias("name"), s.alias("cs")).distinct()
    return C.nearest(q, c, S.hamming(F.col("qs"), F.col("cs")), ["gene"])


@query("WITH q AS (SELECT p_partkey AS id, p_brand AS gene, p_type AS s FROM part WHERE p_size < 10), c AS (SELECT DISTINCT p_brand AS gene, p_type AS name FROM part WHERE p_size >= 40), j AS (SELECT id, name, levenshtein(s, name) AS distance FROM q JOIN c USING (gene)), m AS (SELECT *, min(distance) OVER (PARTITION BY id) AS low FROM j) SELECT id, string_agg(DISTINCT name, ' or ' ORDER BY name) AS name, CAST(min(distance) AS INTEGER) AS distance FROM m WHERE distance = low GROUP BY id")
def nearest_by_levenshtein(spark, d):
    p = B.table(spark, d, "part")
    q = p.where("p_size < 10").select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("gene"), F.col("p_type").alias("qs"))
    c = p.where("p_size >= 40").select(F.col("p_brand").alias("gene"), F.col("p_type").alias("name")).distinct()
    return C.nearest(q, c, F.levenshtein("qs", "name"), ["gene"])


# Graph


@query(f"WITH {STEPS}, {PAIRS}, e AS (SELECT DISTINCT n1, n2 FROM pairs WHERE n1 <> n2) SELECT n1, n2 FROM e WHERE EXISTS (SELECT 1 FROM e AS x JOIN e AS y ON x.n2 = y.n1 WHERE x.n1 = e.n1 AND y.n2 = e.n2)")
def transitive_edges(spark, d):
    return G.transitive_edges(A.edge_support(B.steps(spark, d)))


@query(f"WITH {STEPS}, {PAIRS}, e AS (SELECT DISTINCT least(n1, n2) AS a, greatest(n1, n2) AS b FROM pairs WHERE n1 <> n2) SELECT x.a, x.b, y.b AS c FROM e AS x JOIN e AS y ON x.a = y.a AND x.b < y.b JOIN e AS z ON z.a = x.b AND z.b = y.b")
def triangles(spark, d):
    return G.triangles(A.edge_support(B.steps(spark, d)))


@query(f"WITH {STEPS}, {PAIRS}, e AS (SELECT DISTINCT n1, n2 FROM pairs WHERE n1 <> n2), i AS (SELECT n2 FROM e GROUP BY n2 HAVING count(*) > 2), o AS (SELECT n1, count(*) AS outs FROM e GROUP BY n1), near AS (SELECT e.n1, e.n2, outs FROM e JOIN i USING (n2) JOIN o USING (n1)), u AS (SELECT n1, n2 FROM e UNION SELECT n2, n1 FROM e), q AS (SELECT DISTINCT x.n1, x.n2 FROM near AS x JOIN near AS y ON x.n2 = y.n2 AND x.n1 <> y.n1 JOIN u ON u.n1 = x.n1 AND u.n2 = y.n1), k AS (SELECT near.n1, near.n2, q.n1 IS NOT NULL OR outs = 1 AS good FROM near LEFT JOIN q ON q.n1 = near.n1 AND q.n2 = near.n2) SELECT n1, n2 FROM (SELECT *, bool_or(good) OVER (PARTITION BY n2) AS has FROM k) WHERE has AND NOT good")
def branch_cliques(spark, d):
    return G.branch_check(A.edge_support(B.steps(spark, d)))


@query(f"WITH {STEPS}, {PAIRS}, {SEGMENTS} SELECT n1, seq, count(*) AS nodes FROM (SELECT DISTINCT n1, n2 FROM pairs) JOIN seg ON node = n2 GROUP BY ALL HAVING count(*) > 1")
def duplicate_siblings(spark, d):
    return G.duplicate_siblings(A.edge_support(B.steps(spark, d)), B.segments(spark, d))


def _edges(spark, d):
    """All edges, of every path and return flag."""
    return A.edge_support(B.steps(spark, d)).select("n1", "n2")


SAMPLE = f"{SAMPLE_STEPS}, {SAMPLE_PAIRS}"


def _sample_edges(spark, d):
    """All edges of every sample's own graph."""
    return A.adjacent(B.sample_steps(spark, d)).select("n1", "n2")


@query(f"WITH RECURSIVE {SAMPLE}, u AS (SELECT n1 AS a, n2 AS b FROM sp UNION SELECT n2, n1 FROM sp), r AS (SELECT a AS node, a AS c FROM u UNION SELECT u.b, r.c FROM r JOIN u ON u.a = r.node) SELECT node, min(c) AS component FROM r GROUP BY node")
def components(spark, d):
    return G.components(_sample_edges(spark, d), B.SAMPLE)


@query(
    f"WITH RECURSIVE {SAMPLE}, e AS (SELECT DISTINCT n1, n2 FROM sp), nd AS (SELECT n1 AS node FROM e UNION SELECT n2 FROM e), cl AS (SELECT n1 AS a, n2 AS b FROM e UNION SELECT cl.a, e.n2 FROM cl JOIN e ON e.n1 = cl.b), "
    "cy AS (SELECT a AS node FROM cl WHERE a = b UNION SELECT x.b FROM cl AS x JOIN cl AS y ON y.a = x.a AND y.b = x.a), f AS (SELECT n1, n2 FROM e WHERE n1 NOT IN (SELECT node FROM cy) AND n2 NOT IN (SELECT node FROM cy)), "
    "r AS (SELECT node, 0 AS level FROM nd WHERE node NOT IN (SELECT n2 FROM e) UNION SELECT f.n2, r.level + 1 FROM r JOIN f ON f.n1 = r.node) SELECT nd.node, coalesce(CAST(max(level) AS INTEGER), -1) AS level FROM nd LEFT JOIN r ON r.node = nd.node GROUP BY nd.node"
)
def topological_levels(spark, d):
    """Along all edges; nodes in or behind a cycle have level -1."""
    return G.topological_levels(_sample_edges(spark, d), B.SAMPLE)


@query(f"WITH {STEPS}, {PAIRS}, u AS (SELECT n1, n2 FROM pairs UNION SELECT n2, n1 FROM pairs), s AS (SELECT node FROM (SELECT p_partkey AS node FROM part WHERE p_size = 1)), one AS (SELECT DISTINCT u.n2 AS node FROM s JOIN u ON u.n1 = s.node WHERE u.n2 NOT IN (SELECT node FROM s)), two AS (SELECT DISTINCT u.n2 AS node FROM one JOIN u ON u.n1 = one.node WHERE u.n2 NOT IN (SELECT node FROM s) AND u.n2 NOT IN (SELECT node FROM one)) SELECT node, 0 AS hop FROM s UNION ALL SELECT node, 1 FROM one UNION ALL SELECT node, 2 FROM two")
def neighbourhood_bfs(spark, d):
    return G.neighbourhood(A.edge_support(B.steps(spark, d)), B.segments(spark, d).where("len = 1"), 2)


@query()
def chain_compression(spark, d):
    return G.chains(_edges(spark, d))


@query()
def components_whole(spark, d):
    """Over the edges of all parts, nearly all in one component; SQL lists every pair of joined nodes and is too slow for that."""
    return G.components(_edges(spark, d))


@query()
def topological_levels_whole(spark, d):
    """Over the edges of all parts; recursive SQL does not end on their cycles."""
    return G.topological_levels(_edges(spark, d))


# Variants


@query(f"WITH {STEPS}, {SEGMENTS}, m AS (SELECT DISTINCT node, gene FROM steps JOIN seg USING (node) WHERE kind = 'A'), t AS (SELECT min(gene) AS g FROM seg) SELECT DISTINCT node FROM m, t WHERE gene <> g AND node NOT IN (SELECT node FROM m, t WHERE gene = g)")
def off_target_nodes(spark, d):
    seg = B.segments(spark, d)
    m = B.steps(spark, d).where("kind = 'A'").select("node").distinct().join(seg.select("node", "gene"), "node").join(F.broadcast(seg.agg(F.min("gene").alias("g"))))
    return C.off_target(m, F.col("gene") == F.col("g"))


@query(f"WITH {STEPS} SELECT DISTINCT node FROM steps WHERE kind = 'R' EXCEPT SELECT node FROM steps WHERE kind = 'A'")
def target_only_nodes(spark, d):
    s = B.steps(spark, d)
    return s.where("kind = 'R'").select("node").distinct().join(s.where("kind = 'A'").select("node"), "node", "left_anti")


@query("SELECT l_partkey AS node, count(*) AS n FROM lineitem GROUP BY 1 HAVING count(*) >= 2")
def node_seen_twice(spark, d):
    return C.seen_twice(B.steps(spark, d), "node")


KINDS = f"{STEPS}, known AS (SELECT DISTINCT node FROM steps WHERE kind = 'A'), rp AS (SELECT * FROM (SELECT path, lag(node) OVER (PARTITION BY path ORDER BY pos) AS n1, node AS n2 FROM steps WHERE kind = 'R') WHERE n1 IS NOT NULL), ap AS (SELECT * FROM (SELECT lag(node) OVER (PARTITION BY path ORDER BY pos) AS n1, node AS n2 FROM steps WHERE kind = 'A') WHERE n1 IS NOT NULL)"


@query(f"WITH {KINDS}, e AS (SELECT DISTINCT n1, n2 FROM rp), x AS (SELECT n1 AS node, n2 AS other FROM e UNION ALL SELECT n2, n1 FROM e), g AS (SELECT x.node, count(*) AS ends, count(k.node) AS touching FROM x LEFT JOIN known AS k ON k.node = x.other GROUP BY x.node) SELECT node, ends, touching FROM g WHERE ends >= 2 AND touching >= 2 AND node NOT IN (SELECT node FROM known)")
def novel_nodes(spark, d):
    s = B.steps(spark, d)
    return C.novel_nodes(s.where("kind = 'R'"), s.where("kind = 'A'"))


@query(f"WITH {KINDS} SELECT n1, n2, count(*) AS n FROM rp WHERE n1 IN (SELECT node FROM known) AND n2 IN (SELECT node FROM known) AND NOT EXISTS (SELECT 1 FROM ap WHERE ap.n1 = rp.n1 AND ap.n2 = rp.n2) GROUP BY ALL HAVING count(*) > 0")
def deletion_pairs(spark, d):
    s = B.steps(spark, d)
    return C.deletions(s.where("kind = 'R'"), s.where("kind = 'A'"), 0)


@query(f"WITH {STEPS}, weak AS (SELECT node FROM steps GROUP BY node HAVING sum(aligned) < 500), held AS (SELECT DISTINCT node FROM steps WHERE pos >= 7) SELECT path, pos, node FROM steps WHERE node NOT IN (SELECT node FROM weak WHERE node NOT IN (SELECT node FROM held))")
def pruned_paths(spark, d):
    s = B.steps(spark, d)
    return C.pruned_paths(s, s.groupBy("node").agg(F.sum("aligned").alias("n")).where("n < 500"), F.col("pos") >= 7).select("path", "pos", "node")


# Intervals and streams


@query(f'WITH {INTERVALS}, a AS (SELECT *, max("end") OVER (PARTITION BY key ORDER BY "start", "end", id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM iv), b AS (SELECT *, sum(CASE WHEN reach IS NULL OR "start" > reach + 100 THEN 1 ELSE 0 END) OVER (PARTITION BY key ORDER BY "start", "end", id) AS island FROM a) SELECT key, min("start") AS "start", max("end") AS "end", count(*) AS n FROM b GROUP BY key, island')
def interval_merge(spark, d):
    return I.merged(B.intervals(spark, d), 100, 86_400)


@query(f'WITH {INTERVALS} SELECT a.id AS left_id, b.id AS right_id FROM iv AS a JOIN iv AS b ON a.key = b.key AND a."end" > a."start" AND b."end" > b."start" AND a."start" < b."end" AND b."start" < a."end"')
def interval_overlap_join(spark, d):
    iv = B.intervals(spark, d)
    return I.overlapping(iv, iv, 3600)


@query("SELECT l_partkey AS node, sum(l_quantity) AS bases, count(*) AS steps FROM lineitem GROUP BY 1")
def running_node_support(spark, d):
    return support.node_support(B.steps(spark, d))


@query("SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n FROM events GROUP BY ALL")
def windowed_events(spark, d):
    return support.windowed(B.table(spark, d, "events"))


# Fits, one group each


def _members(spark, d):
    """(sample, path, node, abundance): for each customer's orders, the parts' quantities in all of them."""
    o = B.table(spark, d, "orders").select(F.col("o_orderkey").alias("path"), F.col("o_custkey").alias("sample"))
    s = B.steps(spark, d).select("path", "node", "aligned").join(o, "path")
    total = s.groupBy("sample", "node").agg(F.sum("aligned").alias("abundance"))
    return s.select("sample", "path", "node").distinct().join(total, ["sample", "node"])


@query()
def fit_abundance(spark, d):
    return H.fitted(_members(spark, d), "sample", kind=5)


@query()
def haplotypes(spark, d):
    return H.chosen(_members(spark, d), "sample", 2)


@query()
def greedy_paths(spark, d):
    """Of every sample's edges, less those that close a cycle."""
    e = A.adjacent(B.sample_steps(spark, d)).where("n1 <> n2").groupBy("n1", "n2").agg(F.count("*").cast("double").alias("flow"))
    return H.peeled(H.ranked(e.select(F.floor(F.col("n1") / 100).cast("long").alias("sample"), "n1", "n2", "flow"), "sample"), "sample", 1)


@query()
def broken_cycles(spark, d):
    """The edges of all parts without cycles; those between two components all stay."""
    return Y.acyclic(_edges(spark, d))
