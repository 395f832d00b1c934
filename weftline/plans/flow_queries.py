"""Queries from overlaps to flows and back to paths, and graph queries of each sample's own graph."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import abundance as A
from ..operators import calls as C
from ..operators import cleaning as K
from ..operators import cycles as Y
from ..operators import flow as W
from ..operators import graph as G
from ..operators import haplotypes as H
from ..operators import low_nodes as L
from ..operators import paths as P
from ..operators.lineage import cut
from . import bindings as B
from .bindings import SAMPLE_PAIRS, SAMPLE_SEGMENTS, SAMPLE_STEPS
from .registry import query

LOW = 15


def _begin(x: str, y: str) -> str:
    """SQL of where list y begins in list x, as in flow._begin()."""
    first = f"list_position(list_transform({y}, lambda e: e.l), false)"
    same = f"{x}[i + k].l OR {y}[{first} + k].l OR ({x}[i + k].n = {y}[{first} + k].n AND {x}[i + k].o = {y}[{first} + k].o)"
    fits = f"len(list_filter(range(0, least(len({x}) - i, len({y}) - {first}) + 1), lambda k: NOT ({same}))) = 0"
    return f"list_min(list_filter(range(1, len({x}) + 1), lambda i: {x}[i].n = {y}[{first}].n AND i >= {first} AND {fits})) - {first}"


def _turned(x: str) -> str:
    return f"list_transform(list_reverse({x}), lambda e: {{'n': e.n, 'o': CASE e.o WHEN '-' THEN '+' ELSE '-' END, 'l': e.l}})"


OVERLAPS = f"""{SAMPLE_STEPS}, lo AS (SELECT node FROM ss GROUP BY node HAVING sum(aligned) < {LOW}),
sx AS (SELECT path, list({{'n': ss.node, 'o': ori, 'l': lo.node IS NOT NULL}} ORDER BY pos) AS x FROM ss LEFT JOIN lo ON lo.node = ss.node WHERE role = 'read' GROUP BY path),
rd AS (SELECT DISTINCT path, node FROM ss WHERE role = 'read'),
pp AS (SELECT DISTINCT a.path AS c1, b.path AS c2, CASE WHEN (a.path + b.path) % 2 = 0 THEN '+' ELSE '-' END AS way FROM rd AS a JOIN rd AS b ON a.node = b.node AND a.path <> b.path),
oj AS (SELECT c1, c2, way, p.x AS x1, q.x AS x2, {_turned('q.x')} AS y2, {_turned('p.x')} AS y1 FROM pp JOIN sx AS p ON p.path = c1 JOIN sx AS q ON q.path = c2),
of AS (SELECT *, CASE way WHEN '+' THEN {_begin('x1', 'x2')} ELSE {_begin('x1', 'y2')} END AS fwd FROM oj),
ob AS (SELECT *, CASE WHEN way = '-' AND fwd IS NULL THEN {_begin('y1', 'x2')} END AS rev FROM of),
ov AS (SELECT c1, c2, CAST(coalesce(fwd, rev) AS INTEGER) AS start, CASE WHEN way = '+' THEN '++' WHEN fwd IS NOT NULL THEN '+-' ELSE '-+' END AS ori FROM ob WHERE coalesce(fwd, rev) IS NOT NULL)"""


def _overlaps(spark, d):
    """(overlaps, reads' steps) of each sample's reads that share a node, proposed one way or the other by their numbers."""
    s = cut(B.sample_steps(spark, d))
    low = s.groupBy("node").agg(F.sum("aligned").alias("n")).where(F.col("n") < LOW).select("node")
    r = s.where("role = 'read'")
    at = r.select("path", "node").distinct()
    pairs = at.select(F.col("path").alias("c1"), "node").join(at.select(F.col("path").alias("c2"), "node"), "node").where("c1 <> c2").select("c1", "c2").distinct()
    proposed = pairs.withColumn("way", F.when((F.col("c1") + F.col("c2")) % 2 == 0, "+").otherwise("-"))
    return W.overlaps(r, proposed, low), r


@query(f"WITH {OVERLAPS} SELECT c1, c2, start, ori FROM ov")
def oriented_overlaps(spark, d):
    return _overlaps(spark, d)[0]


ORIENTED = f"""{OVERLAPS}, ln AS (SELECT path, CAST(max(pos) AS INTEGER) AS n FROM ss WHERE role = 'read' GROUP BY path),
de AS (SELECT c1 * 2 + CASE substr(ori, 1, 1) WHEN '-' THEN 1 ELSE 0 END AS a, c2 * 2 + CASE substr(ori, 2, 1) WHEN '-' THEN 1 ELSE 0 END AS b FROM ov UNION SELECT c1 * 2 + CASE substr(ori, 1, 1) WHEN '-' THEN 0 ELSE 1 END, c2 * 2 + CASE substr(ori, 2, 1) WHEN '-' THEN 0 ELSE 1 END FROM ov),
du AS (SELECT a, b FROM de UNION SELECT b, a FROM de), dc AS (SELECT a AS node, a AS c FROM du UNION SELECT du.b, dc.c FROM dc JOIN du ON du.a = dc.node),
dl AS (SELECT node, min(c) AS c FROM dc GROUP BY node), os AS (SELECT p.node // 2 AS contig, CASE WHEN p.c <= m.c THEN '+' ELSE '-' END AS sign FROM dl AS p JOIN dl AS m ON m.node = p.node + 1 WHERE p.node % 2 = 0),
od AS (SELECT ov.*, a.sign AS g1, b.sign AS g2, x.n AS n1, y.n AS n2, substr(ori, 1, 1) AS s1, substr(ori, 2, 1) AS s2 FROM ov JOIN os AS a ON a.contig = c1 JOIN os AS b ON b.contig = c2 JOIN ln AS x ON x.path = c1 JOIN ln AS y ON y.path = c2),
oo AS (SELECT c1, c2, start, ori FROM od WHERE s1 = g1 AND s2 = g2 UNION ALL SELECT c2, c1, CAST(n2 - n1 + start AS INTEGER), g2 || g1 FROM od WHERE s1 <> g1 AND s2 <> g2)"""


@query(f"WITH RECURSIVE {ORIENTED} SELECT c1, c2, start, ori FROM oo")
def contig_orientation(spark, d):
    o, r = _overlaps(spark, d)
    return W.oriented(o, r.groupBy("path").agg(F.max("pos").alias("n")), r.select("path", "sample").distinct())


@query()
def contig_order(spark, d):
    """The order in which each sample's reads are laid out, from the longest on; tested against one after another."""
    o, r = _overlaps(spark, d)
    return W.contig_order(r.groupBy("sample", F.col("path").alias("c")).agg(F.max("pos").alias("len")), o, "sample")


FLOWS = f"{OVERLAPS}, cg AS (SELECT path AS c, 2 * (row_number() OVER (ORDER BY path) - 1) + 2 AS i FROM (SELECT DISTINCT path FROM ss WHERE role = 'read')), oe AS (SELECT DISTINCT c1, c2 FROM ov), fg AS (SELECT i AS src, i + 1 AS dst, 1 AS weight, 'contig' AS kind, c AS c1, c AS c2 FROM cg UNION ALL SELECT x.i + 1, y.i, -1, 'overlap', c1, c2 FROM oe JOIN cg AS x ON x.c = c1 JOIN cg AS y ON y.c = c2 UNION ALL SELECT i + 1, 1, 0, 'sink', c, NULL FROM cg WHERE c NOT IN (SELECT c1 FROM oe) UNION ALL SELECT 0, i, 0, 'source', NULL, c FROM cg WHERE c NOT IN (SELECT c2 FROM oe))"


def _flow_graph(spark, d):
    o, r = _overlaps(spark, d)
    return W.flow_graph(r.select(F.col("path").alias("c")).distinct(), o), o, r


@query(f"WITH {FLOWS} SELECT src, dst, weight, kind, coalesce(c1, -1) AS c1, coalesce(c2, -1) AS c2 FROM fg")
def flow_graph(spark, d):
    return _flow_graph(spark, d)[0].fillna(-1, ["c1", "c2"])


@query(f"WITH {FLOWS}, fl AS (SELECT src, dst, (src * 7 + dst) % 100 / 4.0 AS flow FROM fg) SELECT c1 AS c, CAST(flow AS DOUBLE) AS abundance FROM fg JOIN fl USING (src, dst) WHERE kind = 'contig'")
def contig_flow_abundance(spark, d):
    g = _flow_graph(spark, d)[0]
    return W.contig_flows(g, g.select("src", "dst", ((F.col("src") * 7 + F.col("dst")) % 100 / 4.0).alias("flow")))


NODE_EDGES = f"{OVERLAPS}, rs AS (SELECT path, pos, node FROM ss WHERE role = 'read'), rn AS (SELECT path, max(pos) AS last FROM rs GROUP BY path), ne AS (SELECT DISTINCT node, path AS c1, path AS c2, 1 AS weight FROM rs UNION ALL SELECT DISTINCT node, c1, c2, -1 FROM (SELECT node, c1, c2, start, b.last AS n2, CASE substr(ori, 1, 1) WHEN '-' THEN a.last - pos ELSE pos - 1 END AS place FROM ov JOIN rn AS a ON a.path = c1 JOIN rn AS b ON b.path = c2 JOIN rs ON rs.path = c1) WHERE place >= start AND place < start + n2)"


@query(f"WITH {NODE_EDGES} SELECT node, c1, c2, weight FROM ne")
def node_flow_edges(spark, d):
    o, r = _overlaps(spark, d)
    return W.node_edges(r, o)


@query(
    f"WITH {OVERLAPS}, rs AS (SELECT path, pos, node, ori FROM ss WHERE role = 'read'), rn AS (SELECT path, max(pos) AS n FROM rs GROUP BY path), "
    "a AS (SELECT c1 * 10000000 + c2 AS path, CASE substr(ov.ori, 1, 1) WHEN '-' THEN n - pos ELSE pos - 1 END AS pos, node, CASE substr(ov.ori, 1, 1) WHEN '-' THEN CASE rs.ori WHEN '+' THEN '-' ELSE '+' END ELSE rs.ori END AS ori FROM ov JOIN rs ON rs.path = c1 JOIN rn ON rn.path = c1), "
    "b AS (SELECT c1 * 10000000 + c2 AS path, start + CASE substr(ov.ori, 2, 1) WHEN '-' THEN q.n - pos ELSE pos - 1 END AS pos, node, CASE substr(ov.ori, 2, 1) WHEN '-' THEN CASE rs.ori WHEN '+' THEN '-' ELSE '+' END ELSE rs.ori END AS ori, p.n AS covered FROM ov JOIN rs ON rs.path = c2 JOIN rn AS p ON p.path = c1 JOIN rn AS q ON q.path = c2) "
    "SELECT path, CAST(pos AS BIGINT) AS pos, node, ori FROM a UNION ALL SELECT path, CAST(pos AS BIGINT), node, ori FROM b WHERE pos >= covered"
)
def contig_path_nodes(spark, d):
    """Node paths of all paths of two overlapping contigs."""
    o, r = _overlaps(spark, d)
    path = F.col("c1") * 10000000 + F.col("c2")
    paths = o.select(path.alias("path"), F.lit(0).alias("nth"), F.col("c1").alias("contig")).unionByName(o.select(path.alias("path"), F.lit(1).alias("nth"), F.col("c2").alias("contig")))
    return W.joined_steps(paths, o, r)


EDGES = f"{SAMPLE_STEPS}, {SAMPLE_PAIRS}"


def _of_role(spark, d, role):
    """(sample, n1, n2): all of a role's edges."""
    s = B.sample_steps(spark, d)
    return s, A.adjacent(s.where(F.col("role") == role)).where("n1 <> n2").select(F.floor(F.col("n1") / 100).cast("long").alias("sample"), "n1", "n2").distinct()


@query(f"WITH RECURSIVE {EDGES}, e AS (SELECT DISTINCT sample, n1, n2 FROM sp WHERE role = 'read' AND n1 <> n2), p AS (SELECT sample, [n1] AS nodes, n1 AS node FROM (SELECT DISTINCT sample, n1 FROM e WHERE n1 NOT IN (SELECT n2 FROM e)) UNION ALL SELECT p.sample, list_append(nodes, e.n2), e.n2 FROM p JOIN e ON e.n1 = p.node WHERE len(nodes) <= 6 AND NOT list_contains(nodes, e.n2)) SELECT sample, array_to_string(nodes, ',') AS nodes FROM p WHERE len(nodes) > 1 AND node NOT IN (SELECT n1 FROM e) UNION ALL SELECT DISTINCT sample, CAST(node AS VARCHAR) FROM ss WHERE role = 'read' AND node NOT IN (SELECT n1 FROM e UNION SELECT n2 FROM e)")
def path_enumeration_bounded(spark, d):
    s, e = _of_role(spark, d, "read")
    return W.enumerated(e, "sample", 6, s.where("role = 'read'").select("sample", "node")).select("sample", F.array_join("nodes", ",").alias("nodes"))


EXTREME = "SELECT {a} AS node FROM e WHERE {a} NOT IN (SELECT {b} FROM e)"


@query(f"WITH RECURSIVE {EDGES}, {SAMPLE_SEGMENTS}, e AS (SELECT DISTINCT n1, n2 FROM sp WHERE role = 'allele' AND n1 <> n2), f AS (SELECT node, len AS depth FROM sg WHERE len < 8 AND node IN ({EXTREME.format(a='n1', b='n2')}) UNION SELECT e.n2, f.depth + g.len FROM f JOIN e ON e.n1 = f.node JOIN sg AS g ON g.node = e.n2 WHERE f.depth + g.len < 8), b AS (SELECT node, len AS depth FROM sg WHERE len < 8 AND node IN ({EXTREME.format(a='n2', b='n1')}) UNION SELECT e.n1, b.depth + g.len FROM b JOIN e ON e.n2 = b.node JOIN sg AS g ON g.node = e.n1 WHERE b.depth + g.len < 8) SELECT node FROM f UNION SELECT node FROM b")
def extremity_nodes(spark, d):
    s, e = _of_role(spark, d, "allele")
    return W.extremities(e, B.sample_segments(s), 8, "sample")


@query(f"WITH RECURSIVE {EDGES}, {SAMPLE_SEGMENTS}, u AS (SELECT n1, n2 FROM sp WHERE role = 'allele' UNION SELECT n2, n1 FROM sp WHERE role = 'allele'), r AS (SELECT DISTINCT node, 0 AS distance, 0 AS len FROM ss WHERE node % 100 = 1 UNION SELECT u.n2, r.distance + r.len, g.len FROM r JOIN u ON u.n1 = r.node AND u.n1 <> u.n2 JOIN sg AS g ON g.node = u.n2 WHERE r.distance + r.len <= 6) SELECT node, CAST(min(distance) AS BIGINT) AS distance FROM r GROUP BY node")
def neighbourhood_bases(spark, d):
    s = B.sample_steps(spark, d)
    return G.within_bases(A.adjacent(s.where("role = 'allele'")), B.sample_segments(s), s.where("node % 100 = 1"), 6)


@query(f"WITH RECURSIVE {EDGES}, u AS (SELECT DISTINCT n1, n2 FROM sp WHERE n1 <> n2), r AS (SELECT DISTINCT node AS a, node AS b FROM ss WHERE node % 100 = 3 UNION SELECT r.a, u.n2 FROM r JOIN u ON u.n1 = r.b) SELECT b AS node, count(*) AS n FROM r GROUP BY b")
def reachability(spark, d):
    """How many of the start nodes (one a sample) each node is reached from, along all edges."""
    s = B.sample_steps(spark, d)
    e = A.adjacent(s).where("n1 <> n2").select("n1", "n2").distinct()
    start = s.where("node % 100 = 3").select("node").distinct()
    return G.reached(e, start).groupBy("node").agg(F.count("*").alias("n"))


SIMPLE = f"{EDGES}, e AS (SELECT DISTINCT n1, o1, n2, o2 FROM sp WHERE role = 'reference' AND n1 <> n2), s1 AS (SELECT * FROM e WHERE n1 IN (SELECT n1 FROM e GROUP BY n1 HAVING count(*) = 1) AND n2 IN (SELECT n2 FROM e GROUP BY n2 HAVING count(*) = 1)), se AS (SELECT s1.* FROM s1 LEFT JOIN s1 AS b ON b.n2 = s1.n1 WHERE b.o2 IS NULL OR b.o2 = s1.o1)"


def _reference_edges(spark, d):
    s = cut(B.sample_steps(spark, d))
    return s, cut(A.adjacent(s.where("role = 'reference'")).select("n1", "o1", "n2", "o2").distinct())


@query(f"WITH {SIMPLE} SELECT n1, o1, n2, o2 FROM se")
def simple_edges(spark, d):
    return G.simple_edges(_reference_edges(spark, d)[1])


@query(
    f"WITH RECURSIVE {SIMPLE}, {SAMPLE_SEGMENTS}, cl AS (SELECT n1 AS a, n2 AS b FROM se UNION SELECT cl.a, se.n2 FROM cl JOIN se ON se.n1 = cl.b), rg AS (SELECT a AS node, (SELECT min(x.b) FROM cl AS x WHERE x.a = cl.a) AS low FROM cl WHERE a = b), sc AS (SELECT * FROM se WHERE n2 NOT IN (SELECT low FROM rg)), "
    "nd AS (SELECT n1 AS node FROM sp WHERE role = 'reference' UNION SELECT n2 FROM sp WHERE role = 'reference'), rc AS (SELECT node AS head, node, 0 AS rank, coalesce((SELECT o1 FROM se WHERE se.n1 = nd.node), '+') AS ori FROM nd WHERE node NOT IN (SELECT n2 FROM sc) UNION ALL SELECT rc.head, sc.n2, rc.rank + 1, sc.o2 FROM rc JOIN sc ON sc.n1 = rc.node), "
    "ab AS (SELECT node, sum(aligned) AS bases FROM ss GROUP BY node), th AS (SELECT head, count(DISTINCT path) AS paths FROM rc JOIN ss USING (node) GROUP BY head) "
    "SELECT rc.head, count(*) AS nodes, CAST(sum(len) AS BIGINT) AS len, string_agg(CASE ori WHEN '-' THEN translate(reverse(seq), 'ACGT', 'TGCA') ELSE seq END, '' ORDER BY rank) AS seq, CAST(round(1000 * sum(bases) / sum(len)) AS BIGINT) AS abundance, max(paths) AS paths FROM rc JOIN sg USING (node) JOIN ab USING (node) JOIN th ON th.head = rc.head GROUP BY rc.head"
)
def merged_chains(spark, d):
    s, e = _reference_edges(spark, d)
    seg = B.sample_segments(s)
    out = G.merged_chains(e, seg, A.node_abundance(seg, s), s, B.SAMPLE)
    return out.withColumn("abundance", F.round(F.col("abundance") * 1000).cast("long"))


PLACED = f"{SIMPLE}, cl AS (SELECT n1 AS a, n2 AS b FROM se UNION SELECT cl.a, se.n2 FROM cl JOIN se ON se.n1 = cl.b), rg AS (SELECT a AS node, (SELECT min(x.b) FROM cl AS x WHERE x.a = cl.a) AS low FROM cl WHERE a = b), sc AS (SELECT * FROM se WHERE n2 NOT IN (SELECT low FROM rg)), nd AS (SELECT n1 AS node FROM sp WHERE role = 'reference' UNION SELECT n2 FROM sp WHERE role = 'reference'), rc AS (SELECT node AS head, node, 0 AS rank, coalesce((SELECT o1 FROM se WHERE se.n1 = nd.node), '+') AS ori FROM nd WHERE node NOT IN (SELECT n2 FROM sc) UNION ALL SELECT rc.head, sc.n2, rc.rank + 1, sc.o2 FROM rc JOIN sc ON sc.n1 = rc.node)"


@query(
    f"WITH RECURSIVE {PLACED}, a AS (SELECT path, pos, coalesce(head, ss.node) AS head, coalesce(rank, 0) AS rank, CASE WHEN ss.ori = coalesce(rc.ori, '+') THEN '+' ELSE '-' END AS ori FROM ss LEFT JOIN rc ON rc.node = ss.node), "
    "b AS (SELECT *, CASE WHEN lag(head) OVER w = head AND lag(ori) OVER w = ori AND rank - lag(rank) OVER w = CASE ori WHEN '+' THEN 1 ELSE -1 END THEN 0 ELSE 1 END AS new FROM a WINDOW w AS (PARTITION BY path ORDER BY pos)), c AS (SELECT *, sum(new) OVER (PARTITION BY path ORDER BY pos) AS nth FROM b) "
    "SELECT path, CAST(nth AS INTEGER) AS pos, head AS node, ori, CAST(min(rank) AS BIGINT) AS \"first\", CAST(max(rank) AS BIGINT) AS \"last\" FROM c GROUP BY path, nth, head, ori"
)
def rewritten_paths(spark, d):
    """All paths over the merged nodes of the references' graph."""
    s, e = _reference_edges(spark, d)
    return G.rewritten_steps(s, G.placed_on_chains(e))


@query(
    f"WITH RECURSIVE {PLACED}, a AS (SELECT x.head AS n1, CASE WHEN e.o1 = x.ori THEN '+' ELSE '-' END AS o1, y.head AS n2, CASE WHEN e.o2 = y.ori THEN '+' ELSE '-' END AS o2, x.rank AS r1, y.rank AS r2 FROM (SELECT DISTINCT n1, o1, n2, o2 FROM sp WHERE role = 'reference') AS e JOIN rc AS x ON x.node = e.n1 JOIN rc AS y ON y.node = e.n2) "
    "SELECT DISTINCT n1, o1, n2, o2 FROM a WHERE NOT (n1 = n2 AND o1 = o2 AND r2 - r1 = CASE o1 WHEN '+' THEN 1 ELSE -1 END)"
)
def rewritten_links(spark, d):
    """The references' oriented edges between the merged nodes."""
    e = cut(_reference_edges(spark, d)[1])
    return G.rewritten_edges(e, G.placed_on_chains(e))


SIBLINGS = f"{EDGES}, {SAMPLE_SEGMENTS}, e AS (SELECT DISTINCT n1, n2 FROM sp WHERE role = 'allele'), tw AS (SELECT n1, n2, seq, min(n2) OVER (PARTITION BY n1, seq) AS kept FROM e JOIN sg ON node = n2), tu AS (SELECT n2 AS a, kept AS b FROM tw WHERE n2 <> kept UNION SELECT kept, n2 FROM tw WHERE n2 <> kept), tc AS (SELECT a AS node, a AS c FROM tu UNION SELECT tu.b, tc.c FROM tc JOIN tu ON tu.a = tc.node), tn AS (SELECT node, min(c) AS kept FROM tc GROUP BY node HAVING min(c) <> node)"


@query(f"WITH RECURSIVE {SIBLINGS} SELECT DISTINCT coalesce(x.kept, n1) AS n1, coalesce(y.kept, n2) AS n2 FROM e LEFT JOIN tn AS x ON x.node = n1 LEFT JOIN tn AS y ON y.node = n2")
def merged_siblings(spark, d):
    s = B.sample_steps(spark, d)
    return G.merged_siblings(A.adjacent(s.where("role = 'allele'")), B.sample_segments(s))[0]


@query()
def parallel_nodes(spark, d):
    """Successors of one node whose longest common subsequence is over half of the longer; tested against a slow version."""
    s = B.sample_steps(spark, d)
    return G.parallel_nodes(A.adjacent(s.where("role = 'allele'")), B.sample_segments(s))


@query("WITH i AS (SELECT item_id AS id, upper(text) AS s FROM benchmark WHERE length(text) > 0 UNION ALL SELECT 1000000 + item_id, upper(substr(text, 5, 20)) FROM benchmark WHERE length(text) > 30), c AS (SELECT DISTINCT a.id FROM i AS a JOIN i AS b ON a.id <> b.id AND contains(b.s, a.s) AND (length(b.s) > length(a.s) OR b.id > a.id)) SELECT id FROM i WHERE id NOT IN (SELECT id FROM c)")
def inclusions_removed(spark, d):
    """Of equal sequences the one with the larger name stays, and none that another holds."""
    b = B.table(spark, d, "benchmark").where("length(text) > 0")
    s = b.select(F.col("item_id").alias("id"), F.col("text").alias("seq")).unionByName(b.where("length(text) > 30").select((F.col("item_id") + 1000000).alias("id"), F.substring("text", 5, 20).alias("seq")))
    return s.join(P.contained(s).select(F.col("inner").alias("id")), "id", "left_anti").select("id")


# Fits and cycles of each sample


def _solved(spark, d):
    """(flows and prices, nodes' terms, flow graph, overlaps, reads) of each sample's reads, overlaps on cycles cut before."""
    o, r = _overlaps(spark, d)
    o = cut(o)
    pairs = o.join(r.select(F.col("path").alias("c1"), "sample").distinct(), "c1").select("sample", F.col("c1").alias("n1"), F.col("c2").alias("n2")).distinct()
    kept = H.without_cycles(pairs, "sample", careful=True).select(F.col("n1").alias("c1"), F.col("n2").alias("c2"))
    o = cut(o.join(cut(kept), ["c1", "c2"]))
    g = cut(W.flow_graph(r.select(F.col("path").alias("c")).distinct(), o))
    edges = g.withColumn("c", F.coalesce("c1", "c2")).join(r.select(F.col("path").alias("c"), "sample").distinct(), "c")
    total = r.groupBy("sample", "node").agg(F.sum("aligned").alias("abundance"))
    nodes = W.node_edges(r, o).join(edges.where("c1 is not null and c2 is not null").select("c1", "c2", "src", "dst"), ["c1", "c2"]).join(total, "node")
    nodes = cut(nodes.select("sample", "node", "abundance", "src", "dst", "weight"))
    return cut(H.flow_solved(nodes, edges.select("sample", "src", "dst"), "sample")), nodes, g, o, r


def _flow(solved):
    return solved.where("kind = 'flow'").select("sample", "src", "dst", F.col("value").alias("flow"))


@query()
def flow_lp(spark, d):
    """Flows of each sample's reads' flow graph that explain its nodes' abundances best."""
    return _flow(_solved(spark, d)[0])


@query(f"WITH {SAMPLE_STEPS} SELECT sample, CAST(sum(aligned) AS BIGINT) AS abundance, CAST(0 AS BIGINT) AS gap, CAST(0 AS BIGINT) AS unbalanced, CAST(0 AS BIGINT) AS negative, CAST(0 AS BIGINT) AS overpriced FROM ss WHERE role = 'read' GROUP BY sample")
def flow_lp_conservation(spark, d):
    """flow_lp() against the proof that it is optimal, for each sample: 1000 times the gap between what its flows and abundances
    differ by and what its prices say at least, vertices where what comes in does not go out, negative flows, and prices that break
    their bounds.  Flows of zero leave a gap."""
    solved, nodes, *_ = _solved(spark, d)
    x, e = _flow(solved), ["sample", "src", "dst"]
    price = solved.where("kind = 'price'").select("sample", "node", F.col("value").alias("price"))
    level = solved.where("kind = 'level'").select("sample", "node", F.col("value").alias("level"))
    told = nodes.join(x, e).groupBy("sample", "node", "abundance").agg(F.sum(F.col("weight") * F.col("flow")).alias("told")).join(price, ["sample", "node"])
    values = told.groupBy("sample").agg(F.sum("abundance").cast("long").alias("abundance"), F.sum(F.abs(F.col("told") - F.col("abundance"))).alias("primal"), F.sum(F.col("abundance") * F.col("price")).alias("dual"), F.count_if(F.abs("price") > 1 + 1e-9).alias("steep"))
    ends = x.select("sample", F.col("src").alias("v"), (-F.col("flow")).alias("x")).unionByName(x.select("sample", F.col("dst").alias("v"), F.col("flow").alias("x")))
    off = ends.where("v > 1").groupBy("sample", "v").agg(F.abs(F.sum("x")).alias("off")).groupBy("sample").agg(F.count_if(F.col("off") > 1e-6).alias("unbalanced"))
    at = lambda v, name: level.select("sample", F.col("node").alias(v), F.col("level").alias(name))
    paid = nodes.join(price, ["sample", "node"]).groupBy(*e).agg(F.sum(F.col("weight") * F.col("price")).alias("paid"))
    paid = x.join(paid, e, "left").join(at("src", "up"), ["sample", "src"], "left").join(at("dst", "down"), ["sample", "dst"], "left").fillna(0.0)
    paid = paid.groupBy("sample").agg(F.count_if(F.col("paid") + F.col("down") - F.col("up") > 1e-6).alias("over"), F.count_if(F.col("flow") < 0).alias("negative"))
    out = values.join(off, "sample").join(paid, "sample")
    return out.select("sample", "abundance", F.round(F.abs(F.col("primal") - F.col("dual")) * 1000).cast("long").alias("gap"), "unbalanced", "negative", (F.col("over") + F.col("steep")).alias("overpriced"))


@query()
def contig_abundance_solved(spark, d):
    """What flow_lp() gives each contig: the flow on its own edge."""
    solved, _, g, *_ = _solved(spark, d)
    return W.contig_flows(g, _flow(solved))


@query()
def flow_haplotypes(spark, d):
    """From flows to haplotypes: paths of contigs peeled off flow_lp(), overlaps with flow to spare, laid over one another and spelled.

    (sample, nth, abundance, contigs, nodes, seq); tested against the graph, since SQL solves no flows.
    """
    solved, _, g, o, r = _solved(spark, d)
    x = _flow(solved).join(g.select("src", "dst", (F.col("kind") == "overlap").alias("loose")), ["src", "dst"])
    peeled = cut(H.peeled(x.select("sample", F.col("src").alias("n1"), F.col("dst").alias("n2"), "flow", "loose"), "sample", 1))
    inner = F.filter(F.transform(F.split("nodes", ","), lambda n: n.cast("long")), lambda n: (n > 1) & (n % 2 == 0))
    at = peeled.select("sample", "nth", "abundance", (F.col("sample") * 100000 + F.col("nth")).alias("path"), F.posexplode(inner).alias("place", "src"))
    contigs = cut(at.join(g.where("kind = 'contig'").select("src", F.col("c1").alias("contig")), "src"))
    steps = W.joined_steps(contigs.select("path", F.col("place").alias("nth"), "contig"), o, r)
    spelled = P.spelled(steps, B.sample_segments(B.sample_steps(spark, d)))
    listed = contigs.groupBy("sample", "nth", "abundance", "path").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "contig"))), lambda x: x["contig"].cast("string")), ",").alias("contigs"))
    return listed.join(steps.groupBy("path").agg(F.count("*").alias("nodes")), "path").join(spelled, "path").select("sample", "nth", "abundance", "contigs", "nodes", "seq")


@query()
def called_haplotypes(spark, d):
    """The whole inference, from reads to calls: flow_haplotypes() named by the sample's own alleles, those of the very sequence or the
    nearest by edits, with frequencies and the rule of passing.  Tested against plain loops over its rows, since SQL solves no flows."""
    found = flow_haplotypes(spark, d).select(F.concat_ws("-", "sample", "nth").alias("id"), "sample", F.col("abundance").alias("coverage"), "seq")
    s = B.sample_steps(spark, d)
    alleles = s.where("role = 'allele'")
    spelled = P.spelled(alleles, B.sample_segments(s)).join(alleles.select("path", "sample").distinct(), "path")
    contigs = spelled.select("sample", F.col("path").cast("string").alias("name"), F.col("seq").alias("cseq"))
    return K.called(cut(found), contigs, F.levenshtein("seq", "cseq"), "sample", 1)


def _flows(spark, d):
    """(sample, n1, n2, flow): how often reads and alleles take each edge, edges that close a cycle cut, each sample alone."""
    s = B.sample_steps(spark, d).where("role <> 'reference'")
    e = A.adjacent(s).where("n1 <> n2").groupBy("n1", "n2").agg(F.count("*").cast("double").alias("flow"))
    return cut(H.ranked(e.select(F.floor(F.col("n1") / 100).cast("long").alias("sample"), "n1", "n2", "flow"), "sample"))


def _strain_graph(spark, d):
    """(nodes, edges) of each sample's reads: abundances, and edges less those that close a cycle."""
    r = B.sample_steps(spark, d).where("role = 'read'")
    e = A.adjacent(r).where("n1 <> n2").select(F.floor(F.col("n1") / 100).cast("long").alias("sample"), "n1", "n2").distinct()
    return r.groupBy("sample", "node").agg(F.sum("aligned").alias("abundance")), H.ranked(e, "sample")


@query()
def strain_search(spark, d):
    """The two paths through each sample's graph of reads that explain its nodes best; tested against all paths of small graphs."""
    return H.searched(*_strain_graph(spark, d), "sample", 2)


@query(f"WITH {SAMPLE_STEPS} SELECT sample, count(DISTINCT node) AS nodes, CAST(0 AS BIGINT) AS too_many, CAST(0 AS BIGINT) AS strange, true AS better FROM ss WHERE role = 'read' GROUP BY sample")
def strain_search_holds(spark, d):
    """What holds for strain_search(): of each sample, two strains at most, along its edges only, and nearer to its nodes, weighed by
    abundance, than none at all."""
    nodes, edges = _strain_graph(spark, d)
    nodes, edges = cut(nodes), cut(edges)
    x = cut(H.searched(nodes, edges, "sample", 2).withColumn("n", F.transform(F.split("nodes", ","), lambda n: n.cast("long"))))
    many = x.groupBy("sample").agg(F.greatest(F.count("*") - 2, F.lit(0)).alias("too_many"))
    used = x.select("sample", F.explode(F.arrays_zip(F.slice("n", 1, F.size("n") - 1).alias("a"), F.slice("n", 2, F.size("n")).alias("b"))).alias("e")).select("sample", F.col("e.a").alias("n1"), F.col("e.b").alias("n2"))
    strange = used.join(edges, ["sample", "n1", "n2"], "left_anti").groupBy("sample").agg(F.count("*").alias("strange"))
    told = x.select("sample", F.explode("n").alias("node"), F.col("abundance").alias("x")).groupBy("sample", "node").agg(F.sum("x").alias("x"))
    off = F.sum(F.abs(F.coalesce("x", F.lit(0.0)) - F.col("abundance")) / F.col("abundance"))
    value = nodes.join(told, ["sample", "node"], "left").groupBy("sample").agg(F.count("*").alias("nodes"), (off < F.count("*") - 1e-9).alias("better"))
    return value.join(many, "sample", "left").join(strange, "sample", "left").fillna(0).select("sample", "nodes", "too_many", "strange", "better")


@query()
def greedy_paths_all(spark, d):
    """Greedy paths of every sample's edges, of all three modes."""
    return H.peeled(_flows(spark, d), "sample", 1, "all")


@query(f"WITH {EDGES}, e AS (SELECT DISTINCT n1, n2 FROM sp WHERE role <> 'reference' AND n1 <> n2) SELECT count(DISTINCT n1 // 100) AS samples, CAST(0 AS BIGINT) AS strange, CAST(0 AS BIGINT) AS fragments FROM e")
def greedy_paths_cover(spark, d):
    """greedy_paths_all() against what holds for it: every sample has paths, they go along its edges, and each of them begins at a
    source and ends at a sink of the graph they are peeled off."""
    flows = _flows(spark, d)
    x = H.peeled(flows, "sample", 1, "all").select("sample", F.transform(F.split("nodes", ","), lambda n: n.cast("long")).alias("n"))
    used = x.select("sample", F.explode(F.arrays_zip(F.slice("n", 1, F.size("n") - 1).alias("a"), F.slice("n", 2, F.size("n")).alias("b"))).alias("e")).select("sample", F.col("e.a").alias("n1"), F.col("e.b").alias("n2"))
    strange = used.join(A.adjacent(B.sample_steps(spark, d).where("role <> 'reference'")).select("n1", "n2"), ["n1", "n2"], "left_anti").agg(F.count("*").alias("strange"))
    ends = x.select(F.col("n")[0].alias("first"), F.element_at("n", -1).alias("last"))
    begun, ended = flows.select(F.col("n2").alias("first")).distinct().withColumn("entered", F.lit(1)), flows.select(F.col("n1").alias("last")).distinct().withColumn("left", F.lit(1))
    fragments = ends.join(begun, "first", "left").join(ended, "last", "left").agg(F.count_if(F.coalesce("entered", "left").isNotNull()).alias("fragments"))
    return x.agg(F.count_distinct("sample").alias("samples")).crossJoin(F.broadcast(strange)).crossJoin(F.broadcast(fragments))


def _sample_edges(spark, d):
    e = A.adjacent(B.sample_steps(spark, d)).where("n1 <> n2").select("n1", "n2").distinct()
    return e.select(F.floor(F.col("n1") / 100).cast("long").alias("sample"), "n1", "n2")


CLOSURE = f"{EDGES}, e AS (SELECT DISTINCT n1, n2 FROM sp WHERE n1 <> n2), cl AS (SELECT n1 AS a, n2 AS b FROM e UNION SELECT cl.a, e.n2 FROM cl JOIN e ON e.n1 = cl.b), nd AS (SELECT n1 AS node FROM sp UNION SELECT n2 FROM sp), st AS (SELECT node, coalesce((SELECT min(x.b) FROM cl AS x JOIN cl AS y ON y.a = x.b AND y.b = x.a WHERE x.a = node), node) AS component FROM nd)"


@query(f"WITH RECURSIVE {CLOSURE} SELECT node, component FROM st")
def strong_components(spark, d):
    """Of the graph of all samples."""
    return Y.strong_components(A.adjacent(B.sample_steps(spark, d)), B.SAMPLE)


@query(f"WITH RECURSIVE {CLOSURE}, b AS (SELECT e.n1 // 100 AS sample, x.component <> y.component AS apart FROM e JOIN st AS x ON x.node = n1 JOIN st AS y ON y.node = n2) SELECT sample, count(*) FILTER (WHERE apart) AS between_kept, CAST(0 AS BIGINT) AS on_cycles FROM b GROUP BY sample")
def acyclic_edges_hold(spark, d):
    """What holds for the graph of all samples once its cycles are cut: of each sample, every edge between two components is kept, and
    no edge kept lies on a cycle."""
    e = cut(_sample_edges(spark, d))
    kept, inner = Y.acyclic(e, part="sample"), Y.on_cycles(e, part="sample")
    sample = lambda x: x.select(F.expr(B.SAMPLE).alias("sample"), "n1", "n2")
    between = sample(kept.join(inner, ["n1", "n2"], "left_anti")).groupBy("sample").agg(F.count("*").alias("between_kept"))
    still = sample(Y.on_cycles(kept, part=B.SAMPLE)).groupBy("sample").agg(F.count("*").alias("on_cycles"))
    return e.select("sample").distinct().join(between, "sample", "left").join(still, "sample", "left").fillna(0)


@query()
def cycles_cut(spark, d):
    return H.without_cycles(_sample_edges(spark, d), "sample")


@query()
def cycles_cut_careful(spark, d):
    return H.without_cycles(_sample_edges(spark, d), "sample", careful=True)


def _sample_members(spark, d):
    s = B.sample_steps(spark, d).where("role = 'read'")
    total = s.groupBy("node").agg(F.sum("aligned").alias("abundance"))
    return s.select("sample", "path", "node").distinct().join(total, "node").select("sample", "path", "node", "abundance")


@query()
def fit_abundance_absolute_penalty(spark, d):
    return H.fitted(_sample_members(spark, d), "sample", kind=6)


@query()
def fit_abundance_count_penalty(spark, d):
    return H.fitted(_sample_members(spark, d), "sample", kind=7)


@query()
def strain_ladder(spark, d):
    m = _sample_members(spark, d)
    return H.ladder(m, m.groupBy("sample").agg(F.avg("abundance").alias("depth")), "sample")


@query(f"WITH {SAMPLE_STEPS} SELECT count(DISTINCT sample) AS samples, CAST(0 AS BIGINT) AS outside FROM ss WHERE role = 'read'")
def strain_ladder_bounds(spark, d):
    """strain_ladder() against what holds for it: every sample with reads has a strain, of 0.01 to 1.05 times its largest abundance."""
    x = strain_ladder(spark, d)
    top = _sample_members(spark, d).groupBy("sample").agg(F.max("abundance").alias("top"))
    return x.join(top, "sample").agg(F.count_distinct("sample").alias("samples"), F.count_if((F.col("abundance") < 0.01) | (F.col("abundance") > 1.05001 * F.col("top"))).alias("outside"))


@query(f"WITH {SAMPLE_STEPS}, nn AS (SELECT node, row_number() OVER (ORDER BY node) AS new FROM (SELECT DISTINCT node FROM ss)), gg AS (SELECT sample, row_number() OVER (ORDER BY sample) - 1 AS place FROM (SELECT DISTINCT sample FROM ss)) SELECT path || '#' || place AS path, pos, new AS node, ori FROM ss JOIN nn USING (node) JOIN gg USING (sample)")
def combined_graphs(spark, d):
    """All samples' own graphs, with brands as their nodes, as one."""
    s = B.sample_steps(spark, d).select(F.col("sample").alias("graph"), "path", "pos", (F.col("node") % 100).alias("node"), "ori")
    return P.combined(s.select("graph", "node").distinct(), s)[1]


@query(f"WITH {SAMPLE_STEPS}, mm AS (SELECT sample, role = 'reference' AS orphon, role = 'allele' AND sample % 3 <> 0 AS target, node FROM ss), gr AS (SELECT sample, bool_or(target) AS hit, bool_and(orphon) AS lone FROM mm GROUP BY sample) SELECT DISTINCT sample, node FROM mm JOIN gr USING (sample) WHERE CASE WHEN hit THEN NOT EXISTS (SELECT 1 FROM mm AS o WHERE o.sample = mm.sample AND o.node = mm.node AND o.target) ELSE orphon AND NOT lone END")
def filtering_nodes(spark, d):
    """Each sample's nodes that tell reads of elsewhere; references are its orphons, and every third sample has no target."""
    s = B.sample_steps(spark, d)
    name = F.concat(F.col("path").cast("string"), F.when(F.col("role") == "reference", "/OR").otherwise(""))
    return C.filtering_nodes(s.select("sample", name.alias("allele"), "node", ((F.col("role") == "allele") & (F.col("sample") % 3 != 0)).alias("target")), "sample")


REPLACED = (
    f"{SAMPLE_STEPS}, lo AS (SELECT node FROM ss GROUP BY node HAVING sum(aligned) < {2 * LOW}), hp AS (SELECT n0, n1, n2, count(*) AS n FROM (SELECT lag(node, 2) OVER w AS n0, lag(node, 1) OVER w AS n1, node AS n2 FROM ss WINDOW w AS (PARTITION BY path ORDER BY pos)) WHERE n0 IS NOT NULL AND n1 NOT IN (SELECT node FROM lo) GROUP BY ALL), "
    "al AS (SELECT n0, n2, n1 AS instead FROM hp QUALIFY row_number() OVER (PARTITION BY n0, n2 ORDER BY n DESC, n1) = 1), "
    "st AS (SELECT path, pos, node, node IN (SELECT node FROM lo) AS low, lag(node) OVER w AS n0, lead(node) OVER w AS n2 FROM ss WHERE role = 'allele' WINDOW w AS (PARTITION BY path ORDER BY pos)), "
    "ch AS (SELECT path, pos, CASE WHEN NOT low THEN node WHEN n0 NOT IN (SELECT node FROM lo) AND n2 NOT IN (SELECT node FROM lo) THEN instead END AS node, CASE WHEN low THEN node END AS was FROM st LEFT JOIN al USING (n0, n2)), "
    "gp AS (SELECT path, pos, node, was, count(*) FILTER (node IS NULL) OVER (PARTITION BY path ORDER BY pos) AS gone FROM ch), pc AS (SELECT path, CAST(dense_rank() OVER (PARTITION BY path ORDER BY gone) - 1 AS BIGINT) AS piece, pos, node, was FROM gp WHERE node IS NOT NULL)"
)


def _replaced(spark, d):
    s = B.sample_steps(spark, d)
    weak = L.low(s.groupBy("node").agg(F.sum("aligned").alias("abundance")), 2 * LOW)
    alleles = s.where("role = 'allele'")
    return L.replaced(alleles, weak, A.two_hop_support(s)), alleles


@query(f"WITH {REPLACED} SELECT path, piece, pos, node, coalesce(was, -1) AS was FROM pc")
def low_nodes_replaced(spark, d):
    """Every sample's alleles without nodes of little quantity; was is -1 where a node is as it was."""
    return _replaced(spark, d)[0].fillna(-1, ["was"])


@query(f"WITH {REPLACED}, sz AS (SELECT path, piece, count(DISTINCT node) AS need FROM pc GROUP BY ALL), an AS (SELECT DISTINCT path AS other, node FROM ss WHERE role = 'allele'), ho AS (SELECT pc.path, pc.piece FROM pc JOIN an ON an.node = pc.node AND other <> pc.path JOIN sz ON sz.path = pc.path AND sz.piece = pc.piece GROUP BY pc.path, pc.piece, other HAVING count(DISTINCT pc.node) = max(need)) SELECT path, piece, string_agg(node, ',' ORDER BY pos) AS nodes FROM pc WHERE (path, piece) NOT IN (SELECT (path, piece) FROM ho) GROUP BY ALL")
def corrected_contigs(spark, d):
    """The pieces that are left as paths of their own: no other allele has all their nodes."""
    pieces, alleles = _replaced(spark, d)
    listed = L.without_inclusions(cut(pieces), alleles).groupBy("path", "piece").agg(F.array_sort(F.collect_list(F.struct("pos", "node"))).alias("x"))
    return listed.select("path", "piece", F.array_join(F.transform("x", lambda v: v["node"].cast("string")), ",").alias("nodes"))
