"""Queries of variants and phasing, each sample's reads against its own alleles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import abundance as A
from ..operators import calls as C
from ..operators import phasing as H
from ..operators import variants as V
from ..operators.lineage import cut
from . import bindings as B
from .bindings import SAMPLE_PAIRS, SAMPLE_SEGMENTS, SAMPLE_STEPS
from .registry import query

NOVEL = f"""{SAMPLE_STEPS}, {SAMPLE_PAIRS},
known AS (SELECT DISTINCT node FROM ss WHERE role = 'allele'),
re AS (SELECT DISTINCT n1, n2 FROM sp WHERE role = 'read'),
rx AS (SELECT n1 AS node, n2 AS other FROM re UNION ALL SELECT n2, n1 FROM re),
nov AS (SELECT rx.node FROM rx LEFT JOIN known AS k ON k.node = rx.other GROUP BY rx.node HAVING count(*) >= 2 AND count(k.node) >= 2 AND rx.node NOT IN (SELECT node FROM known))"""
PLACED = f"""{NOVEL},
lk AS (SELECT n1 AS node, n2 AS other FROM sp UNION SELECT n2, n1 FROM sp),
en AS (SELECT lk.node, lk.other, k.node IS NOT NULL AS known FROM lk JOIN nov ON nov.node = lk.node LEFT JOIN known AS k ON k.node = lk.other WHERE lk.node <> lk.other),
nr AS (SELECT node, count(*) AS others, count(*) FILTER (known) AS knowns FROM en GROUP BY node),
two AS (SELECT en.node, en.other FROM en JOIN nr USING (node) WHERE others = 2 OR (knowns = 2 AND known)),
ar AS (SELECT path, node, ori, lag(node) OVER w AS before, lead(node) OVER w AS after FROM ss WHERE role = 'read' WINDOW w AS (PARTITION BY path ORDER BY pos)),
sc AS (SELECT node, other, sum(way) AS score FROM (SELECT node, before AS other, 1 AS way FROM ar WHERE before IS NOT NULL UNION ALL SELECT node, after, -1 FROM ar WHERE after IS NOT NULL) GROUP BY ALL),
rk AS (SELECT two.node, two.other, row_number() OVER (PARTITION BY two.node ORDER BY coalesce(score, 0) DESC, two.other) AS nth FROM two LEFT JOIN sc ON sc.node = two.node AND sc.other = two.other),
fl AS (SELECT node, max(CASE nth WHEN 1 THEN other END) AS l, max(CASE nth WHEN 2 THEN other END) AS r FROM rk GROUP BY node),
si AS (SELECT ar.node, CASE ar.ori WHEN '+' THEN 1 ELSE -1 END AS s, kb.node IS NOT NULL AND ka.node IS NOT NULL AS b FROM ar LEFT JOIN known AS kb ON kb.node = ar.before LEFT JOIN known AS ka ON ka.node = ar.after),
so AS (SELECT node, CASE WHEN CASE WHEN count(*) FILTER (b) > 0 THEN sum(CASE WHEN b THEN s END) ELSE sum(s) END < 0 THEN '-' ELSE '+' END AS ori FROM si GROUP BY node),
pl AS (SELECT nov.node, l, r, coalesce(so.ori, '+') AS ori, l IS NULL AS tricky FROM nov LEFT JOIN fl ON fl.node = nov.node LEFT JOIN so ON so.node = nov.node)"""
SUPPORT = "{name} AS (SELECT pl.node, count(DISTINCT a.path) AS reads FROM pl LEFT JOIN {ar} AS a ON a.node = pl.node AND ((a.before = l AND a.after = r) OR (a.before = r AND a.after = l)) WHERE NOT tricky GROUP BY pl.node)"


def _roles(spark, d):
    s = B.sample_steps(spark, d)
    return s, {r: s.where(F.col("role") == r) for r in B.ROLES.values()}


def _placed(spark, d):
    s, by = _roles(spark, d)
    novel = C.novel_nodes(by["read"], by["allele"])
    return V.flanks(novel, A.adjacent(s).select("n1", "n2"), by["read"], by["allele"]), s, by


@query(f"WITH {NOVEL} SELECT node FROM nov")
def sample_novel_nodes(spark, d):
    _, by = _roles(spark, d)
    return C.novel_nodes(by["read"], by["allele"]).select("node")


@query(f"WITH {SAMPLE_STEPS}, {SAMPLE_PAIRS} SELECT n1, n2, count(*) AS n FROM sp WHERE role = 'read' AND n1 IN (SELECT node FROM ss WHERE role = 'allele') AND n2 IN (SELECT node FROM ss WHERE role = 'allele') AND NOT EXISTS (SELECT 1 FROM sp AS a WHERE a.role = 'allele' AND a.n1 = sp.n1 AND a.n2 = sp.n2) GROUP BY ALL HAVING count(*) > 1")
def sample_deletion_pairs(spark, d):
    _, by = _roles(spark, d)
    return C.deletions(by["read"], by["allele"], 1)


@query(f'WITH {PLACED} SELECT node, coalesce(l, -1) AS "left", coalesce(r, -1) AS "right", ori, tricky FROM pl')
def variant_flanks(spark, d):
    return _placed(spark, d)[0].fillna(-1, ["left", "right"])


@query(f"WITH {PLACED}, {SUPPORT.format(name='su', ar='ar')} SELECT node, reads FROM su")
def variant_read_support(spark, d):
    placed, _, by = _placed(spark, d)
    return V.support(placed, by["read"])


@query(
    f"WITH {PLACED}, {SAMPLE_SEGMENTS}, rr AS (SELECT path, node, lag(node) OVER w AS before, lead(node) OVER w AS after FROM ss WHERE role = 'reference' WINDOW w AS (PARTITION BY path ORDER BY pos)), {SUPPORT.format(name='su', ar='ar')}, {SUPPORT.format(name='ro', ar='rr')} "
    "SELECT pl.node, su.reads, a.len AS length, ro.reads AS overlap, ro.reads = 0 AS novel, b.seq || a.seq || c.seq AS seq FROM pl JOIN su ON su.node = pl.node JOIN ro ON ro.node = pl.node JOIN sg AS a ON a.node = pl.node JOIN sg AS b ON b.node = l JOIN sg AS c ON c.node = r WHERE NOT tricky"
)
def variant_report(spark, d):
    placed, s, by = _placed(spark, d)
    return V.report(placed, B.sample_segments(s), by["read"], by["reference"])


WEAK = f"{PLACED}, {SUPPORT.format(name='su', ar='ar')}, weak AS (SELECT pl.* FROM pl JOIN su USING (node) WHERE reads IN (0, 1, 2)), prot AS (SELECT DISTINCT path FROM ss WHERE role <> 'read')"


def _pruned(spark, d):
    placed, s, by = _placed(spark, d)
    weak = placed.join(V.pruning_depths(V.support(placed, by["read"]), "reads").where("prune"), "node")
    return V.pruned(s, A.adjacent(s).select("n1", "n2").distinct(), weak, s.where("role <> 'read'").select("path").distinct())


@query(f"WITH {WEAK}, gone AS (SELECT DISTINCT path FROM ss WHERE node IN (SELECT node FROM weak) AND path NOT IN (SELECT path FROM prot)) SELECT path, pos, node FROM ss WHERE path NOT IN (SELECT path FROM gone)")
def pruned_read_paths(spark, d):
    return _pruned(spark, d)[0].select("path", "pos", "node")


@query(f"WITH {WEAK}, held AS (SELECT DISTINCT node FROM ss WHERE path IN (SELECT path FROM prot)), g AS (SELECT * FROM weak WHERE node NOT IN (SELECT node FROM held)), ct AS (SELECT l AS n1, node AS n2 FROM g UNION SELECT node, r FROM g UNION SELECT node, l FROM g UNION SELECT r, node FROM g), e AS (SELECT DISTINCT n1, n2 FROM sp) SELECT n1, n2 FROM e WHERE NOT EXISTS (SELECT 1 FROM ct WHERE ct.n1 = e.n1 AND ct.n2 = e.n2)")
def pruned_edges(spark, d):
    return _pruned(spark, d)[1]


@query(f"WITH {PLACED}, {SUPPORT.format(name='su', ar='ar')} SELECT node, reads, reads IN (0, 1, 2) AS prune, NOT (reads >= 1 AND reads < 3) AS phase, reads NOT IN (1, 2) AS phase_deletion FROM su")
def variant_depth_rules(spark, d):
    placed, _, by = _placed(spark, d)
    return V.pruning_depths(V.support(placed, by["read"]), "reads")


# Phasing

MEMBERS = "mb AS (SELECT DISTINCT path AS allele, node FROM ss WHERE role = 'allele'), sn AS (SELECT min(allele) AS allele, node FROM mb GROUP BY node HAVING count(*) = 1), pr AS (SELECT min(x.allele) AS allele, x.node AS a, y.node AS b FROM mb AS x JOIN mb AS y ON x.allele = y.allele AND x.node < y.node GROUP BY x.node, y.node HAVING count(*) = 1)"
LINKED = f"{NOVEL}, {MEMBERS}, va AS (SELECT DISTINCT path, node FROM ss WHERE role = 'read' AND node IN (SELECT node FROM nov)), ti AS (SELECT DISTINCT x.node AS a, y.node AS b FROM va AS x JOIN va AS y ON x.path = y.path AND x.node <> y.node), cl AS (SELECT node AS variant, node AS c FROM nov UNION SELECT ti.b, cl.c FROM cl JOIN ti ON ti.a = cl.variant), ln AS (SELECT variant, min(c) AS linked FROM cl GROUP BY variant)"


def _members(by):
    return by["allele"].select(F.col("path").alias("allele"), "node").distinct()


@query(f"WITH {SAMPLE_STEPS}, {MEMBERS} SELECT allele, node FROM sn")
def allele_specific_nodes(spark, d):
    return H.specific_nodes(_members(_roles(spark, d)[1]))


@query(f"WITH {SAMPLE_STEPS}, {MEMBERS} SELECT allele, a, b FROM pr")
def allele_specific_pairs(spark, d):
    return H.specific_pairs(_members(_roles(spark, d)[1]))


def _linked(by):
    novel = C.novel_nodes(by["read"], by["allele"]).select("node")
    return cut(H.linked(novel.select(F.col("node").alias("variant"), "node"), by["read"], B.SAMPLE))


@query(f"WITH RECURSIVE {LINKED} SELECT variant, linked FROM ln")
def linked_variants(spark, d):
    return _linked(_roles(spark, d)[1])


OF_LINKED = "gv AS (SELECT DISTINCT linked AS grp, variant AS node FROM ln)"
BACKING = "rd AS (SELECT DISTINCT path, node FROM ss WHERE role = 'read'), oa AS (SELECT DISTINCT grp, path FROM rd JOIN gv USING (node)), ba AS (SELECT path, allele FROM rd JOIN sn USING (node) UNION SELECT x.path, pr.allele FROM rd AS x JOIN pr ON pr.a = x.node JOIN rd AS y ON y.path = x.path AND y.node = pr.b), gs AS (SELECT grp, allele, count(*) AS reads FROM oa JOIN ba USING (path) GROUP BY ALL)"
SUPPORTED = f"{LINKED}, {OF_LINKED}, {BACKING}"


def _supported(by, group=None):
    if group is None:
        group = _linked(by).select(F.col("linked").alias("group"), F.col("variant").alias("node"))
    members = cut(_members(by))
    seen = members.join(by["read"].select("node").distinct(), "node", "left_semi")  # no read holds another pair
    own = cut(H.specific_nodes(members)), cut(H.specific_pairs(seen))
    return group, members, cut(H.read_support(by["read"], group, *own)), own


@query(f'WITH RECURSIVE {SUPPORTED} SELECT grp AS "group", allele, reads FROM gs')
def phase_read_support(spark, d):
    return _supported(_roles(spark, d)[1])[2]


CHOICE = (
    "sz AS (SELECT allele, count(*) AS need FROM sn GROUP BY allele), bb AS (SELECT path, allele FROM rd JOIN sn USING (node) JOIN sz USING (allele) GROUP BY path, allele HAVING count(*) = max(need) UNION SELECT x.path, pr.allele FROM rd AS x JOIN pr ON pr.a = x.node JOIN rd AS y ON y.path = x.path AND y.node = pr.b), gb AS (SELECT DISTINCT grp, allele FROM oa JOIN bb USING (path)), "
    "lk AS (SELECT n1 AS node, n2 AS other FROM sp WHERE role = 'read' UNION SELECT n2, n1 FROM sp WHERE role = 'read'), fn AS (SELECT DISTINCT gv.grp, lk.other AS node FROM gv JOIN lk ON lk.node = gv.node JOIN known AS k ON k.node = lk.other), "
    "nd AS (SELECT grp, count(*) AS need FROM fn GROUP BY grp), hc AS (SELECT fn.grp, mb.allele, count(*) AS got FROM fn JOIN mb ON mb.node = fn.node GROUP BY ALL), hv AS (SELECT hc.grp, hc.allele FROM hc JOIN nd ON nd.grp = hc.grp WHERE got = need), wh AS (SELECT *, count(*) OVER (PARTITION BY grp) AS n FROM hv), "
    "ca AS (SELECT grp, allele, 'flanks' AS how FROM wh WHERE n = 1 UNION ALL SELECT wh.grp, wh.allele, 'refined' FROM wh JOIN gb ON gb.grp = wh.grp AND gb.allele = wh.allele WHERE n > 1 UNION ALL SELECT grp, allele, 'reads' FROM gb WHERE grp NOT IN (SELECT grp FROM hv) AND grp IN (SELECT grp FROM nd))"
)
CANDIDATES = f"{SUPPORTED}, {CHOICE}"
BEST = "cs AS (SELECT grp, gs.allele, reads, max(reads) OVER (PARTITION BY grp) AS top FROM gs JOIN ca USING (grp, allele)), bs AS (SELECT grp, CASE WHEN count(*) > 1 OR max(reads) <= 1 THEN 'ambiguous' ELSE min(CAST(allele AS VARCHAR)) END AS allele, max(reads) AS reads FROM cs WHERE reads = top GROUP BY grp)"


def _candidates(by, group=None):
    """(candidates, reads' support): flanks of a group, linked variants if not given, are the allele nodes beside its variants on reads."""
    group, members, support, own = _supported(by, group)
    e = A.adjacent(by["read"]).select("n1", "n2")
    beside = e.unionByName(e.select(F.col("n2").alias("n1"), F.col("n1").alias("n2"))).distinct()
    flank = cut(group.join(beside, group.node == beside.n1).select("group", F.col("n2").alias("node")).join(members.select("node"), "node", "left_semi").distinct())
    backed = cut(H.read_backing(by["read"], group, *own))
    return H.candidates(flank, members, backed), support


@query(f'WITH RECURSIVE {CANDIDATES} SELECT grp AS "group", allele, how FROM ca')
def candidate_alleles(spark, d):
    return _candidates(_roles(spark, d)[1])[0]


@query(f'WITH RECURSIVE {CANDIDATES}, {BEST} SELECT grp AS "group", allele, reads FROM bs')
def phased_groups(spark, d):
    """Every group of linked variants with the candidate allele that most reads support."""
    found, support = _candidates(_roles(spark, d)[1])
    return C.best_allele(support.join(found, ["group", "allele"], "left_semi"), "group")


SCOPES = "pa AS (SELECT a AS variant, max(b) AS partner FROM ti GROUP BY a), sk AS (SELECT node AS variant, node AS member FROM nov UNION SELECT sk.variant, pa.partner FROM sk JOIN pa ON pa.variant = sk.member)"
ORDERED = (
    f"{LINKED}, {SCOPES}, gv AS (SELECT variant AS grp, member AS node FROM sk), {BACKING}, {CHOICE}, {BEST}, "
    "vd AS (SELECT sample AS locus, node AS variant, sum(aligned) AS depth FROM ss WHERE role = 'read' AND node IN (SELECT node FROM nov) GROUP BY ALL), od AS (SELECT locus, variant, row_number() OVER (PARTITION BY locus ORDER BY depth DESC, variant) AS k, list_sort(list(member)) AS scope, coalesce(min(allele), 'ambiguous') AS allele FROM vd JOIN sk USING (variant) LEFT JOIN bs ON grp = variant GROUP BY locus, variant, depth), "
    "fo AS (SELECT DISTINCT locus, CAST(0 AS BIGINT) AS k, 0 AS haps, CAST([] AS STRUCT(v BIGINT, a VARCHAR, h INTEGER)[]) AS done FROM od UNION ALL "
    "SELECT locus, k, haps + CASE WHEN NOT known AND len(hs) = 0 THEN 1 ELSE 0 END, CASE WHEN known THEN done WHEN len(hs) = 0 THEN list_concat(done, [{'v': m, 'a': allele, 'h': haps + 1} for m in scope]) ELSE list_append(done, {'v': variant, 'a': CASE WHEN len(hs) > 1 THEN 'ambiguous' ELSE allele END, 'h': list_min(hs)}) END "
    "FROM (SELECT fo.locus, od.k, haps, done, variant, scope, allele, list_contains([x.v for x in done], variant) AS known, list_distinct([x.h for x in done if list_contains(scope, x.v)]) AS hs FROM fo JOIN od ON od.locus = fo.locus AND od.k = fo.k + 1))"
)


@query(f"WITH RECURSIVE {ORDERED} SELECT locus, e.v AS variant, e.a AS allele, e.h AS hap FROM (SELECT locus, unnest(arg_max(done, k)) AS e FROM fo GROUP BY locus)")
def phased_by_depth(spark, d):
    """Every sample's variants, deepest first, each with what its partners lead to."""
    reads = cut(B.sample_steps(spark, d, "read").select("sample", "path", "pos", "node", "ori", "aligned"))
    alleles = cut(B.sample_steps(spark, d, "allele").select("path", "node").distinct())
    variants = cut(C.novel_nodes(reads, alleles).select("node", F.col("node").alias("variant")))
    on = reads.join(variants.select("node"), "node", "left_semi").select("path").distinct()
    by = {"read": cut(reads.join(on, "path", "left_semi")), "allele": alleles}  # reads without a variant tell nothing of any
    scope = cut(H.scopes(variants, H.last_partners(variants, by["read"]), "variant div 100"))
    found, support = _candidates(by, scope.select(F.col("variant").alias("group"), F.col("member").alias("node")))
    best = C.best_allele(support.join(found, ["group", "allele"], "left_semi"), "group").select(F.col("group").alias("variant"), "allele")
    depth = by["read"].join(variants, "node").groupBy(F.col("sample").alias("locus"), "variant").agg(F.sum("aligned").alias("depth"))
    return H.phased_in_order(depth, scope, best)


UNLINKED = f"{SAMPLE_STEPS}, uv AS (SELECT sample AS allele, node AS variant, sum(aligned) AS depth, CAST(node % 100 AS INTEGER) AS hap FROM ss WHERE role = 'read' GROUP BY ALL HAVING count(*) > 1), ud AS (SELECT sample AS allele, avg(d) AS allele_depth FROM (SELECT sample, node, sum(aligned) AS d FROM ss WHERE role = 'allele' GROUP BY ALL) GROUP BY sample)"


@query(f"WITH {UNLINKED}, w AS (SELECT uv.*, allele_depth, count(*) OVER p AS n, bool_and(depth <= 1.33 * allele_depth AND depth >= 0.67 * allele_depth) OVER p AS ok, min(hap) OVER p AS low FROM uv JOIN ud USING (allele) WINDOW p AS (PARTITION BY allele)) SELECT CASE WHEN n > 1 AND NOT ok THEN 'ambiguous' ELSE CAST(allele AS VARCHAR) END AS allele, variant, CASE WHEN n > 1 AND ok THEN low ELSE hap END AS hap FROM w")
def merged_variants(spark, d):
    _, by = _roles(spark, d)
    v = by["read"].groupBy(F.col("sample").alias("allele"), F.col("node").alias("variant")).agg(F.sum("aligned").alias("depth"), F.count("*").alias("n")).where("n > 1").drop("n")
    deep = by["allele"].groupBy("sample", "node").agg(F.sum("aligned").alias("x")).groupBy(F.col("sample").alias("allele")).agg(F.avg("x").alias("allele_depth"))
    rows = v.join(deep, "allele").withColumn("hap", (F.col("variant") % 100).cast("int")).withColumn("allele", F.col("allele").cast("string"))
    return H.merged_variants(rows)


@query(f"WITH RECURSIVE {SUPPORTED} SELECT DISTINCT CAST(mb.allele AS VARCHAR) AS allele, CASE WHEN mb.allele IN (SELECT allele FROM gs) THEN '' ELSE 'exact_' END || CAST(mb.allele AS VARCHAR) AS name FROM mb")
def exact_alleles(spark, d):
    _, by = _roles(spark, d)
    _, members, support, _ = _supported(by)
    return H.exact_alleles(members.select(F.col("allele").cast("string").alias("allele")), support.select(F.col("allele").cast("string").alias("allele")))


@query(
    f"WITH {SAMPLE_STEPS}, p AS (SELECT path, list(node % 100 ORDER BY pos) AS x FROM ss GROUP BY path), q AS (SELECT path, x, coalesce(list_position(x, 7), 0) AS i, coalesce(list_position(x, 11), 0) AS j, CASE WHEN path % 3 = 0 THEN [] ELSE [100, 101] END AS v FROM p), r AS (SELECT *, least(i, j) AS lo, greatest(i, j) AS hi FROM q) "
    "SELECT path, CASE WHEN lo > 0 THEN array_to_string(x[1:lo] || CASE WHEN i < j THEN v ELSE list_reverse(v) END || x[hi:len(x)], ',') ELSE array_to_string(x, ',') END AS nodes, CASE WHEN lo = 0 THEN 'unsupported_tip' WHEN i > j THEN 'reversed' WHEN len(v) = 0 THEN 'deleted' WHEN hi = lo + 1 THEN 'inserted' ELSE 'replaced' END AS how FROM r"
)
def path_interpolation(spark, d):
    """Every path with what lies between its brands 7 and 11 replaced, by nothing in every third one (a variant that is a deletion)."""
    p = B.sample_steps(spark, d).groupBy("path").agg(F.array_sort(F.collect_list(F.struct("pos", (F.col("node") % 100).alias("n")))).alias("a")).select("path", F.transform("a", lambda v: v["n"]).alias("x"))
    inner = F.when(F.col("path") % 3 == 0, F.array().cast("array<bigint>")).otherwise(F.array(F.lit(100), F.lit(101)).cast("array<bigint>"))
    r = H.interpolated(F.col("x"), F.lit(7).cast("long"), F.lit(11).cast("long"), inner)
    return p.select("path", r.alias("r")).select("path", F.array_join("r.nodes", ",").alias("nodes"), "r.how")


@query("SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE round(c_acctbal, 2) END AS depth FROM customer WHERE c_acctbal >= 0 UNION ALL SELECT c_custkey, NULL FROM customer WHERE c_acctbal < 0")
def path_name_depth(spark, d):
    c = B.table(spark, d, "customer")
    name = F.when(F.col("c_custkey") % 4 == 0, F.lit("S#1#G_variant#1")).otherwise(F.concat(F.lit("S#1#G_variant_DP:f:"), F.round("c_acctbal", 2).cast("decimal(18,2)").cast("string"), F.lit("#"), F.col("c_custkey")))
    return c.select("c_custkey", H.path_depth(name).alias("depth"))
