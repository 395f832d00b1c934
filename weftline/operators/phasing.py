"""Which allele a variant belongs to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import graph, parts
from .lineage import cut


def path_depth(name: Column) -> Column:
    """The depth in a path's name, DP:f:<depth>#<i>; null if there is none."""
    return F.regexp_extract(name, r"DP:f:([0-9.]+)#", 1).try_cast("double")


def specific_nodes(members: DataFrame) -> DataFrame:
    """(allele, node): nodes (allele, node) that one allele alone has."""
    return members.distinct().groupBy("node").agg(F.count("*").alias("n"), F.min("allele").alias("allele")).where("n = 1").select("allele", "node")


def specific_pairs(members: DataFrame) -> DataFrame:
    """(allele, a, b), a < b: pairs of nodes that one allele alone has together.  Pairs are of the nodes of one allele."""
    nodes = members.groupBy("allele").agg(F.sort_array(F.collect_set("node")).alias("x"))
    one = nodes.select("allele", "x", F.posexplode("x").alias("i", "a"))
    pairs = one.select("allele", "a", F.explode(F.slice("x", F.col("i") + 2, F.size("x"))).alias("b"))
    return pairs.groupBy("a", "b").agg(F.count("*").alias("n"), F.min("allele").alias("allele")).where("n = 1").select("allele", "a", "b")


def linked(variants: DataFrame, reads: DataFrame, part: str | None = None) -> DataFrame:
    """(variant, linked): variants (variant, node) and the smallest variant that reads tie it to, through others too; itself if none does.

    A read ties its smallest variant to each of its others, so it adds as many edges as it has variants, not all their pairs.
    A `part` is an expression on variant n1 that is the same for all that reads tie.
    """
    on = reads.select("path", "node").distinct().join(variants.select("variant", "node").distinct(), "node").select("path", "variant").distinct()
    least = on.groupBy("path").agg(F.min("variant").alias("n1"))
    ties = on.join(least, "path").where("n1 <> variant").select("n1", F.col("variant").alias("n2")).distinct()
    label = graph.components(ties, part)
    return variants.select("variant").distinct().join(label, F.col("variant") == F.col("node"), "left").select("variant", F.coalesce("component", "variant").alias("linked"))


def candidates(groups: DataFrame, members: DataFrame, backed: DataFrame, share: float = 0.9, wide: DataFrame | None = None) -> DataFrame:
    """(group, allele, how) from the flank nodes of groups (group, node), alleles' nodes (allele, node) and which alleles reads back
    (group, allele), as read_backing() tells.

    `flanks`: the one allele with all of a group's flank nodes; `refined`: of several, those that reads back and that have over
    `share` of the flanks in wide (group, node), those of the group with all that is linked to it, the same as groups if not
    given; `reads`: if no allele has all, those that reads back.
    """
    need = groups.select("group", "node").distinct()

    def held(of: DataFrame) -> DataFrame:
        return of.join(members.select("allele", "node").distinct(), "node").groupBy("group", "allele").agg(F.count("*").alias("got")).join(of.groupBy("group").agg(F.count("*").alias("need")), "group")

    whole = held(need).where("got = need").withColumn("n", F.count("*").over(Window.partitionBy("group")))
    backed = backed.select("group", "allele").distinct()
    one = whole.where("n = 1").select("group", "allele", F.lit("flanks").alias("how"))
    refined = whole.where("n > 1").join(backed, ["group", "allele"], "left_semi")
    if wide is not None:
        refined = refined.join(held(wide.select("group", "node").distinct()).where(f"got > {share} * need"), ["group", "allele"], "left_semi")
    none = backed.join(whole.select("group"), "group", "left_anti").join(need.select("group"), "group", "left_semi").select("group", "allele", F.lit("reads").alias("how"))
    return one.unionByName(refined.select("group", "allele", F.lit("refined").alias("how"))).unionByName(none)


def _reads_of_groups(reads: DataFrame, variants: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((group, path) of the reads through a group's variants, (path, node) of all these reads)."""
    at = reads.select("path", "node").distinct()
    on = at.join(variants.select("group", "node").distinct(), "node").select("group", "path").distinct()
    return on, at.join(on.select("path").distinct(), "path", "left_semi")


def _with_pair(theirs: DataFrame, pairs: DataFrame) -> DataFrame:
    return theirs.select("path", F.col("node").alias("a")).join(pairs, "a").join(theirs.select("path", F.col("node").alias("b")), ["path", "b"]).select("path", "allele")


def read_backing(reads: DataFrame, variants: DataFrame, nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """(group, allele): alleles that a read through a group's variants (group, node) backs, with all of the allele's specific nodes
    or with both nodes of a specific pair.  An allele without specific nodes is backed by a pair only."""
    on, theirs = _reads_of_groups(reads, variants)
    size = nodes.groupBy("allele").agg(F.count("*").alias("need"))
    by_nodes = theirs.join(nodes, "node").groupBy("path", "allele").agg(F.count("*").alias("got")).join(size, "allele").where("got = need").select("path", "allele")
    return on.join(by_nodes.unionByName(_with_pair(theirs, pairs)).distinct(), "path").select("group", "allele").distinct()


def read_support(reads: DataFrame, variants: DataFrame, nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """(group, allele, reads): reads through a group's variants (group, node) that hold an allele's specific node or both nodes of a specific pair."""
    on, theirs = _reads_of_groups(reads, variants)
    by_node = theirs.join(nodes, "node").select("path", "allele")
    return on.join(by_node.unionByName(_with_pair(theirs, pairs)).distinct(), "path").groupBy("group", "allele").agg(F.count("*").alias("reads"))


def last_partners(variants: DataFrame, reads: DataFrame) -> DataFrame:
    """(variant, partner): of the variants (variant, node) on one read with it the largest, else none and no row.

    A read adds a row for each of its variants: its largest variant, or for that one the next to it; no pairs are listed.
    """
    on = reads.select("path", "node").distinct().join(variants.select("variant", "node").distinct(), "node").select("path", "variant").distinct()
    top = on.groupBy("path").agg(F.max("variant").alias("top"))
    second = on.join(top, "path").groupBy("path", "top").agg(F.max(F.when(F.col("variant") < F.col("top"), F.col("variant"))).alias("second"))
    each = on.join(second, "path").select("variant", F.when(F.col("variant") < F.col("top"), F.col("top")).otherwise(F.col("second")).alias("partner"))
    return each.groupBy("variant").agg(F.max("partner").alias("partner")).where("partner is not null")


def scopes(variants: DataFrame, partners: DataFrame, part: str | None = None) -> DataFrame:
    """(variant, member): each variant with what its partner, the partner's partner and so on lead to, itself too.

    The largest of a ring of partners has only smaller ones, and the largest of these leads back to it; so a way ends where it turns
    back, and each round follows all ways by one step.  A scope need not hold those whose scope holds it.  A `part` is an expression
    on variant that is the same for all that a way leads to.
    """
    if part is not None:
        return _scopes_of_parts(variants, partners, part)
    to = cut(partners.select("variant", "partner"))
    out = variants.select("variant", F.col("variant").alias("member")).distinct()
    fresh = to.select("variant", F.col("variant").alias("before"), F.col("partner").alias("member"))
    while fresh.limit(1).count():
        out = out.unionByName(fresh.select("variant", "member"))
        step = fresh.join(to.select(F.col("variant").alias("member"), F.col("partner").alias("then")), "member")
        fresh = cut(step.where("then <> before").select("variant", F.col("member").alias("before"), F.col("then").alias("member")))
    return out


def _scopes_of_parts(variants: DataFrame, partners: DataFrame, part: str) -> DataFrame:
    key = partners.schema["variant"].dataType.simpleString()

    def solve(variant, partner):
        nodes, a, b = parts.coded(variant, partner)
        at, member = parts.ways(a, b, len(nodes))
        return {"variant": nodes[at], "member": nodes[member]}

    own = variants.select("variant", F.col("variant").alias("member")).distinct()
    done, large = parts.solved(partners.select("variant", "partner", F.expr(part).alias("_of")), "_of", solve, {"variant": key, "member": key})
    out = own.unionByName(done)
    return out if large is None else out.unionByName(scopes(large, large).where("variant <> member"))


def phased_in_order(variants: DataFrame, scope: DataFrame, best: DataFrame) -> DataFrame:
    """(locus, variant, allele, hap): variants (locus, variant, depth) taken one after another by falling depth, ties by variant.

    Where none of a variant's scope (variant, member) has an allele yet, all of it takes the scope's best one (variant, allele) and
    a new hap, counted from 1 in each locus.  Where some have, the variant alone takes it, with their hap; if they have several, it
    is `ambiguous`, of the smallest.  What has an allele keeps it.  Scopes without a best allele are `ambiguous`; unknown depths come last.

    The walk is a fold with a state, so a locus is one array of its variants and their scopes; reads are not in it.
    """
    entry = "struct<allele:string,hap:int>"
    parts = scope.groupBy("variant").agg(F.sort_array(F.collect_set("member")).alias("scope"))
    rows = variants.select("locus", "variant", "depth").join(parts, "variant").join(best.select("variant", "allele"), "variant", "left")
    one = F.struct(F.coalesce(-F.col("depth").cast("double"), F.lit(float("inf"))).alias("rank"), "variant", "scope", F.coalesce(F.col("allele").cast("string"), F.lit("ambiguous")).alias("allele"))
    walk = rows.groupBy("locus").agg(F.array_sort(F.collect_list(one)).alias("walk"))
    key = rows.schema["variant"].dataType.simpleString()
    start = F.struct(F.lit(0).alias("haps"), F.map_from_arrays(F.array().cast(f"array<{key}>"), F.array().cast(f"array<{entry}>")).alias("done"))

    def taken(state: Column, v: Column) -> Column:
        done = state["done"]
        haps = F.array_distinct(F.transform(F.filter(v["scope"], lambda m: F.map_contains_key(done, m)), lambda m: F.element_at(done, m)["hap"]))
        whole = F.size(haps) == 0
        hap = F.when(whole, state["haps"] + 1).otherwise(F.array_min(haps))
        allele = F.when(F.size(haps) > 1, "ambiguous").otherwise(v["allele"])
        who = F.when(whole, v["scope"]).otherwise(F.array(v["variant"]))
        more = F.map_from_arrays(who, F.transform(who, lambda _: F.struct(allele.alias("allele"), hap.alias("hap"))))
        after = F.struct((state["haps"] + F.when(whole, 1).otherwise(0)).alias("haps"), F.map_concat(done, more).alias("done"))
        return F.when(F.map_contains_key(done, v["variant"]), state).otherwise(after)

    ended = walk.select("locus", F.aggregate("walk", start, taken)["done"].alias("done"))
    return ended.select("locus", F.explode("done").alias("variant", "got")).select("locus", "variant", "got.allele", "got.hap")


def merged_variants(variants: DataFrame) -> DataFrame:
    """(allele, variant, hap) of unlinked variants (allele, variant, depth, allele_depth, hap).

    Several of one allele share its smallest hap if every depth is 0.67 to 1.33 times the allele's; else they are ambiguous.
    """
    w = Window.partitionBy("allele")
    ratio_ok = (F.col("depth") <= 1.33 * F.col("allele_depth")) & (F.col("depth") >= 0.67 * F.col("allele_depth"))
    v = variants.withColumn("n", F.count("*").over(w)).withColumn("all_ok", F.bool_and(ratio_ok).over(w)).withColumn("low", F.min("hap").over(w))
    many = F.col("n") > 1
    return v.select(F.when(many & ~F.col("all_ok"), "ambiguous").otherwise(F.col("allele")).alias("allele"), "variant", F.when(many & F.col("all_ok"), F.col("low")).otherwise(F.col("hap")).alias("hap"))


def exact_alleles(alleles: DataFrame, phased: DataFrame) -> DataFrame:
    """(allele, name): alleles without a phased variant (allele) are exact; the others keep their names."""
    has = phased.select("allele").distinct().withColumn("has", F.lit(True))
    return alleles.select("allele").distinct().join(has, "allele", "left").select("allele", F.when(F.col("has").isNull(), F.concat(F.lit("exact_"), "allele")).otherwise(F.col("allele")).alias("name"))


def interpolated(nodes: Column, left: Column, right: Column, inner: Column) -> Column:
    """(nodes, how) of a path with what lies between two flanks replaced by a variant's nodes.

    how: `replaced`; `deleted` for a variant without nodes; `inserted` between flanks that follow one another; `reversed` where
    the path meets the right flank first, and the variant's nodes go in backwards; `unsupported_tip` if a flank is not on the path.
    """
    i, j = F.array_position(nodes, left).cast("int"), F.array_position(nodes, right).cast("int")
    a, b = F.least(i, j), F.greatest(i, j)
    put = F.when(i < j, inner).otherwise(F.reverse(inner))
    new = F.concat(F.slice(nodes, 1, a), put, F.slice(nodes, b, F.size(nodes) - b + 1))
    on = (a > 0) & (i != j)
    how = F.when(~on, "unsupported_tip").when(i > j, "reversed").when(F.size(inner) == 0, "deleted").when(b == a + 1, "inserted").otherwise("replaced")
    return F.struct(F.when(on, new).otherwise(nodes).alias("nodes"), how.alias("how"))
