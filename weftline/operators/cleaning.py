"""Cleaning of calls: naming of haplotypes, depths, sequences of calls, catalogue and alignment filters."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.sequences import gene_name, two_digits
from . import graph
from .calls import by_form, frequencies, nearest, passed_calls
from .paths import first_by

#: Abundances are printed with six decimals; what shows as 0.0000.. in four of them counts as none.
LEAST_ABUNDANCE = 1e-4
CONTROL = "TTN"


def present(contigs: DataFrame) -> DataFrame:
    """Contigs (.., abundance) with abundance."""
    return contigs.where(F.col("abundance") >= LEAST_ABUNDANCE)


def named(haplotypes: DataFrame, contigs: DataFrame, distance: Column, group: str) -> DataFrame:
    """(id, name, how) of haplotypes (id, group, seq) from contigs (name, group, cseq).

    Contigs of the very sequence name a haplotype (`exact`, joined by ` or `); else its group's nearest by distance, all of
    equal ones, with _HammingDistBased appended.  Haplotypes of a group without contigs at a distance have no row.
    """

    def names(asked: DataFrame) -> DataFrame:
        exact = asked.join(contigs.select(group, F.col("cseq").alias("seq"), "name"), [group, "seq"])
        exact = exact.groupBy("id").agg(F.array_join(F.array_sort(F.collect_set("name")), " or ").alias("name"))
        rest = asked.join(exact.select("id"), "id", "left_anti")
        near = nearest(rest, contigs, distance, [group]).select("id", F.concat("name", F.lit("_HammingDistBased")).alias("name"))
        return exact.withColumn("how", F.lit("exact")).unionByName(near.withColumn("how", F.lit("nearest")))

    return by_form(haplotypes, names)


def called(haplotypes: DataFrame, contigs: DataFrame, distance: Column, group: str, least: float) -> DataFrame:
    """Calls (group, id, allele, how, coverage, freq, passed, seq) of haplotypes (id, group, seq, coverage) of at least `least` coverage.

    Names are those of named(), of contigs (name, group, cseq); a haplotype of a group without any contig at a distance keeps its
    id and is `novel`.  Frequencies and the rule of passing are those of the group's calls that are left.
    """
    kept = haplotypes.where(F.col("coverage") >= least)
    rows = kept.join(named(kept.select("id", group, "seq"), contigs, distance, group), "id", "left")
    rows = rows.select(group, "id", F.coalesce("name", F.col("id").cast("string")).alias("allele"), F.coalesce("how", F.lit("novel")).alias("how"), "coverage", "seq")
    return passed_calls(frequencies(rows, [group], least), [group]).select(group, "id", "allele", "how", "coverage", "freq", "passed", "seq")


def renamed(steps: DataFrame, names: DataFrame) -> DataFrame:
    """steps (path, ..) under the names (id, name) of their paths; paths without one keep theirs."""
    j = steps.join(names.select(F.col("id").alias("path"), "name"), "path", "left")
    return j.withColumn("path", F.coalesce("name", F.col("path").cast("string"))).drop("name")


def counted_under(steps: DataFrame, names: DataFrame) -> DataFrame:
    """(path, node, n): how many of the steps (path, node) each path has under its name (id, name), by renamed().

    Names may be long and steps many, so steps are counted by the first path of a name and get the name itself last.
    """
    text = renamed(steps.select("path").distinct().withColumn("own", F.col("path")), names).select("own", F.col("path").alias("name"))
    first = text.groupBy("name").agg(F.min("own").alias("rep"))
    rep = text.join(first, text["name"].eqNullSafe(first["name"])).select("own", "rep")
    n = steps.groupBy("path", "node").agg(F.count("*").alias("n"))
    n = n.join(rep, n["path"].eqNullSafe(rep["own"])).groupBy("rep", "node").agg(F.sum("n").alias("n"))
    return n.join(first.withColumnRenamed("rep", "r"), F.col("rep").eqNullSafe(F.col("r"))).select(F.col("name").alias("path"), "node", "n")


def merged_haplotypes(haplotypes: DataFrame, group: str) -> DataFrame:
    """(group, id, seq, abundance): haplotypes contained in another of their group are merged into it, in order of id.

    A haplotype hands what it has gathered so far to each later or earlier one that contains it, and goes; of equal ones the
    first goes.  One group is one gene's haplotypes of one sample.
    """
    t = haplotypes.schema

    def one(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("id", ignore_index=True)
        seq, ab, gone = rows["seq"].tolist(), rows["abundance"].tolist(), set()
        for i in range(len(seq)):
            for j in range(i + 1, len(seq)):
                if seq[i] in seq[j]:
                    gone.add(i)
                    ab[j] += ab[i]
                elif seq[j] in seq[i]:
                    gone.add(j)
                    ab[i] += ab[j]
        rows["abundance"] = ab
        return rows.drop(index=list(gone))

    schema = f"`{group}` {t[group].dataType.simpleString()}, id {t['id'].dataType.simpleString()}, seq string, abundance double"
    return haplotypes.select(group, "id", "seq", F.col("abundance").cast("double").alias("abundance")).groupBy(group).applyInPandas(one, schema)


def with_depth(calls: DataFrame, depth: DataFrame) -> DataFrame:
    """calls (gene, ..) with mean and sd of the depth rows (gene, mean, sd) of their gene, whose name may carry a sample before a `.`."""
    d = depth.select(F.regexp_extract("gene", r"([^.]*)$", 1).alias("_gene"), "mean", "sd")
    return calls.join(d, gene_name(F.regexp_replace("gene", "(?<!_)_(?!_).*$", "")) == F.col("_gene"), "left").drop("_gene")


def with_sequences(calls: DataFrame, alleles: DataFrame) -> DataFrame:
    """calls (gene, allele, ..) with `novel` (a sequence's name) and `fasta`: exact sequences before novel ones, ambiguous
    references where neither is, empty text else.  alleles are (name, seq) with names like GENE*ALLELE:kind..

    Of several of a kind the last by name counts."""
    head = F.substring_index("name", ":", 1)
    ambiguous, variant = F.col("name").contains("ambiguous"), F.col("name").contains("variant")
    kind = F.when(ambiguous & ~variant, 1).when(~ambiguous & F.col("name").contains("exact"), 3).when(~ambiguous & variant, 2)
    a = alleles.select(F.regexp_replace(head, r"\*.*$", "").alias("gene"), F.regexp_replace(head, r"^.*\*", "").alias("allele"), kind.alias("kind"), "name", "seq").where("kind is not null")
    best = a.groupBy("gene", "allele").agg(F.max(F.struct("kind", "name", "seq")).alias("b"))
    out = calls.join(best, ["gene", "allele"], "left")
    return out.select(*calls.columns, F.coalesce("b.name", F.lit("")).alias("novel"), F.coalesce("b.seq", F.lit("")).alias("fasta"))


def zero_coverage(calls: DataFrame, depth: DataFrame) -> DataFrame:
    """calls (gene, shown, ..) where a shown coverage of 0x becomes its locus' mean depth with two decimals at most, if the locus has one."""
    mean = F.regexp_replace(F.round("mean", 2).cast("decimal(38,2)").cast("string"), r"\.?0+$", "")
    j = calls.join(depth.select("gene", "mean"), "gene", "left")
    return j.withColumn("shown", F.when((F.col("shown") == "0x") & F.col("mean").isNotNull(), F.concat(mean, F.lit("x"))).otherwise(F.col("shown"))).drop("mean")


def locus_depths(bases: DataFrame, control: Column) -> DataFrame:
    """(gene, mean, sd) of bases (gene, depth), and a row for those in the control region under its own name."""
    summary = lambda df: df.groupBy("gene").agg(F.avg("depth").alias("mean"), F.stddev_samp("depth").alias("sd"))
    return summary(bases.where(control).withColumn("gene", F.lit(CONTROL))).unionByName(summary(bases))


def population_depth(bases: DataFrame) -> DataFrame:
    """(mean, sd) with the population's deviation."""
    return bases.agg(F.avg("depth").alias("mean"), F.stddev_pop("depth").alias("sd"))


# Catalogue


def in_catalogue(alleles: DataFrame, wanted: DataFrame, pattern: str) -> DataFrame:
    """alleles (allele, ..) that are in wanted (allele), or, if none is, those that match a pattern."""
    found = alleles.join(wanted.select("allele").distinct(), "allele", "left_semi")
    some = found.agg((F.count("*") > 0).alias("some"))
    fallback = alleles.where(F.col("allele").rlike(pattern)).join(F.broadcast(some.where("not some")))
    return found.unionByName(fallback.drop("some"))


def reduced(alleles: DataFrame) -> DataFrame:
    """alleles (allele, ..) with key, their two_digits(), the first by name of each key."""
    return first_by(alleles.withColumn("key", two_digits(F.col("allele"))), ["key"], [F.col("allele")])


def without_orphons(alleles: DataFrame, group: str) -> DataFrame:
    """alleles (allele, group, ..) without orphon names, those with a slash; a group of orphons alone stays."""
    orphon = F.contains("allele", F.lit("/"))
    w = Window.partitionBy(group)
    return alleles.withColumn("_all", F.bool_and(orphon).over(w)).where(F.col("_all") | ~orphon).drop("_all")


def without_reads(reads: DataFrame, unwanted: DataFrame) -> DataFrame:
    return reads.join(unwanted.select("path").distinct(), "path", "left_anti")


def aligned_well(alignments: DataFrame, identity: float, mapq: int) -> DataFrame:
    """Alignments (matches, block_len, mapq) of enough identity and quality."""
    return alignments.where((F.col("matches") >= identity * F.col("block_len")) & (F.col("mapq") >= mapq))


def kept_haplotypes(hits: DataFrame, divergence: float = 0.01) -> DataFrame:
    """Haplotypes with an exact hit (nm = 0) to an allele, or, in D genes, one of less divergence (de)."""
    return hits.where((F.col("nm") == 0) | (F.col("gene").rlike("^IG.D") & (F.col("de") < divergence))).select("haplotype").distinct()


def complex_genes(members: DataFrame) -> DataFrame:
    """(gene): genes of members (cluster, gene) that are in several clusters, or share one with another gene."""
    m = members.select("cluster", "gene").distinct()
    shared = m.groupBy("cluster").agg(F.count("*").alias("genes"))
    return m.join(shared, "cluster").groupBy("gene").agg(F.count("*").alias("clusters"), F.max("genes").alias("most")).where("clusters > 1 or most > 1").select("gene")


def closest(queries: DataFrame, catalogue: DataFrame, distance: Column, group: list[str]) -> DataFrame:
    """(id, name, distance): catalogue entries (name, seq) of the same sequence, at 0, else the group's nearest."""

    def found(asked: DataFrame) -> DataFrame:
        same = asked.join(catalogue.select(*group, F.col("cseq").alias("seq"), "name"), [*group, "seq"]).groupBy("id").agg(F.array_join(F.array_sort(F.collect_set("name")), " or ").alias("name"), F.lit(0).alias("distance"))
        rest = nearest(asked.join(same.select("id"), "id", "left_anti"), catalogue, distance, group)
        return same.unionByName(rest.select("id", "name", F.col("distance").cast("int").alias("distance")))

    return by_form(queries, found)


def without_doubles(alleles: DataFrame) -> DataFrame:
    """alleles (allele, seq) less those of another's sequence, the first by name staying; orphon names (with a slash) always stay."""
    w = Window.partitionBy("seq").orderBy(F.contains("allele", F.lit("/")), "allele")
    return alleles.withColumn("_n", F.row_number().over(w)).where((F.col("_n") == 1) | F.contains("allele", F.lit("/"))).drop("_n")


def backbone(paths: DataFrame, group: str) -> DataFrame:
    """(group, path): a group's CHM13 paths (path) if there are any, else its GRCh38 ones."""
    p = paths.where(F.col("path").rlike("(?i)chm13|grch38")).withColumn("chm", F.col("path").rlike("(?i)chm13"))
    return p.withColumn("_any", F.bool_or("chm").over(Window.partitionBy(group))).where("chm = _any").select(group, "path")


def best_contig(alignments: DataFrame) -> DataFrame:
    """(q, t): each sequence's target of most matches, the first by name of equals, of alignments (q, t, matches)."""
    total = alignments.groupBy("q", "t").agg(F.sum("matches").alias("matches"))
    return total.withColumn("_n", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("matches"), "t"))).where("_n = 1").select("q", "t")


def split_by_contig(seqs: DataFrame, best: DataFrame) -> DataFrame:
    """(contig, name, seq): the sequences (name, seq) that each contig's own graph is made of, by best_contig(); the first by name of
    equal ones of a contig."""
    placed = seqs.join(best.select(F.col("q").alias("name"), F.col("t").alias("contig")), "name")
    return placed.groupBy("contig", "seq").agg(F.min("name").alias("name")).select("contig", "name", "seq")


def on_same_contig(alleles: DataFrame, haplotypes: DataFrame, hits: DataFrame) -> DataFrame:
    """(haplotype): haplotypes that an allele hits and that sit on the allele's contig; both are best_contig() rows, hits (allele, haplotype)."""
    a, h = alleles.select(F.col("q").alias("allele"), F.col("t").alias("at")), haplotypes.select(F.col("q").alias("haplotype"), F.col("t").alias("on"))
    return hits.join(a, "allele").join(h, "haplotype").where(F.col("at") == F.col("on")).select("haplotype").distinct()


def matching(seqs: DataFrame, genes: DataFrame) -> DataFrame:
    """seqs (name, ..) whose gene, what stands before the `*`, is in genes (gene), but second copies, whose names end in #0 and a digit over 0."""
    gene = F.regexp_replace("name", r"\*.*$", "")
    return seqs.withColumn("_g", gene).join(genes.select(F.col("gene").alias("_g")).distinct(), "_g", "left_semi").where(~F.col("name").rlike("#0[1-9]$")).drop("_g")


def top_by_quota(seqs: DataFrame, quota: DataFrame, group: str) -> DataFrame:
    """seqs (group, name, seq) without doubles of a sequence, the longest of each group up to its quota (group, most)."""
    one = seqs.withColumn("_d", F.row_number().over(Window.partitionBy(group, "seq").orderBy("name"))).where("_d = 1").drop("_d")
    w = Window.partitionBy(group).orderBy(F.desc(F.length("seq")), "name")
    return one.withColumn("_n", F.row_number().over(w)).join(quota, group).where("_n <= most").drop("_n", "most")


def alike(seqs: DataFrame, group: str, k: int, size: int, least: float) -> DataFrame:
    """(group, a, b), a < b: sequences (group, name, seq) of a group whose sketches share at least that part of the smaller one.

    A sketch is the `size` smallest hashes of a sequence's k-mers, or all if there are fewer, so two sequences meet on what both
    sketches hold and not on every k-mer.
    """
    kmer = F.array_distinct(F.transform(F.sequence(F.lit(1), F.length("seq") - k + 1), lambda i: F.xxhash64(F.substr("seq", i, F.lit(k)))))
    sketch = F.slice(F.array_sort(F.when(F.length("seq") >= k, kmer).otherwise(F.array(F.xxhash64("seq")))), 1, size)
    s = seqs.where("seq is not null").select(group, "name", sketch.alias("s")).select(group, "name", F.size("s").alias("n"), F.explode("s").alias("h"))
    side = lambda x: s.select(group, F.col("name").alias(x), F.col("n").alias(f"n_{x}"), "h")
    shared = side("a").join(side("b"), [group, "h"]).where("a < b").groupBy(group, "a", "b").agg(F.count("*").alias("shared"), F.first(F.least("n_a", "n_b")).alias("n"))
    return shared.where(F.col("shared") >= least * F.col("n")).select(group, "a", "b")


def representatives(seqs: DataFrame, quota: DataFrame, group: str, k: int = 11, size: int = 64, least: float = 0.9) -> DataFrame:
    """seqs (group, name, seq; names unique) that stand for those alike(): from the longest on, then by name, each that is like none
    that stands already; of each group up to its quota (group, most)."""
    seqs = graph._cut(first_by(seqs.where("seq is not null"), [group, "seq"], [F.col("name")]))  # of equal ones no other than the first can stand
    near = alike(seqs, group, k, size, least)
    rank = F.struct((-F.length("seq")).alias("n"), F.col("name"))
    kept = graph.first_choice(seqs.select(F.col("name").alias("node"), rank.alias("rank")), near.select(F.col("a").alias("n1"), F.col("b").alias("n2")))
    w = Window.partitionBy(group).orderBy(F.desc(F.length("seq")), "name")
    stands = seqs.join(kept.select(F.col("node").alias("name")), "name", "left_semi").withColumn("_n", F.row_number().over(w))
    return stands.join(quota, group).where("_n <= most").select(group, "name", "seq")


def sequence_stats(seqs: DataFrame, group: str) -> DataFrame:
    """(group, n, shortest, mean, longest) of sequences' lengths."""
    n = F.length("seq")
    return seqs.groupBy(group).agg(F.count("*").alias("n"), F.min(n).alias("shortest"), F.avg(n).alias("mean"), F.max(n).alias("longest"))


# Other tables


def path_weights(steps: DataFrame, paths: DataFrame) -> DataFrame:
    """(node, weight): weights of the paths (path, weight) that hold a node, added up."""
    return steps.select("path", "node").distinct().join(paths, "path").groupBy("node").agg(F.sum("weight").alias("weight"))


def down_weighted(abundance: DataFrame, labels: DataFrame, genes: DataFrame) -> DataFrame:
    """(node, abundance): x / (k / (k + 1)) where a node's component holds k > 0 other genes; labels (node, component), genes (component, k)."""
    k = F.coalesce("k", F.lit(0))
    j = abundance.join(labels, "node", "left").join(genes, "component", "left")
    return j.select("node", F.when(k > 0, F.col("abundance") / (k / (k + 1))).otherwise(F.col("abundance")).alias("abundance"))


def overlap_lengths(overlaps: DataFrame) -> DataFrame:
    """(a, b, length), a < b: the longest overlap of each two of overlaps (id_a, id_b, ola, olb), whichever way."""
    return overlaps.groupBy(F.least("id_a", "id_b").alias("a"), F.greatest("id_a", "id_b").alias("b")).agg(F.max(F.greatest("ola", "olb")).alias("length"))


def node_differences(steps: DataFrame, pairs: DataFrame) -> DataFrame:
    """(a, b, only_a, only_b): nodes that one path of a pair (a, b) has and the other has not."""
    s = steps.select("path", "node").distinct()
    size = s.groupBy("path").agg(F.count("*").alias("n"))
    both = pairs.join(s.select(F.col("path").alias("a"), "node"), "a").join(s.select(F.col("path").alias("b"), "node"), ["b", "node"]).groupBy("a", "b").agg(F.count("*").alias("both"))
    j = pairs.join(both, ["a", "b"], "left").join(size.select(F.col("path").alias("a"), F.col("n").alias("na")), "a").join(size.select(F.col("path").alias("b"), F.col("n").alias("nb")), "b")
    common = F.coalesce("both", F.lit(0))
    return j.select("a", "b", (F.col("na") - common).alias("only_a"), (F.col("nb") - common).alias("only_b"))


def strains_per_node(mappings: DataFrame) -> DataFrame:
    """(node, strains, differences, inserted, deleted) from mappings (path, node, from_length, to_length, changed)."""
    change = F.col("to_length") - F.col("from_length")
    return mappings.groupBy("node").agg(F.count_distinct("path").alias("strains"), F.sum(F.col("changed") + F.abs(change)).alias("differences"), F.sum(F.greatest(change, F.lit(0))).alias("inserted"), F.sum(F.greatest(-change, F.lit(0))).alias("deleted"))


def marked_segments(rows: DataFrame, key: str, order: list[Column], marker: Column) -> DataFrame:
    """rows with `segment`: how many marker rows a key has had so far."""
    w = Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("segment", F.sum(marker.cast("long")).over(w))


def united(parts: list[DataFrame]) -> DataFrame:
    """All rows of all parts, doubles too; columns that a part lacks are null."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def united_first(parts: list[DataFrame], keys: list[str], order: list[str]) -> DataFrame:
    """united(), and of rows with equal keys the first: of the earliest part, then in order."""
    tagged = united([p.withColumn("_part", F.lit(i)) for i, p in enumerate(parts)])
    w = Window.partitionBy(*keys).orderBy("_part", *order)
    return tagged.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n", "_part")
