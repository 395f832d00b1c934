"""Column functions on sequences, names and oriented steps; all stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def reverse_complement(seq: Column, strict: bool = True) -> Column:
    """Upper-case reverse complement; null for letters other than ACGTN if strict, else other letters and case stay."""
    if not strict:
        return F.translate(F.reverse(seq), "ACGT", "TGCA")
    up = F.upper(seq)
    return F.when(~up.rlike("[^ACGTN]"), F.translate(F.reverse(up), "ACGT", "TGCA"))


def oriented(seq: Column, ori: Column) -> Column:
    """The sequence as a step spells it."""
    return F.when(ori == "-", reverse_complement(seq)).otherwise(seq)


def flipped(steps: Column) -> Column:
    """An array of steps like 12+ read backwards: order and signs turned."""
    return F.transform(F.reverse(steps), lambda s: F.concat(F.regexp_replace(s, "[+-]$", ""), F.when(s.endswith("-"), "+").otherwise("-")))


def unsigned(steps: Column) -> Column:
    """Step text without orientation signs."""
    return F.regexp_replace(steps, "[+-]", "")


def mate_free(name: Column) -> Column:
    """A read's name without its mate suffix (-1, -2, /1, /2)."""
    return F.regexp_replace(name, "[-/][12]$", "")


def file_name(gene: Column) -> Column:
    """A gene's name as files spell it, and gene_name() back."""
    return F.replace(gene, F.lit("/"), F.lit("__"))


def gene_name(name: Column) -> Column:
    return F.replace(name, F.lit("__"), F.lit("/"))


def two_field(allele: Column) -> Column:
    """The first two colon-parted fields of an allele's name."""
    return F.concat_ws(":", F.slice(F.split(allele, ":"), 1, 2))


def two_digits(allele: Column) -> Column:
    """An allele's two_field() name without #0, its second field cut to its first two letters; null of null."""
    return F.when(allele.isNotNull(), F.regexp_replace(two_field(F.replace(allele, F.lit("#0"), F.lit(""))), "^([^:]*:[^:]{2})[^:]+$", "$1"))


def call_fields(header: Column) -> Column:
    """allele, path, coverage, freq and how of a header like G*01:path3 12.5x freq=0.25_HammingDistBased."""
    number = "([0-9.]+)"
    return F.struct(
        F.regexp_extract(header, r"^>?(.*):path[0-9]+ ", 1).alias("allele"),
        F.regexp_extract(header, r":path([0-9]+) ", 1).cast("int").alias("path"),
        F.regexp_extract(header, rf" {number}x", 1).try_cast("double").alias("coverage"),
        F.regexp_extract(header, rf"freq={number}", 1).try_cast("double").alias("freq"),
        F.when(header.contains("HammingDist"), "nearest").otherwise("exact").alias("how"),
    )


def path_role(name: Column) -> Column:
    """What a path is, from its name."""
    return (
        F.when(name.rlike("(?i)^(grch|chm)"), "reference")
        .when(name.rlike("variant|deletion"), "call")
        .when(name.rlike("IMGT|OGRDB|IGv2|HLA|KIR"), "allele")
        .otherwise("read")
    )


def min_strain_depth(depth: Column) -> Column:
    """A twentieth of the depth, rounded half up, and at least 0.1."""
    return F.greatest(F.lit(0.1), F.floor(depth * 0.05 + 0.5).cast("double"))


def augmentation_depth(depth: Column) -> Column:
    """A tenth of the depth, rounded half up, and at least 3."""
    return F.greatest(F.lit(3), F.floor(depth * 0.10 + 0.5)).cast("long")


def length_window(least: Column, most: Column) -> tuple[Column, Column]:
    """Sequence lengths that fit alleles of least to most bases."""
    return F.floor(least * 0.9 + 0.5).cast("long"), F.floor(most * 3 + 0.5).cast("long")


def hamming(a: Column, b: Column) -> Column:
    """Positions in which two sequences of one length differ; null for unequal lengths."""
    pairs = F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: (x != y).cast("int"))
    return F.when(F.length(a) == F.length(b), F.aggregate(pairs, F.lit(0), lambda n, x: n + x))


def tandem_trimmed(nodes: Column) -> Column:
    """A path cut at its first repeated node if what follows repeats the path's beginning.

    The tail from the repeat on must be a prefix of the path; else the path stays.
    """
    n = F.size(nodes)
    repeats = F.filter(F.sequence(F.lit(1), n), lambda i: F.array_position(nodes, F.element_at(nodes, i)) < i)
    at = F.array_min(repeats)
    tail = n - at + 1
    return F.when(at.isNotNull() & (F.slice(nodes, at, tail) == F.slice(nodes, 1, tail)), F.slice(nodes, 1, at - 1)).otherwise(nodes)


LEAST_READ, LEAST_MERGED = 36, 100


def gene_family(name: Column) -> Column:
    """The first four characters after #1# in a path's name, cut at a `*`; null without #1#."""
    rest = F.regexp_extract(name, "#1#(.{1,4})", 1)
    return F.when(name.contains("#1#"), F.regexp_replace(rest, r"\*.*$", ""))


def overlap_segment(least: Column) -> Column:
    """A tenth of the shortest length, rounded half up, and at least 100."""
    return F.greatest(F.lit(100), F.floor(least / 10 + 0.5)).cast("long")


def contains_with_n(outer: Column, inner: Column) -> Column:
    """Whether outer holds inner, in which N stands for any letter; inner is of letters."""
    return F.regexp_like(outer, F.replace(inner, F.lit("N"), F.lit(".")))


def kmers(seq: Column, k: int) -> Column:
    """All of a sequence's stretches of k letters, in order; none if it is shorter."""
    n = F.length(seq) - k + 1
    each = F.transform(F.array(F.split(seq, "")), lambda c: F.transform(F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(c, i, k), "")))[0]  # letters once: finding the i-th in a string takes i steps
    return F.when(n >= 1, each).otherwise(F.array().cast("array<string>"))


def common_subsequence(a: Column, b: Column) -> Column:
    """The length of the longest common subsequence of two texts: a row of the table of prefixes for each letter of a."""
    row = F.transform(F.sequence(F.lit(0), F.length(b)), lambda _: F.lit(0))

    def next_row(above: Column, x: Column) -> Column:
        start = F.array(F.lit(0))
        return F.aggregate(F.sequence(F.lit(1), F.length(b)), start, lambda left, j: F.array_append(left, F.greatest(F.element_at(left, -1), F.element_at(above, j + 1), F.element_at(above, j) + F.when(F.substr(b, j, F.lit(1)) == x, 1).otherwise(0))))

    return F.when((F.length(a) > 0) & (F.length(b) > 0), F.element_at(F.aggregate(F.split(a, ""), row, next_row), -1)).when(a.isNotNull() & b.isNotNull(), 0)
