"""Readers and writers of graph and alignment text formats, on Spark's text, CSV and JSON sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

PAF = "q string, qlen int, qs int, qe int, ori string, t string, tlen int, ts int, te int, matches int, block_len int, mapq int"
GAM = "name string, sequence string, path struct<mapping:array<struct<position:struct<node_id:string,offset:string,is_reverse:boolean>,edit:array<struct<from_length:int,to_length:int,sequence:string>>,rank:string>>>"


def read_gfa(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(segments, links, path_steps) of a GFA file; sequences in upper case, names of repeated paths made unique by `*`."""
    f = spark.read.text(path).select(F.split("value", "\t").alias("f"), F.monotonically_increasing_id().alias("at"))
    get = lambda i: F.get("f", F.lit(i))
    segments = f.where(get(0) == "S").select(get(1).alias("node_id"), F.upper(get(2)).alias("seq"), get(3).alias("tag"))
    segments = segments.withColumn("len", F.length("seq")).withColumn("depth", F.regexp_extract(F.coalesce("tag", F.lit("")), r"DP:f:([0-9.]+)", 1).try_cast("double"))
    links = f.where(get(0) == "L").select(get(1).alias("src"), get(2).alias("src_ori"), get(3).alias("dst"), get(4).alias("dst_ori"), get(5).alias("overlap"))
    p = f.where(get(0) == "P").select(get(1).alias("name"), get(2).alias("steps"), (F.row_number().over(Window.partitionBy(get(1)).orderBy("at")) - 1).alias("nth"))
    steps = p.select(F.concat("name", F.repeat(F.lit("*"), F.col("nth"))).alias("path"), F.posexplode(F.filter(F.split("steps", ","), lambda s: s != "")).alias("pos", "s"))
    return segments, links, steps.select("path", "pos", F.regexp_replace("s", "[+-]$", "").alias("node"), F.right("s", F.lit(1)).alias("ori"))


def gfa_lines(segments: DataFrame, links: DataFrame, steps: DataFrame) -> DataFrame:
    """A GFA file's lines (class, value): S, then L, then P with <len>M cigars; paths without steps are left out."""
    s = segments.select(F.lit(0).alias("class"), F.concat_ws("\t", F.lit("S"), "node_id", "seq", "tag").alias("value"))
    li = links.select(F.lit(1).alias("class"), F.concat_ws("\t", F.lit("L"), "src", "src_ori", "dst", "dst_ori", F.coalesce("overlap", F.lit("0M"))).alias("value"))
    j = steps.join(segments.select(F.col("node_id").alias("node"), "len"), "node", "left")
    a = j.groupBy("path").agg(F.array_sort(F.collect_list(F.struct("pos", F.concat("node", "ori").alias("s"), F.concat(F.col("len").cast("string"), F.lit("M")).alias("c")))).alias("a"))
    p = a.select(F.lit(2).alias("class"), F.concat_ws("\t", F.lit("P"), "path", F.array_join(F.transform("a", lambda x: x["s"]), ","), F.array_join(F.transform("a", lambda x: x["c"]), ",")).alias("value"))
    return s.unionByName(li).unionByName(p)


def write_gfa(segments: DataFrame, links: DataFrame, steps: DataFrame, path: str) -> None:
    """Part files that read in order as one GFA file."""
    gfa_lines(segments, links, steps).repartitionByRange("class", "value").sortWithinPartitions("class", "value").select("value").write.text(path)


def read_gaf_paths(spark: SparkSession, path: str) -> DataFrame:
    """(path, pos, node, ori) of a GAF file's alignments: < is -, > is +."""
    f = spark.read.csv(path, sep="\t", quote="").select(F.col("_c0").alias("path"), F.regexp_extract_all("_c5", F.lit("([><][^><]+)"), F.lit(1)).alias("steps"))
    s = f.select("path", F.posexplode("steps").alias("pos", "s"))
    return s.select("path", "pos", F.substring("s", 2, 1 << 30).alias("node"), F.when(F.left("s", F.lit(1)) == "<", "-").otherwise("+").alias("ori"))


def read_gaf(spark: SparkSession, path: str) -> DataFrame:
    """(path, pos, node, ori, start, end) of a GAF file's alignments: read_gaf_paths() with where each begins and ends along its path.

    A read may have several alignments, so `path` is its name with the line's number in the file's order.
    """
    f = spark.read.csv(path, sep="\t", quote="").select(F.concat_ws("#", "_c0", F.monotonically_increasing_id()).alias("path"), F.regexp_extract_all("_c5", F.lit("([><][^><]+)"), F.lit(1)).alias("steps"), F.col("_c7").cast("long").alias("start"), F.col("_c8").cast("long").alias("end"))
    s = f.select("path", "start", "end", F.posexplode("steps").alias("pos", "s"))
    return s.select("path", "pos", F.substring("s", 2, 1 << 30).alias("node"), F.when(F.left("s", F.lit(1)) == "<", "-").otherwise("+").alias("ori"), "start", "end")


def read_gam(spark: SparkSession, path: str) -> DataFrame:
    """(path, pos, node, ori, aligned) of aligned reads in GAM as JSON lines; absent lengths are 0, unmapped reads skipped."""
    r = spark.read.schema(GAM).json(path).where("path.mapping is not null")
    m = r.select(F.col("name").alias("path"), F.posexplode("path.mapping").alias("pos", "m"))
    zero = lambda c: F.coalesce(c, F.lit(0))
    bases = F.aggregate(F.coalesce("m.edit", F.array().cast("array<struct<from_length:int,to_length:int,sequence:string>>")), F.lit(0), lambda n, e: n + F.least(zero(e["from_length"]), zero(e["to_length"])))
    return m.select("path", "pos", F.col("m.position.node_id").alias("node"), F.when(F.coalesce("m.position.is_reverse", F.lit(False)), "-").otherwise("+").alias("ori"), bases.cast("double").alias("aligned"))


def read_paf(spark: SparkSession, path: str) -> DataFrame:
    names = [c.split()[0] for c in PAF.split(", ")]
    wide = spark.read.csv(path, sep="\t", quote="")
    return wide.select(*[F.col(f"_c{i}").cast(c.split()[1]).alias(n) for i, (n, c) in enumerate(zip(names, PAF.split(", "), strict=True))])


def paf_overlaps(paf: DataFrame, least: int = 30, identity: float = 95.0) -> DataFrame:
    """(id_a, id_b, ori, oha, ohb, ola, olb, mismatch) of blocks long and alike enough; ids in order.

    oha is how far a sequence begins before the other where they overlap, ohb how far the other ends behind it; both are told for the
    query, and turned where its id is the larger one.  ola and olb are the length that the overlap has by these.
    """
    k = paf.where((F.col("block_len") >= least) & (F.col("matches") * 100.0 / F.col("block_len") >= identity))
    plain, swap = F.col("ori") == "+", F.col("q") > F.col("t")
    rest = F.col("qlen") - F.col("qs")
    head = F.col("qs") - F.when(plain, F.col("ts")).otherwise(F.col("tlen") - F.col("te"))
    tail = F.when(plain, F.col("tlen") - F.col("ts")).otherwise(F.col("te")) - rest
    both = F.when(F.col("head") >= 0, F.least(F.col("qlen") - F.col("head"), "tlen")).otherwise(F.least(F.col("tlen") + F.col("head"), "qlen"))
    turned = lambda own, other: F.when(~swap, F.col(own)).when(plain, -F.col(own)).otherwise(F.col(other))
    k = k.withColumn("head", head).withColumn("tail", tail)
    return k.select(
        F.least("q", "t").alias("id_a"), F.greatest("q", "t").alias("id_b"), F.when(plain, "N").otherwise("I").alias("ori"), turned("head", "tail").alias("oha"), turned("tail", "head").alias("ohb"),
        both.alias("ola"), both.alias("olb"), (F.col("block_len") - F.col("matches")).alias("mismatch"),
    )


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """(id, seq): ids are headers' first words; a sequence's lines are joined."""
    r = spark.read.text(path, lineSep="\n>").select(F.regexp_replace("value", "^>", "").alias("v")).where("v <> ''")
    head = F.substring_index("v", "\n", 1)
    return r.select(F.regexp_extract(head, r"^(\S*)", 1).alias("id"), F.regexp_replace(F.substring(F.col("v"), F.length(head) + 1, F.length("v")), r"\s", "").alias("seq"))


def write_fasta(seqs: DataFrame, path: str, header: str = "id", seq: str = "seq") -> None:
    seqs.select(F.concat(F.lit(">"), F.col(header), F.lit("\n"), F.col(seq))).write.text(path)


def read_bed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep="\t", quote="").select(F.col("_c0").alias("chrom"), F.col("_c1").cast("long").alias("start"), F.col("_c2").cast("long").alias("end"))


def read_abundance(spark: SparkSession, path: str, least: float = 0.0) -> DataFrame:
    """(node_id, abundance, low) of `id:value` lines, whose ids must follow one another from the first; low is under `least`."""
    a = spark.read.csv(path, sep=":").select(F.col("_c0").cast("long").alias("node_id"), F.col("_c1").cast("double").alias("abundance"))
    n, ids, first, last = a.agg(F.count("*"), F.count_distinct("node_id"), F.min("node_id"), F.max("node_id")).first()
    if n and (n != ids or last - first + 1 != n):
        raise ValueError(f"{path}: {n} lines have {ids} ids from {first} to {last}, not each once")
    return a.withColumn("low", F.col("abundance") < least)


def write_abundance(abundance: DataFrame, path: str) -> None:
    """`id:value` lines in order of the ids."""
    abundance.repartitionByRange("node_id").sortWithinPartitions("node_id").select(F.concat_ws(":", F.col("node_id").cast("string"), F.col("abundance").cast("string"))).write.text(path)


def write_edge_support(support: DataFrame, path: str) -> None:
    """`src,dst<TAB>n` lines."""
    support.select(F.concat(F.col("src").cast("string"), F.lit(","), F.col("dst").cast("string"), F.lit("\t"), F.col("n").cast("string"))).write.text(path)


def read_edge_support(spark: SparkSession, path: str) -> DataFrame:
    """(src, dst, n) of `src,dst<TAB>n` lines."""
    f = spark.read.csv(path, sep="\t", quote="").select(F.split("_c0", ",").alias("e"), F.col("_c1").cast("long").alias("n"))
    return f.select(F.get("e", F.lit(0)).cast("long").alias("src"), F.get("e", F.lit(1)).cast("long").alias("dst"), "n")


def unpivoted_depth(wide: DataFrame) -> DataFrame:
    """(node_id, depth) of a wide coverage row with columns node.<id>."""
    cols = [c for c in wide.columns if c.startswith("node.")]
    pairs = ", ".join(f"'{c.removeprefix('node.')}', cast(`{c}` as double)" for c in cols)
    return wide.selectExpr(f"stack({len(cols)}, {pairs}) as (node_id, depth)")


def with_depth_tags(segments: DataFrame, depth: DataFrame) -> DataFrame:
    """segments (node_id, ..) with a tag DP:f:<depth> where depth rows (node_id, depth) have their node."""
    j = segments.drop("tag", "depth").join(depth.select("node_id", "depth"), "node_id", "left")
    return j.withColumn("tag", F.when(F.col("depth").isNotNull(), F.concat(F.lit("DP:f:"), F.col("depth").cast("string"))))


def contig_paths(steps: DataFrame) -> DataFrame:
    """Read-aligned contigs' steps (path, pos, node, ori), turned where the last one is reverse, so that contigs end forwards."""
    w = Window.partitionBy("path")
    s = steps.withColumn("_last", F.max_by("ori", "pos").over(w)).withColumn("_n", F.max("pos").over(w) + F.min("pos").over(w))
    back = F.col("_last") == "-"
    turned = F.when(F.col("ori") == "-", "+").otherwise("-")
    return s.select("path", F.when(back, F.col("_n") - F.col("pos")).otherwise(F.col("pos")).alias("pos"), "node", F.when(back, turned).otherwise(F.col("ori")).alias("ori"))


def split_records(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """A GFA file's lines (value) by record type: S, L, P, and the rest under H."""
    lines = spark.read.text(path)
    kind = F.left("value", F.lit(1))
    return {k: lines.where(kind == k) for k in "SLP"} | {"H": lines.where(~kind.isin(*"SLP"))}


def joined_records(parts: dict[str, DataFrame], path: str) -> None:
    """The lines of split_records() as part files that read in order: header, segments, links, paths."""
    order = {k: i for i, k in enumerate("HSLP")}
    lines = None
    for k, df in parts.items():
        part = df.select(F.lit(order[k]).alias("class"), "value")
        lines = part if lines is None else lines.unionByName(part)
    lines.repartitionByRange("class", "value").sortWithinPartitions("class", "value").select("value").write.text(path)


def read_poa(spark: SparkSession, path: str) -> DataFrame:
    """(at, base, kind, number) of partial-order lines like A:L0L3S1A5: one row for each link, sequence and aligned base."""
    f = spark.read.text(path).where(F.col("value").rlike("^[A-Za-z]:")).select(F.monotonically_increasing_id().alias("at"), F.left("value", F.lit(1)).alias("base"), F.regexp_extract_all("value", F.lit("([LSA][0-9]+)"), F.lit(1)).alias("x"))
    x = f.select("at", "base", F.explode("x").alias("x"))
    return x.select("at", "base", F.left("x", F.lit(1)).alias("kind"), F.substring("x", 2, 20).cast("int").alias("number"))


def read_frequencies(spark: SparkSession, path: str) -> DataFrame:
    """(strain, freq) of `strain:value` lines."""
    return spark.read.csv(path, sep=":").select(F.col("_c0").alias("strain"), F.col("_c1").cast("double").alias("freq"))


def write_results(results: DataFrame, path: str) -> None:
    """A table with tabs and a header, as results_cleaned files are."""
    results.write.csv(path, sep="\t", header=True, quote="", emptyValue="")


def write_trimmed(contigs: DataFrame, path: str) -> None:
    """FASTA of contigs (id, seq, abundance) with headers like `id 120bp ab=0.250000`."""
    head = F.concat(F.col("id"), F.lit(" "), F.length("seq").cast("string"), F.lit("bp ab="), F.round("abundance", 6).cast("decimal(38,6)").cast("string"))
    write_fasta(contigs.select(head.alias("id"), "seq"), path)


def worklist(names: DataFrame, include: str, exclude: str) -> DataFrame:
    """Genes (gene) whose names match one pattern and not the other."""
    return names.where(F.col("gene").rlike(include) & ~F.col("gene").rlike(exclude)).select("gene").distinct()


def count_fasta(spark: SparkSession, path: str) -> int:
    return spark.read.text(path).where(F.col("value").startswith(">")).count()
