"""Sources and sinks on small files, and windows over a stream with late rows."""

import glob

import pytest

from weftline.sources import graph_files as files
from weftline.streaming import support


def _lines(path):
    return [x for f in sorted(glob.glob(f"{path}/part-*")) for x in open(f).read().splitlines()]


def test_abundance_files(spark, tmp_path):
    at = f"{tmp_path}/ab"
    files.write_abundance(spark.createDataFrame([(3, 2.5), (2, 0.0), (4, 7.0)], "node_id long, abundance double"), at)
    assert _lines(at) == ["2:0.0", "3:2.5", "4:7.0"]
    assert {(r.node_id, r.abundance, r.low) for r in files.read_abundance(spark, at, 1.0).collect()} == {(2, 0.0, True), (3, 2.5, False), (4, 7.0, False)}
    (tmp_path / "gap").write_text("1:2\n3:4\n")
    (tmp_path / "twice").write_text("1:2\n1:4\n")
    for name in ("gap", "twice"):
        with pytest.raises(ValueError, match="lines have"):
            files.read_abundance(spark, f"{tmp_path}/{name}")
    files.write_edge_support(spark.createDataFrame([(1, 2, 5)], "src long, dst long, n long"), f"{tmp_path}/e")
    assert [tuple(r) for r in files.read_edge_support(spark, f"{tmp_path}/e").collect()] == [(1, 2, 5)]


def test_records_tags_and_contigs(spark, tmp_path):
    (tmp_path / "g.gfa").write_text("H\tVN:Z:1.0\nS\t1\tACg\nP\tp\t1+,2-\t*\nS\t2\tT\nL\t1\t+\t2\t-\t0M\n")
    parts = files.split_records(spark, f"{tmp_path}/g.gfa")
    assert {k: v.count() for k, v in parts.items()} == {"S": 2, "L": 1, "P": 1, "H": 1}
    files.joined_records(parts, f"{tmp_path}/out")
    assert [x[0] for x in _lines(f"{tmp_path}/out")] == ["H", "S", "S", "L", "P"]
    segments, _, steps = files.read_gfa(spark, f"{tmp_path}/g.gfa")
    tagged = files.with_depth_tags(segments, spark.createDataFrame([("1", 2.5)], "node_id string, depth double"))
    assert {r.node_id: (r.tag, r.depth, r.seq) for r in tagged.collect()} == {"1": ("DP:f:2.5", 2.5, "ACG"), "2": (None, None, "T")}
    assert [(r.node, r.ori) for r in files.contig_paths(steps).orderBy("pos").collect()] == [("2", "+"), ("1", "-")]
    files.write_fasta(spark.createDataFrame([("a", "ACGT"), ("b", "GG")], "id string, seq string"), f"{tmp_path}/fa")
    assert {(r.id, r.seq) for r in files.read_fasta(spark, f"{tmp_path}/fa").collect()} == {("a", "ACGT"), ("b", "GG")} and files.count_fasta(spark, f"{tmp_path}/fa") == 2
    files.write_trimmed(spark.createDataFrame([("c", "ACG", 0.25)], "id string, seq string, abundance double"), f"{tmp_path}/tr")
    assert _lines(f"{tmp_path}/tr") == [">c 3bp ab=0.250000", "ACG"]


def test_small_readers(spark, tmp_path):
    (tmp_path / "poa").write_text("VERSION\nA:L0L3S1A5\nc:S2\n")
    assert {(r.base, r.kind, r.number) for r in files.read_poa(spark, f"{tmp_path}/poa").collect()} == {("A", "L", 0), ("A", "L", 3), ("A", "S", 1), ("A", "A", 5), ("c", "S", 2)}
    (tmp_path / "f").write_text("s1:0.25\ns2:0.75\n")
    assert {(r.strain, r.freq) for r in files.read_frequencies(spark, f"{tmp_path}/f").collect()} == {("s1", 0.25), ("s2", 0.75)}
    wide = spark.createDataFrame([("x", 1.5, 2.0)], "name string, `node.7` double, `node.8` double")
    assert {(r.node_id, r.depth) for r in files.unpivoted_depth(wide).collect()} == {("7", 1.5), ("8", 2.0)}
    genes = spark.createDataFrame([("IGHV1",), ("IGHV1",), ("IGHVF",), ("TRA",)], "gene string")
    assert [r.gene for r in files.worklist(genes, "^IGH", "F$").collect()] == ["IGHV1"]
    files.write_results(genes.limit(1), f"{tmp_path}/res")
    assert sorted(x for f in glob.glob(f"{tmp_path}/res/part-*") for x in open(f).read().split())[0] in ("IGHV1", "gene")


def test_windows_of_a_stream_drop_late_rows(spark, tmp_path):
    schema = "ts timestamp, event_type string"
    batches = [["2024-01-01 10:05:00", "2024-01-01 10:20:00"], ["2024-01-01 12:30:00"], ["2024-01-01 10:10:00", "2024-01-01 12:25:00", "2024-01-01 15:00:00"]]
    def write(rows):
        spark.createDataFrame([(x, "a") for x in rows], "ts string, event_type string").selectExpr("cast(ts as timestamp) as ts", "event_type").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")

    write(batches[0])
    stream = support.windowed(spark.readStream.schema(schema).parquet(f"{tmp_path}/in"))
    q = stream.writeStream.outputMode("update").format("memory").queryName("late_rows").option("checkpointLocation", f"{tmp_path}/cp").start()
    try:
        q.processAllAvailable()
        for rows in batches[1:]:
            write(rows)
            q.processAllAvailable()
    finally:
        q.stop()
    got = {str(r.start): r.n for r in spark.sql("select start, max(n) as n from late_rows group by start").collect()}
    assert got == {"2024-01-01 10:00:00": 2, "2024-01-01 12:00:00": 2, "2024-01-01 15:00:00": 1}  # the row of 10:10 came after the watermark
