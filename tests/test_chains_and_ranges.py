"""Paths over merged chains, clipped alignments, merged ranges, representatives and restarted streams."""

import random

import pytest
from pyspark.sql import functions as F

from weftline.functions import sequences as S
from weftline.operators import abundance, cleaning, flow, graph, intervals
from weftline.sources import graph_files as files
from weftline.streaming import restart

R = random.Random(9)
TURN = {"+": "-", "-": "+"}


def _reverse(s):
    return s[::-1].translate(str.maketrans("ACGT", "TGCA"))


def test_paths_spell_the_same_over_chains(spark):
    seq = {n: "".join(R.choices("ACGT", k=R.randint(1, 4))) for n in range(1, 30)}
    backbone = [(n, R.choice("+-")) for n in range(1, 13)]
    bubble = [(20, "+"), (21, "-"), (22, "+")]
    paths = [backbone, backbone[:4] + bubble + backbone[6:], backbone[3:9], [(n, TURN[o]) for n, o in backbone[::-1]], backbone[2:3], backbone[1:4] + backbone[2:6], backbone[5:8] + [(n, TURN[o]) for n, o in backbone[4:8][::-1]], [(25, "-"), (25, "-"), (26, "+")]]
    steps = spark.createDataFrame([(i, p, n, o) for i, path in enumerate(paths) for p, (n, o) in enumerate(path)], "path long, pos int, node long, ori string")
    edges = spark.createDataFrame(sorted({(*a, *b) for path in paths[:2] + paths[7:] for a, b in zip(path, path[1:])}), "n1 long, o1 string, n2 long, o2 string")
    placed = graph.placed_on_chains(edges)
    chains = {}
    for r in placed.orderBy("head", "rank").collect():
        chains.setdefault(r.head, []).append(_reverse(seq[r.node]) if r.ori == "-" else seq[r.node])
    assert max(map(len, chains.values())) >= 3
    out = graph.rewritten_steps(steps, placed).orderBy("path", "pos").collect()
    assert len(out) < sum(map(len, paths))
    for i, path in enumerate(paths):
        spelled = ""
        for r in (r for r in out if r.path == i):
            part = "".join(chains[r.node][r.first : r.last + 1]) if r.node in chains else seq[r.node]
            spelled += part if r.ori == "+" else _reverse(part)
        assert spelled == "".join(seq[n] if o == "+" else _reverse(seq[n]) for n, o in path), i
    links = {tuple(r) for r in graph.rewritten_edges(edges, placed).collect()}
    whole = [r for r in out if r.path in (0, 1)]
    for a, b in zip(whole, whole[1:]):
        assert a.path != b.path or (a.node, a.ori, b.node, b.ori) in links


def test_alignments_count_between_their_ends(spark, tmp_path):
    (tmp_path / "a.gaf").write_text("r1\t9\t0\t9\t+\t>1<22>3\t14\t2\t11\t9\t9\t60\nr2\t3\t0\t3\t+\t>3\t4\t1\t1\t0\t0\t0\nr1\t2\t0\t2\t+\t<1\t5\t0\t2\t2\t2\t60\n")
    steps = files.read_gaf(spark, str(tmp_path / "a.gaf"))
    assert steps.count() == 5 and steps.select("path").distinct().count() == 3
    seg = spark.createDataFrame([("1", 5), ("22", 5), ("3", 4), ("4", 0)], "node string, len int")
    got = {(r.path.split("#")[0], r.node): r.aligned for r in abundance.clipped_steps(steps.where("pos > 0 or node <> '1' or ori = '+'"), seg).collect()}
    assert got == {("r1", "1"): 3.0, ("r1", "22"): 5.0, ("r1", "3"): 1.0, ("r2", "3"): 0.0}
    depth = {r.node: r.abundance for r in abundance.node_abundance(seg, abundance.clipped_steps(steps, seg)).collect()}
    assert depth == {"1": 1.0, "22": 1.0, "3": 0.25, "4": 0.0}


def test_overlaps_of_blocks(spark, tmp_path):
    """Forwards and backwards, with ids in order and not, ends over either way, and blocks too short or unlike."""
    lines = ["b 100 60 100 + a 90 0 40 39 40 60", "a 100 10 50 - c 80 20 60 40 40 60", "d 100 30 70 - c 60 10 50 40 40 60", "a 50 0 40 + b 90 30 70 40 40 60", "a 50 0 29 + b 90 30 59 29 29 60", "a 50 0 40 + b 90 30 70 37 40 60"]
    (tmp_path / "a.paf").write_text("".join("\t".join(x.split()) + "\n" for x in lines))
    got = sorted(map(tuple, files.paf_overlaps(files.read_paf(spark, str(tmp_path / "a.paf"))).collect()))
    assert got == sorted([("a", "b", "N", -60, -50, 40, 40, 1), ("a", "c", "I", -10, -30, 70, 70, 0), ("c", "d", "I", -20, 20, 60, 60, 0), ("a", "b", "N", -30, 10, 50, 50, 0)])


def test_lone_nodes_are_paths(spark):
    e = spark.createDataFrame([("g", 1, 2), ("g", 2, 3), ("g", 3, 2)], "g string, n1 long, n2 long")
    lone = spark.createDataFrame([("g", 3), ("g", 9), ("h", 9)], "g string, node long")
    assert sorted((r.g, r.nodes) for r in flow.enumerated(e.where("n1 < n2"), "g", 4, lone).collect()) == [("g", [1, 2, 3]), ("g", [9]), ("h", [9])]


def test_first_proposal_stands(spark):
    """The second contig reads the same either way, so both proposals fit; without an order + comes first."""
    steps = spark.createDataFrame([(p, i, n, o) for p, ns in ((1, [(1, "+"), (8, "+"), (8, "-")]), (2, [(8, "+"), (8, "-")])) for i, (n, o) in enumerate(ns)], "path long, pos int, node long, ori string")
    for first, ori in (("-", "+-"), ("+", "++")):
        way = spark.createDataFrame([(1, 2, w, 0 if w == first else 1) for w in "+-"], "c1 long, c2 long, way string, nth int")
        assert [(r.start, r.ori) for r in flow.overlaps(steps, way).collect()] == [(1, ori)]
    assert [(r.start, r.ori) for r in flow.overlaps(steps, way.drop("nth")).collect()] == [(1, "++")]


@pytest.mark.parametrize("width", [1, 7, 50, 10_000])
def test_ranges_merge_as_one_scan(spark, width):
    rows = [(k, s, s + R.choice([0, 1, 5, 40, 300])) for k in ("a", "b") for s in (R.randrange(-500, 1500) for _ in range(60))]
    want = []
    for k in ("a", "b"):
        for _, s, e in sorted(r for r in rows if r[0] == k):
            if want and want[-1][0] == k and s <= want[-1][2] + 10:
                want[-1][2], want[-1][3] = max(want[-1][2], e), want[-1][3] + 1
            else:
                want.append([k, s, e, 1])
    got = intervals.merged(spark.createDataFrame(rows, "key string, start long, end long"), 10, width)
    assert sorted(map(list, got.collect())) == want and got.columns == ["key", "start", "end", "n"]


def test_only_ranges_are_sorted(spark):
    plan = intervals.merged(spark.createDataFrame([("a", 1, 2)], "key string, start long, end long"), 10)._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert windows and all("_range" in w.split("],")[1] or "_end" in w or "_last" in w for w in windows)  # whole keys only over a row for each range


def test_representatives_equal_a_slow_walk(spark):
    base = ["".join(R.choices("ACGT", k=R.randint(30, 60))) for _ in range(30)]
    rows = []
    for i in range(200):
        s = list(R.choice(base))
        for _ in range(R.choice([0, 0, 1, 3])):
            s[R.randrange(len(s))] = R.choice("ACGT")
        rows.append((f"g{i % 3}", f"n{i:03}", "".join(s)))
    rows += [("g0", "short", "ACG"), ("g0", "also", "ACG"), ("g1", "none", None)]
    seqs = spark.createDataFrame(rows, "gene string, name string, seq string")
    ids = {r.k: r.h for r in spark.createDataFrame([(k,) for k in sorted({s[i : i + 11] for *_, s in rows if s for i in range(max(1, len(s) - 10))})], "k string").select("k", F.xxhash64("k").alias("h")).collect()}
    sketch = {n: set(sorted({ids[s[i : i + 11]] for i in range(max(1, len(s) - 10))})[:16]) for _, n, s in rows if s}
    kept = []
    for g, n, s in sorted((r for r in rows if r[2]), key=lambda r: (-len(r[2]), r[1])):
        if not any(g == h and len(sketch[n] & sketch[m]) >= 0.8 * min(len(sketch[n]), len(sketch[m])) for h, m, _ in kept):
            kept.append((g, n, s))
    most = {"g0": 5, "g1": 100, "g2": 0}
    want = [x for g in most for x in [k for k in kept if k[0] == g][: most[g]]]
    got = cleaning.representatives(seqs, spark.createDataFrame(list(most.items()), "gene string, most long"), "gene", 11, 16, 0.8)
    assert sorted(map(tuple, got.collect())) == sorted(want) and len(kept) < 160


def test_kmers(spark):
    for s in ("abcd", "ab", "", "éß𝒳a"):
        got = spark.createDataFrame([(s,)], "s string").select(S.kmers(F.col("s"), 3).alias("k")).first().k
        assert got == [s[i : i + 3] for i in range(len(s) - 2)]


def test_contigs_are_laid_out_as_one_after_another(spark):
    lengths = {(g, 100 * g + c): R.randint(1, 12) for g in range(4) for c in range(R.randint(1, 14))}
    ids = sorted(c for _, c in lengths)
    pairs = {(a, b) for a in ids for b in ids if a != b and a // 100 == b // 100 and R.random() < 0.15}
    want = {}
    for g in range(4):
        left, order = {c for k, c in lengths if k == g}, []
        while left:
            lead = min(left, key=lambda c: (-lengths[g, c], c))  # noqa: B023
            near = sorted(c for c in left if (c, lead) in pairs or (lead, c) in pairs)
            order += [lead, *near]
            left -= {lead, *near}
        want |= {(g, c): i for i, c in enumerate(order)}
    contigs = spark.createDataFrame([(g, c, n) for (g, c), n in lengths.items()], "g int, c long, len int")
    got = flow.contig_order(contigs, spark.createDataFrame(sorted(pairs), "c1 long, c2 long"), "g")
    assert {(r.g, r.c): r.nth for r in got.collect()} == want


def test_each_sample_once_over_restarts(spark, tmp_path):
    seen, src, out = [], str(tmp_path / "in"), str(tmp_path / "out")
    (tmp_path / "in").mkdir()
    schema = "sample string, value long"

    def work(rows):
        seen.append(1)
        return rows.groupBy("sample").agg(F.sum("value").alias("total"))

    def send(name, rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{src}/{name}")

    def run(checkpoint, work=work):
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(src)
        restart.work_through(stream, work, out, str(tmp_path / checkpoint)).awaitTermination(120)

    send("one", [("a", 1), ("a", 2), ("b", 5)])
    run("c1")
    run("c1")  # nothing new
    send("two", [("c", 7), ("a", 100)])

    def fails(rows):
        raise RuntimeError("lost")

    with pytest.raises(Exception, match="lost"):
        run("c1", fails)
    run("c1")  # the same batch again
    want = {("a", 3), ("b", 5), ("c", 7)}
    assert {tuple(r) for r in restart.results(spark, out).collect()} == want
    run("c2")  # a lost checkpoint sends everything anew
    send("three", [("d", 9)])
    run("c2")
    rows = [tuple(r) for r in restart.results(spark, out).collect()]
    assert set(rows) == want | {("d", 9)} and len(rows) == 4 and len(seen) >= 4
