"""From reads to named calls, as one piece."""

import os
from collections import defaultdict
from math import floor

import pytest
from pyspark.sql import functions as F

from weftline.functions import sequences
from weftline.operators import cleaning
from weftline.plans import bindings, catalog

SF = "/root/testdata/sf0.001"


def edits(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def name_of(seq: str, contigs: dict[str, str], distance) -> tuple[str | None, str]:
    same = sorted(n for n, s in contigs.items() if s == seq)
    if same:
        return " or ".join(same), "exact"
    far = {n: d for n, s in contigs.items() if (d := distance(seq, s)) is not None}
    return (" or ".join(sorted(n for n, d in far.items() if d == min(far.values()))) + "_HammingDistBased", "nearest") if far else (None, "novel")


def passes(rows: list) -> list[bool]:
    top = max(r.coverage for r in rows)
    strict = [r.freq >= 0.1 and r.coverage >= 2 and r.coverage * 4 > top for r in rows]
    return strict if any(strict) else [r.coverage >= 2 and r.freq >= 0.2 for r in rows]


@pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are not here")
def test_called_haplotypes_by_plain_loops(spark):
    got = catalog.queries()["called_haplotypes"](spark, SF).collect()
    steps = bindings.sample_steps(spark, SF)
    seqs = {r.node: r.seq for r in bindings.sample_segments(steps).collect()}
    turn = str.maketrans("ACGT", "TGCA")
    walks, of = defaultdict(str), {}
    for r in steps.where("role = 'allele'").orderBy("path", "pos").collect():
        walks[r.path] += seqs[r.node] if r.ori == "+" else seqs[r.node].translate(turn)[::-1]
        of[r.path] = r.sample
    alleles, rows = defaultdict(dict), defaultdict(list)
    for p, seq in walks.items():
        alleles[of[p]][str(p)] = seq
    for r in got:
        rows[r.sample].append(r)
    assert len(rows) > 20 and {r.how for r in got} >= {"nearest", "novel"}
    for sample, calls in rows.items():
        for r, passed in zip(calls, passes(calls), strict=True):
            name, how = name_of(r.seq, alleles[sample], edits)
            assert (r.allele, r.how, r.passed) == (name or r.id, how, passed)
            assert r.coverage >= 1 and abs(r.freq - floor(r.coverage) / sum(x.coverage for x in calls)) < 1e-9


def test_calls_of_hand_made_haplotypes(spark):
    haps = spark.createDataFrame([("a", "G", "ACGT", 30.0), ("b", "G", "ACGA", 10.0), ("c", "G", "ACCC", 0.5), ("d", "G", "AC", 2.9), ("e", "H", "TT", 1.0), ("f", "H", None, 1.5), ("g", None, "TT", 5.0)], "id string, gene string, seq string, coverage double")
    contigs = spark.createDataFrame([("n1", "G", "ACGT"), ("n2", "G", "ACGT"), ("n3", "G", "ACCA"), ("n4", "H", "TTT")], "name string, gene string, cseq string")
    got = {r.id: r for r in cleaning.called(haps, contigs, sequences.hamming(F.col("seq"), F.col("cseq")), "gene", 1).collect()}
    assert {i: (r.allele, r.how, r.passed) for i, r in got.items()} == {"a": ("n1 or n2", "exact", True), "b": ("n1 or n2 or n3_HammingDistBased", "nearest", True), "d": ("d", "novel", False), "e": ("e", "novel", False), "f": ("f", "novel", False), "g": ("g", "novel", True)}
    assert abs(got["a"].freq - 30 / 42.9) < 1e-12 and abs(got["f"].freq - 1 / 2.5) < 1e-12
    assert cleaning.called(haps.limit(0), contigs, F.levenshtein("seq", "cseq"), "gene", 1).count() == 0
