"""Ids beside nulls, the growth law of shards, and fingerprints against a slow parse of the same rules."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest

from weftline.llm import fingerprints, packing, sharding, token_counts

BIG = 2**53 + 1
SCHEMA = "doc_id long, text string, task int, h long, n int, rank long"


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(BIG, "some words here"), (None, None), (BIG + 1, "é" * 30), (None, "x"), (7, ""), (BIG, "some words here")]
    return spark.createDataFrame([(*r, 1, 2, 3, 4) for r in rows], SCHEMA).coalesce(1)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_ids_keep_all_digits_beside_nulls(odd, none):
    want = sorted(str(r.doc_id) for r in odd.collect())
    path = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
    jobs = {"pack": lambda d: packing.packed(d, path[0]), "lines": lambda d: token_counts.by_line(d, path[1]), "fields": lambda d: token_counts.by_field(d, "doc_id", ["doc_id", "text"], path[1]), "shards": sharding.shards, "prints": fingerprints.compared}
    for name, job in jobs.items():
        assert sorted(str(r.doc_id) for r in job(odd).collect()) == want, name
        assert job(none).collect() == [], name


def test_one_more_shard_takes_rows_only_into_itself():
    keys = np.random.default_rng(1).integers(0, 2**64, 24_000, dtype=np.uint64)
    before = sharding.place_open(keys, 1)
    assert (before == 0).all()
    for n in range(1, 61):
        after = sharding.place_open(keys, n + 1)
        moved = after != before
        assert (after[moved] == n).all() and after.max() == n
        counts = np.bincount(after, minlength=n + 1)
        mean = len(keys) / (n + 1)
        assert (abs(counts - mean) < 6 * mean**0.5).all()
        before = after


def test_shard_sizes_and_sums(odd):
    got = {(r.doc_id, r.size, r.text_crc32, r.law) for r in sharding.shards(odd, 5).collect()}
    assert got == {(r.doc_id, len((r.text or "").encode()) + 8, zlib.crc32((r.text or "").encode()), "key") for r in odd.collect()}
    assert all(sharding.place_open(np.arange(9, dtype=np.uint64), 5)[i] < 5 for i in range(9))


def _slow_phrases(names):
    """Runs, four coin tosses and local maxima, one symbol at a time, as lists of positions where phrases begin; and names of phrases."""
    mask = 2**64 - 1

    def mix(x):
        x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & mask
        x = (x ^ x >> 27) * 0x94D049BB133111EB & mask
        return x ^ x >> 31

    runs = []
    for x in names:
        if runs and runs[-1][0] == x:
            runs[-1][1] += 1
        else:
            runs.append([x, 1])
    s = [x if n == 1 else mix((x * 0x9E3779B97F4A7C15 & mask) + n & mask) for x, n in runs]
    starts = [0]
    if len(s) > 6:
        label = s
        for _ in range(4):
            tossed = []
            for a, b in zip(label, label[1:], strict=False):
                bit = next((i for i in range(64) if (a ^ b) >> i & 1), None)
                tossed.append(0 if bit is None else 2 * bit + (b >> bit & 1))
            label = tossed
        starts += [i + 4 for i in range(1, len(label) - 1) if label[i - 1] < label[i] >= label[i + 1]]
    out = []
    for a, b in zip(starts, [*starts[1:], len(s)], strict=True):
        total = sum(mix(x ^ (i + 1) * 0x9E3779B97F4A7C15 & mask) for i, x in enumerate(s[a:b])) & mask
        out.append(mix(total * 0xC2B2AE3D27D4EB4F & mask))
    return out


def _slow_fingerprint(text):
    names, out = [ord(c) for c in text], set()
    for level in (1, 2, 3):
        names = _slow_phrases(names)
        if level > 1:
            out |= {(x if level == 2 else x ^ 3) >> 32 for x in names}
    return sorted(out)[:64]


def _likeness(a, b):
    if not a or not b:
        return float(len(a) == len(b))
    both = sorted({*a, *b})[: max(len(a), len(b))]
    return sum(x in a and x in b for x in both) / len(both)


def test_fingerprints_equal_slow_ones(spark):
    r = random.Random(6)
    words = ["".join(r.choices("abcdeé", k=r.randint(1, 7))) for _ in range(200)]
    texts = [" ".join(r.choices(words, k=r.randint(0, 400))) for _ in range(30)] + ["", "a" * 500, "ab" * 300, "abc", None]
    texts += [texts[3][:600] + texts[4][:200], texts[5]]
    rows = [(i * 5 - 20, t) for i, t in enumerate(texts)]
    got = {x.doc_id: x for x in fingerprints.compared(spark.createDataFrame(rows, "doc_id long, text string").repartition(6), range_chars=3000).collect()}
    assert len(got) == len(rows)
    for (i, t), (_, after) in zip(rows, [*rows[1:], rows[0]], strict=True):
        t, after, x = t or "", after or "", got[i]
        n = len(t) // 4
        e = t[: len(t) - n] + after[:n]
        f, g, h = (_slow_fingerprint(y) if y else [] for y in (t, e, after))
        assert (x.n_chars, x.edited_sha256, x.fingerprint, x.edited_fingerprint) == (len(t), hashlib.sha256(e.encode()).hexdigest(), *("".join(f"{v:08x}" for v in y) for y in (f, g)))
        assert abs(x.near_edited - _likeness(f, g)) < 1e-12 and abs(x.near_next - _likeness(f, h)) < 1e-12
