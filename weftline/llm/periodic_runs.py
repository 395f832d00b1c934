"""Periodic run detection by Main-Lorentz divide and conquer on interned word ids.

A run is a maximal stretch of words with smallest period q, at least `exponent` periods and `least` words long.  Documents
are interned and laid one after another with separators that equal nothing, so one recursion serves a whole batch:
at each level the texts are halves around midpoints, and a repetition that crosses a midpoint holds, on one side of it,
two periods: the half's Z-function (of the words from the midpoint, or back from it) is at least q at q.  Candidates of
a level are screened all at once by the first words of their squares; Z-functions of the halves that keep
any give the squares, each is extended both ways to its whole run, and intervals found again, there or at
another level, are dropped, with the smallest period kept.

Defined results: null and empty texts have no words and no runs; a document without an id is read as it stands; repeated
rows each get their rows; an empty table gives no rows; extra columns are ignored.  Time is O(n log n) words of a
document and memory a few times its text; a batch holds WORDS words, or one longer document.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows

LEAST, EXPONENT = 6, 4
#: Words of the documents that share a recursion.
WORDS = 200_000
#: Words of a square that are compared for all candidates at once before Z-functions are taken.
SCREEN = 12


def z_function(s: list[int]) -> list[int]:
    """z[i]: how many words from i on equal the first words of s; z[0] is 0."""
    n, left, right = len(s), 0, 0
    z = [0] * n
    for i in range(1, n):
        if i < right:
            k = z[i - left]
            if k < right - i:
                z[i] = k
                continue
            k = right - i
        elif s[i] != s[0]:
            continue
        else:
            k = 1
        while i + k < n and s[k] == s[i + k]:
            k += 1
        z[i], left, right = k, i, i + k
    return z


def _squares(half: list[int], most: int) -> Iterator[int]:
    """The periods, up to most, of the primitive squares that half begins with, ascending.

    A square of a period between q and (z + q) / 2 is a power of q's and lies in the same run, so it is passed over.
    """
    z, beyond = z_function(half), 0
    for q in range(1, min(most, len(half) // 2) + 1):
        if z[q] >= q > beyond:
            beyond = (z[q] + q) // 2
            yield q


def _same(a: np.ndarray, b: np.ndarray) -> int:
    """How many first elements of a and b are equal, looking a doubling stretch ahead at a time."""
    n, done, step = min(len(a), len(b)), 0, 64
    while done < n:
        other = a[done : min(n, done + step)] != b[done : min(n, done + step)]
        at = int(other.argmax())
        if other[at]:
            return done + at
        done, step = done + step, step * 2
    return n


class Runs:
    """Runs found so far in one array of ids, by period, disjoint up to less than a period."""

    def __init__(self, ids: np.ndarray) -> None:
        self.ids, self.starts, self.ends, self.back = ids, defaultdict(list), defaultdict(list), ids[::-1]

    def add(self, at: int, q: int) -> None:
        """The run of period q that holds the square of 2 q words at `at`, unless it is known."""
        starts, ends = self.starts[q], self.ends[q]
        i = bisect_right(starts, at)
        if i and ends[i - 1] >= at + 2 * q:
            return
        n = len(self.ids)
        start = at - _same(self.back[n - at :], self.back[n - at - q :])
        end = at + q + _same(self.ids[at:], self.ids[at + q :])
        i = bisect_right(starts, start)
        starts.insert(i, start)
        ends.insert(i, end)


def _level(ids: np.ndarray, half: int, longest: int, most: int, found: Runs) -> None:
    """Adds the runs with period up to `most` that cross a midpoint between two halves of this length."""
    n, widest = len(ids), min(half // 2, most)
    if not widest:
        return
    for right in (True, False):
        seen = ids if right else ids[::-1]  # halves read from the midpoint on, or back from it
        view = seen.reshape(-1, 2 * half)[:, half : half + longest]
        node, q = np.nonzero(view[:, 1 : widest + 1] == view[:, :1])
        q += 1
        for k in range(1, min(SCREEN, widest)):
            keep = q <= k  # of shorter squares all words are compared already
            keep[~keep] = view[node[~keep], k] == view[node[~keep], q[~keep] + k]
            node, q = node[keep], q[keep]
        for row in np.unique(node).tolist():
            at = half + 2 * half * row
            for period in _squares(view[row].tolist(), widest):
                found.add(at if right else n - at - 2 * period, period)


def runs(words: list[np.ndarray], least: int = LEAST, exponent: int = EXPONENT) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of the runs of each document, its words given as ids from 0 on; sorted by start, then period."""
    if exponent < 4:  # with less, neither side of a midpoint need hold two periods
        raise ValueError("a run must have four periods at least")
    lengths = np.array([len(w) for w in words], np.int64)
    begins = np.cumsum(lengths + 1) - lengths - 1
    flat = np.empty(int((lengths + 1).sum()), np.int64)
    for w, b in zip(words, begins.tolist(), strict=True):
        flat[b : b + len(w)] = w
    flat[begins + lengths] = -1 - np.arange(len(words))
    longest, half = int(lengths.max(initial=0)), 2
    while 2 * half < len(flat):
        half *= 2
    flat = np.r_[flat, -1 - len(words) - np.arange(2 * half - len(flat))]
    found = Runs(flat)
    while half > 1:  # from the longest halves, so that most repetitions of a long run are known when they are met again
        _level(flat, half, longest, longest // exponent, found)
        half //= 2
    best: dict[tuple[int, int], int] = {}
    for q in sorted(found.starts):
        for start, end in zip(found.starts[q], found.ends[q], strict=True):
            if end - start >= max(least, exponent * q):
                best.setdefault((start, end), q)
    out: list[list[tuple[int, int, int]]] = [[] for _ in words]
    for (start, end), q in best.items():
        d = int(np.searchsorted(begins, start, side="right")) - 1
        out[d].append((start - int(begins[d]), end - start, q))
    return [sorted(r, key=lambda x: (x[0], x[2])) for r in out]


def rewritten(doc_id: int | None, n: int) -> np.ndarray | None:
    """Which original word stands at each of n places of the document, if the digest's rule repeats its tail."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n)
    at[a:] = a + (at[a:] - a) % p
    return at


def _interned(texts: list[bytes | None], ids: list[int | None] | None) -> Iterator[tuple[list[int], list[list[bytes]], list[np.ndarray]]]:
    """Batches of documents: which rows, their words, the words' ids."""
    rows, words, total = [], [], 0
    for row, text in enumerate(texts):
        rows.append(row)
        words.append((text or b"").split())  # of bytes: at x20 and x09 to x0D
        total += len(words[-1]) + 1
        if total < WORDS and row < len(texts) - 1:
            continue
        together = pa.array(chain.from_iterable(words), pa.large_binary()).dictionary_encode()
        numbers = np.split(together.indices.to_numpy().astype(np.int64), np.cumsum([len(w) for w in words])[:-1])
        for i, w in enumerate(words):
            at = rewritten(ids[rows[i]], len(w)) if ids else None
            if at is not None:
                words[i], numbers[i] = [w[j] for j in at.tolist()], numbers[i][at]
        yield rows, words, numbers
        rows, words, total = [], [], 0


def spans(docs: DataFrame, least: int = LEAST, exponent: int = EXPONENT) -> DataFrame:
    """A row for each run of each document as it stands: doc_id, start, length, period (words)."""

    def start():
        def make(texts: list[bytes | None]) -> dict:
            every: list[tuple[int, int, int, int]] = []
            for rows, _, numbers in _interned(texts, None):
                every += [(row, *r) for row, found in zip(rows, runs(numbers, least, exponent), strict=True) for r in found]
            row, begin, length, period = np.array(every, np.int64).reshape(-1, 4).T
            return {None: row, "start": begin, "length": length, "period": period}

        return make

    return map_rows(docs.select("doc_id", F.col("text").cast("binary").alias("text")), "text", start, "start long, length long, period long")


def collapsed(words: list[bytes], found: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that stay when every run keeps its first period only."""
    gone = np.zeros(len(words) + 1, np.int64)
    for start, length, q in found:
        gone[start + q] += 1
        gone[start + length] -= 1
    gone = np.cumsum(gone[:-1]) > 0
    return [w for w, g in zip(words, gone.tolist(), strict=True) if not g] if gone.any() else words


def digest(docs: DataFrame) -> DataFrame:
    """One row per document, its tail repeated by the digest's rule: doc_id, n_runs, the longest run's start, length, period and exponent_milli, runs_sha256, collapsed_sha256."""
    names = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")

    def start():
        def make(ids: list[int | None], texts: list[bytes | None]) -> dict:
            out: list[tuple] = []
            for _, words, numbers in _interned(texts, ids):
                for w, found in zip(words, runs(numbers), strict=True):
                    longest = max(found, key=lambda r: (r[1], -r[0], -r[2]), default=None)
                    told = (*longest, 1000 * longest[1] // longest[2]) if longest else (None,) * 4
                    lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
                    out.append((len(found), *told, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(b" ".join(collapsed(w, found))).hexdigest()))
            columns = dict(zip(names, map(list, zip(*out, strict=True)), strict=True)) if out else {c: [] for c in names}
            return {"doc_id": ids} | columns

        return make

    given = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    return map_rows(given, ["doc_id", "text"], start, "doc_id long, " + ", ".join(f"{c} {'string' if 'sha' in c else 'long'}" for c in names))
