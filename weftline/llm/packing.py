"""Best-fit packing of tokenised documents into sequences, after a Martello-Toth dominance reduction.

Documents become pieces of at most `capacity` tokens.  Packing needs only how many pieces there are of each length, a
table of at most `capacity` rows whatever the corpus, so it is worked out on the driver for all pieces at once:

* Reduction: for the longest length still open, a set of pieces that provably dominates every other set that could
  share its sequence is fixed for good: the piece alone if nothing fits beside it; with the piece that fills the
  sequence exactly; with the longest piece that fits, if no two others do.
* The rest is packed best fit, longest first, on runs of equal sequences.

The result is a table of runs (length, ranks -> sequences, offset).  Pieces get their rank among those of equal length
without gathering any length: tasks number their own, and the tasks' counts are summed up into offsets.

Defined results: null and empty texts are the end id alone; repeated rows are packed each on its own; extra columns
are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_rows, small, written

CAPACITY, END_ID = 4096, 1
#: Texts whose words are looked up at a time.
BATCH = 200
#: Words whose ids a task keeps, as bytes: up to so many new ones, and as many from before these.  A worker that goes on to other
#: work holds none of them.
CACHED_WORDS = 200_000
#: Texts in which this vocabulary's splits are plain to see: no apostrophes (contractions), no "<" (special tokens), and
#: beyond ASCII only Latin letters whose lower case is one letter.  Once in lower case they split into these words.
_PLAIN = re.compile(r"[\t-\r -&(-;=-~À-ÖØ-öø-įı-ſ]*")
_WORD = re.compile(r"[a-zß-öø-įı-ſ]+|[0-9]|[^\sa-z0-9ß-öø-įı-ſ]+")
_tokenizers: dict[str, tuple] = {}


def _words(text: str) -> tuple[list[str], bool]:
    """Pieces of a text that the tokenizer splits too, so that their ids are the text's; and whether each is one word to it."""
    if _PLAIN.fullmatch(text):
        return _WORD.findall(text.lower()), True
    return [w.decode() for w in text.encode().split()], False  # of bytes: at ASCII white space only, which bounds every token


def _encoder(path: str):
    """A function from texts to their ids as little-endian unsigned 32-bit bytes; ids are kept by word, as long as the function is."""
    if path not in _tokenizers:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        vocabulary = tokenizer.get_vocab(with_added_tokens=True)
        ends = np.zeros(max(vocabulary.values()) + 1, bool)
        ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        _tokenizers[path] = (tokenizer, ends)
    (tokenizer, ends), caches = _tokenizers[path], [{}, {}]

    def learn(words: list[str], single: bool) -> None:
        for i in range(0, len(words), 2000):
            some = words[i : i + 2000]
            if single:  # in one go: every word's last token is marked as such
                ids = np.array(tokenizer.encode(" ".join(some), add_special_tokens=False).ids, "<u4")
                last = np.flatnonzero(ends[ids]) + 1
                if len(last) == len(some):
                    raw, last = ids.tobytes(), (last * 4).tolist()
                    caches[0].update(zip(some, map(raw.__getitem__, map(slice, [0, *last[:-1]], last)), strict=True))
                    continue
            for w, e in zip(some, tokenizer.encode_batch(some, add_special_tokens=False), strict=True):
                caches[0][w] = struct.pack(f"<{len(e.ids)}I", *e.ids)

    def encode(texts: list[str]) -> Iterator[bytes]:
        split = [_words(t) for t in texts]
        if len(caches[0]) > CACHED_WORDS:
            caches[:] = [{}, caches[0]]
        here: dict[str, bytes] = {}  # few enough to stay near, unlike the caches
        for single in (True, False):
            words = set().union(*(ws for ws, s in split if s == single))
            new = words.difference(caches[0])
            fresh = new.difference(caches[1])
            caches[0].update((w, caches[1][w]) for w in new - fresh)
            learn(list(fresh), single)
            here.update(zip(words, map(caches[0].__getitem__, words), strict=True))
        for ws, _ in split:
            yield b"".join(map(here.__getitem__, ws))

    return encode


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece, with its task and its number among the task's of that length."""

    def start():
        encode, seen, end = _encoder(tokenizer_path), [0] * (capacity + 1), end_id.to_bytes(4, "little")

        def make(texts: list[str | None]) -> dict:
            rows = []
            for i, ids in enumerate(encode([t or "" for t in texts])):
                raw = ids + end
                for k, a in enumerate(range(0, len(raw) // 4, capacity)):
                    part = raw[4 * a : 4 * (a + capacity)]
                    n = len(part) // 4
                    rows.append((i, k, a, n, zlib.crc32(part), seen[n]))
                    seen[n] += 1
            return dict(zip((None, "piece", "start", "length", "ids_crc32", "local"), zip(*rows, strict=True), strict=True))

        return make

    return map_rows(docs.select("doc_id", "text", F.spark_partition_id().alias("task")), "text", start, "piece int, start long, length long, ids_crc32 long, local long", BATCH)


def reduce_dominant(count: np.ndarray, capacity: int) -> list[tuple[list[tuple[int, int]], int]]:
    """Fixes dominating sets and takes them out of count (pieces by length): [([(length, times)], sequences)]."""
    out = []
    for length in range(capacity, 0, -1):
        while count[length]:
            room, n = capacity - length, int(count[length])
            if room and count[room]:  # fills the sequence: whatever else stood beside this length could stand for that piece
                q = n // 2 if room == length else min(n, int(count[room]))
                if not q:
                    break
                count[length] -= q
                count[room] -= q
                out.append(([(length, 2)] if room == length else [(length, 1), (room, 1)], q))
                continue
            open_ = np.flatnonzero(count[: room + 1])
            if not len(open_):  # nothing fits: every set with it is the piece alone
                if 2 * length <= capacity:
                    break
                count[length] = 0
                out.append(([(length, 1)], n))
                continue
            low = int(open_[0])
            second = low if count[low] > 1 else int(open_[1]) if len(open_) > 1 else capacity + 1
            if low + second <= room or length <= open_[-1]:
                break
            best = int(open_[-1])  # at most one more piece fits, so the longest dominates
            q = min(n, int(count[best]))
            count[length] -= q
            count[best] -= q
            out.append(([(length, 1), (best, 1)], q))
    return out


def best_fit(count: np.ndarray, capacity: int) -> list[tuple[list[tuple[int, int]], int]]:
    """Best fit, longest first, of count[length] pieces: [([(length, times)], sequences)]."""
    groups: dict[int, list[tuple[list, int]]] = {}  # room left -> runs of equal sequences
    rooms: list[int] = []

    def put(room: int, content: list, q: int) -> None:
        if room not in groups:
            groups[room] = []
            insort(rooms, room)
        groups[room].append((content, q))

    for length in range(capacity, 0, -1):
        n = int(count[length])
        while n:
            i = bisect_left(rooms, length)
            if i == len(rooms):  # new sequences, each with as many as fit
                each = capacity // length
                if n >= each:
                    put(capacity - each * length, [(length, each)], n // each)
                if n % each:
                    put(capacity - n % each * length, [(length, n % each)], 1)
                break
            room = rooms[i]
            content, q = groups[room].pop()
            if not groups[room]:
                del groups[room]
                rooms.pop(i)
            each = room // length
            full = min(q, n // each)
            if full:
                put(room - each * length, [*content, (length, each)], full)
                n -= full * each
                q -= full
            if q and n:  # the last few go into one sequence
                put(room - n * length, [*content, (length, n)], 1)
                n, q = 0, q - 1
            if q:
                put(room, content, q)
    return [x for runs in groups.values() for x in runs]


def plan(count: np.ndarray, capacity: int = CAPACITY) -> pd.DataFrame:
    """Runs of pieces: rank r of `length` in [rank, rank + times * sequences) goes to sequence `sequence` + (r - rank) // times."""
    left, rows, sequence, rank = count.copy(), [], 0, np.zeros(capacity + 1, np.int64)
    for content, q in reduce_dominant(left, capacity) + best_fit(left, capacity):
        offset = 0
        for length, times in content:
            rows.append((length, rank[length], times, sequence, offset))
            rank[length] += times * q
            offset += times * length
        sequence += q
    return pd.DataFrame(rows, columns=["length", "rank", "times", "sequence", "offset"], dtype=np.int64).sort_values(["length", "rank"], ignore_index=True)


def packed(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Every piece of docs with its sequence and its offset there."""
    cut = written(pieces(docs, tokenizer_path, capacity, end_id), "pieces")
    counts = written(cut.groupBy("task", "length").count(), "piece-counts")
    histogram = np.zeros(capacity + 1, np.int64)
    for length, n in counts.groupBy("length").agg(F.sum("count")).collect():  # at most `capacity` rows
        histogram[length] = n
    runs = plan(histogram, capacity)
    table = {c: runs[c].to_numpy() for c in runs}
    first = np.searchsorted(table["length"], np.arange(capacity + 2))

    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("task", "length", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    ranked = cut.join(small(offsets), ["task", "length"]).select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("local")).alias("rank"))

    def start():
        def make(ranks: list[int], lengths: list[int]) -> dict:
            rank, length = np.array(ranks, np.int64), np.array(lengths, np.int64)
            at = np.empty(len(rank), np.int64)
            for n in np.unique(length):
                lo, hi = first[n], first[n + 1]
                mine = length == n
                at[mine] = lo + np.searchsorted(table["rank"][lo:hi], rank[mine], side="right") - 1
            k, times = rank - table["rank"][at], table["times"][at]
            return {"sequence_id": table["sequence"][at] + k // times, "offset": table["offset"][at] + k % times * length}

        return make

    return map_rows(ranked.withColumn("n", F.col("length")), ["rank", "n"], start, "sequence_id long, offset long", 20_000)
