"""Document fingerprints by locally consistent parsing.

A text is cut into phrases by deterministic coin tossing: runs of one symbol become one; each symbol is labelled by the
lowest bit in which it differs from its left neighbour, four times over, until six labels remain; phrases begin at local
maxima of the labels, so a border depends on a few symbols around it only, wherever in the text they stand.  Phrases are
named by hashing their symbols, and the names are parsed again.  Equal substrings hence have equal names inside,
whatever their offset.  The fingerprint is the KEPT smallest names of LEVELS, and likeness the share of equal ones among
the smallest of both (an estimate of the Jaccard similarity of the name sets).

Defined results: null and empty texts have the empty fingerprint, like only to another empty one (1.0); documents are
ordered by doc_id, nulls first, then by text hash; repeated rows follow one another; a single document is its own next;
extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ARROW

KEPT, LEVELS = 64, (2, 3)
#: Code points of a range of documents, the unit of work of with_next().
RANGE_CHARS = 6_000_000
#: Ranges that a partition holds at most where there are more of them than all cores need.
RANGES_A_TASK = 64
_M1, _M2, _K1, _K2 = (np.uint64(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F))


_U1, _U27, _U30, _U31, _U32 = (np.uint64(x) for x in (1, 27, 30, 31, 32))


def _mix(x: np.ndarray) -> np.ndarray:
    y = x >> _U30
    y ^= x
    y *= _M1
    z = y >> _U27
    y ^= z
    y *= _M2
    np.right_shift(y, _U31, out=z)
    y ^= z
    return y


def _toss_table() -> np.ndarray:
    """The next label of a symbol b with left neighbour a, both under 128: twice the lowest bit that differs, plus b's bit."""
    a, b = np.arange(128)[:, None], np.arange(128)[None, :]
    d = a ^ b
    low = np.bitwise_count((d & -d) - 1)
    return np.where(d == 0, 0, 2 * low + (b >> np.minimum(low, 7) & 1)).astype(np.uint8).ravel()


_TOSS = _toss_table()
#: The same for labels under 16, as the first toss leaves them: a byte for both labels.
_TOSS_SMALL = bytes(_TOSS[i // 16 * 128 + i % 16] for i in range(256))
TOSSES = 4


def _sizes(starts: np.ndarray, n: int) -> np.ndarray:
    out = np.empty_like(starts)
    np.subtract(starts[1:], starts[:-1], out=out[:-1])
    out[-1] = n - starts[-1]
    return out


def phrases(names: np.ndarray) -> np.ndarray:
    """The names of the phrases of a sequence of names."""
    n = len(names)
    if not n:
        return names
    change = np.empty(n, bool)
    change[0] = True
    np.not_equal(names[1:], names[:-1], out=change[1:])
    if not change.all():
        at = change.nonzero()[0]
        run = _sizes(at, n)
        names = names[at]
        many = run > 1
        names[many] = _mix(names[many] * _K1 + run[many].astype(np.uint64))
        if len(names) > 1 and (names[1:] == names[:-1]).any():  # a hash may, once in 2**64, meet its neighbour
            names = names + np.arange(len(names), dtype=np.uint64) % np.uint64(2)
    n = len(names)
    starts = np.zeros(1, np.int64)
    if n > TOSSES + 2:
        mask = names[1:] ^ names[:-1]
        mask ^= mask - _U1  # all bits up to the lowest one that differs
        label = np.bitwise_count(mask)
        label -= 1
        label *= 2
        label += (names[1:] & mask) > (names[:-1] & mask)
        for toss in range(TOSSES - 1):
            if toss:
                pair = label[:-1] << 4
                pair |= label[1:]
                label = np.frombuffer(pair.tobytes().translate(_TOSS_SMALL), np.uint8)
            else:
                pair = label[:-1].astype(np.intp)
                pair <<= 7
                pair += label[1:]
                label = _TOSS.take(pair)
        up = label[1:] > label[:-1]
        peaks = (up[:-1] > up[1:]).nonzero()[0]
        starts = np.zeros(len(peaks) + 1, np.int64)
        np.add(peaks, TOSSES + 1, out=starts[1:])
    place = np.arange(1, n + 1, dtype=np.uint64)
    place -= np.repeat(starts.astype(np.uint64), _sizes(starts, n))
    place *= _K1
    place ^= names
    return _mix(np.add.reduceat(_mix(place), starts) * _K2)


def fingerprint(text: str) -> np.ndarray:
    """The sorted KEPT smallest 32-bit names of the LEVELS' phrases."""
    if not text:
        return np.empty(0, np.uint32)
    names, out = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64), []
    for level in range(1, max(LEVELS) + 1):
        names = phrases(names)
        if level in LEVELS:
            out.append(names if level == LEVELS[0] else names ^ np.uint64(level))
    found = (np.concatenate(out) >> _U32).astype(np.uint32)
    found.sort()
    first = np.ones(len(found), bool)
    np.not_equal(found[1:], found[:-1], out=first[1:])
    return found[first][:KEPT]


def text_of(f: np.ndarray) -> str:
    return f.astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both, most = np.concatenate((a, b)), max(len(a), len(b))
    both.sort()
    again = both[1:] == both[:-1]  # a value that both have, behind its first: of as many different ones before it as places less such
    return float((again & (np.arange(1, len(both)) - again.cumsum() < most)).sum()) / most


def edited(text: str, following: str) -> str:
    """text with its last quarter replaced by as much of the following text's beginning."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def _range_starts(ranked: DataFrame, range_chars: int) -> np.ndarray:
    """The sorted first ranks of ranges of about range_chars code points, from (rank, n): a value for each goes through the driver."""

    def starts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, last = None, None  # code points since the last start; the last row's rank
        for batch in batches:
            ranks, sizes = batch.column("rank").to_pylist(), batch.column("n").to_pylist()
            out = []
            for rank, n in zip(ranks, sizes, strict=True):
                if held is None or held >= range_chars and rank != last:
                    out.append(rank)
                    held = 0
                held, last = held + n, rank
            yield pa.RecordBatch.from_pydict({"rank": pa.array(out, pa.int64())})

    narrow = ranked.repartitionByRange("rank").sortWithinPartitions("rank")
    return np.sort(np.array([r[0] for r in narrow.mapInArrow(starts, "rank long").collect()], np.int64))


def with_next(docs: DataFrame, range_chars: int = RANGE_CHARS) -> DataFrame:
    """docs' (doc_id, text) dealt by ranges of doc_id: span, guest, doc_id, text, sorted by them in each partition.

    Every range ends with a guest, the first document of the next one (of the first, after the last).  Texts are shuffled
    once.  The ranges' first ids, 8 bytes for each range, go through the driver and to every task: 17 million ranges, or
    133 MB, for 100 TB of text at the default range_chars, 1.6 million at ten times that.
    """
    rank = F.coalesce("doc_id", F.lit(-(1 << 63))).alias("rank")
    firsts = _range_starts(docs.select(rank, F.coalesce(F.length("text"), F.lit(0)).alias("n")), range_chars)

    @F.pandas_udf("span int, host int")
    def place(ranks: pd.Series) -> pd.DataFrame:
        r = ranks.to_numpy(np.int64)
        span = np.searchsorted(firsts, r, side="right") - 1
        host = pd.Series((span - 1) % len(firsts)).where(firsts[span] == r)  # the range before, for which a first one is the guest
        return pd.DataFrame({"span": span.astype(np.int32), "host": host.astype("Int32")})

    keyed = docs.select("doc_id", "text", rank).withColumn("at", place("rank"))
    places = F.array_compact(F.array(F.struct(F.col("at.span").alias("span"), F.lit(0).alias("guest")), F.when(F.col("at.host").isNotNull(), F.struct(F.col("at.host").alias("span"), F.lit(1).alias("guest")))))
    dealt = keyed.select("doc_id", "text", "rank", F.explode(places).alias("p")).select("doc_id", "text", "rank", "p.span", "p.guest")
    spark = docs.sparkSession  # a partition holds many ranges, one after another: as many as keep all cores busy, and none too large
    enough = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism, -(-len(firsts) // RANGES_A_TASK))
    return dealt.repartition(max(1, min(len(firsts), enough)), "span").sortWithinPartitions("span", "guest", "rank", F.xxhash64("text")).select("span", "guest", "doc_id", "text")


def compared(docs: DataFrame, range_chars: int = RANGE_CHARS) -> DataFrame:
    """Each document's fingerprint, its edited text's, and their likeness to each other and to the next document's."""
    schema = [("n_chars", "long"), ("edited_sha256", "string"), ("fingerprint", "string"), ("edited_fingerprint", "string"), ("near_edited", "double"), ("near_next", "double")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, last_id = None, pa.array([None], pa.int64())  # the row before, of which the next one completes the results
        for batch in batches:
            ids = pa.concat_arrays([last_id, batch.column("doc_id").cast(pa.int64())])
            for lo in range(0, batch.num_rows, 500):
                part, at, rows = batch.slice(lo, 500), [], []
                for k, (span, guest, text) in enumerate(zip(*(part.column(c).to_pylist() for c in ("span", "guest", "text")), strict=True), lo):
                    text = text or ""
                    mine = fingerprint(text)
                    if last and not last[1] and last[0] == span:
                        _, _, before, f = last
                        changed = edited(before, text)
                        g = fingerprint(changed) if changed != before else f
                        rows.append((len(before), hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(), text_of(f), text_of(g), likeness(f, g), likeness(f, mine)))
                        at.append(k)
                    last = (span, guest, text, mine)
                columns = [pa.array([r[i] for r in rows], ARROW[t]) for i, (_, t) in enumerate(schema)]
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(at, pa.int64())), *columns], ["doc_id", *(n for n, _ in schema)])
            last_id = ids.slice(len(ids) - 1)

    return with_next(docs.select("doc_id", "text"), range_chars).mapInArrow(run, "doc_id long, " + ", ".join(f"{n} {t}" for n, t in schema))
