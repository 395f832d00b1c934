"""N-gram Jaccard join by T-occurrence search with DivideSkip, and the classes that its links form.

A document's set is its distinct `size`-word shingles as 64-bit hashes.  Documents with equal sets are one class.

Routing.  Two sets with Jaccard at least num/den differ in at most H elements (H follows from their sizes), so of
H + 1 ranges of the hash space at least one holds the same elements in both.  Each class sends one signature per
range; classes that share a signature belong to one candidate block.  Shingles common to many documents are left out
of the ranges while enough others remain, so boilerplate does not tie unrelated documents.  Copies inside one slice
of a batch are tied locally first, and a task ties what it has sent before to its first owner, so a hot signature arrives
at its reducer about once per task.  Signatures are most of what is shuffled, about twice the input, so they can be sent in
passes by hash range, as deduplicated() does: each pass makes them anew and sends its own share, and its shuffle files go before the next.

Sketches.  Signatures can still chain unlike classes into large blocks, so before any text moves,
the classes of a block are compared by sketches: how many of a set's shingles fall into each of some buckets.  Two
sets' counts differ by no more in all than the sets do, so classes whose counts differ by more than linked sets can
are not alike; the components of those that may be are the blocks of the search.

Search.  Inside a block every class's required overlap T is searched in inverted lists: short lists are merged by
counting, the longest (fewer than T) are only probed by binary search for what the merge left (DivideSkip).  A query
is skipped only when its class and all it could meet are already in one component, so no link between components is
lost.  Blocks over MAX_BLOCK classes (MAX_SKETCHES where sketches are compared) are cut into chunks of which every
two meet in a task.

Defined results: null and empty texts have no set, link with nothing and are components of their own; component_id
ignores null doc_ids and is null where a component has no other; repeated rows and doc_ids each get a row; extra
columns are ignored.  Hashes stand for shingles: two unequal ones meet with probability 2**-64 each.  An empty table gives no rows.  A text is read whole however long it is:
its shingles are one array of hashes in one task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean, lean_group, small, written
from .components import components

#: Most classes, and most shingles, in one search; larger blocks are cut into chunks of half as many.
MAX_BLOCK, MAX_SHINGLES = 800, 1_000_000
#: Most classes, and most shingles, of which sketches are compared in one go.
MAX_SKETCHES, MAX_SKETCHED = 4000, 8_000_000
#: Classes that are searched, or whose sketches are compared, in one group; larger blocks are groups of their own.
BIN, SKETCH_BIN = 150, 2000
#: Buckets of a sketch: the least power of two that gives one to four shingles, within these bounds.
LEAST_BUCKETS, MOST_BUCKETS = 64, 8192
LEVELS = 3
#: Signatures met more than once that a task keeps to send them once; beyond, they are sent once a slice.
HOT_SIGNATURES = 200_000
#: Passes in which deduplicated() sends signatures, and the rows from which more than one is made.
PASSES, PASSES_FROM = 3, 20_000
#: What the classes of whole sets are numbered from.
WHOLE = 1000
#: A shingle is common if COMMON_SHARE of all documents, and COMMON_LEAST, have it, as counted in slices where BATCH_COMMON do.
BATCH_COMMON, COMMON_SHARE, COMMON_LEAST = 2, 0.0005, 60
#: Lists longer than this are candidates for probing instead of merging.
LONG_LIST = 64
_M1, _M2, _K1, _K2, _K3 = (np.uint64(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def _tag(*parts: int) -> np.uint64:
    return np.uint64(xxhash.xxh3_64_intdigest(repr(parts).encode()))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, size: int) -> np.ndarray:
    """The sorted distinct hashes of the text's shingles; fewer words than size are one shingle."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # of bytes: A-Z only, and ASCII white space only
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < size:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=len(words))], np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n, odd = len(words) - size + 1, _K1
    total = np.zeros(n, np.uint64)
    for i in range(size):
        total = total * odd + h[i : i + n]
    return np.unique(mix(total))


def set_key(tokens: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(tokens.tobytes(), seed=len(tokens)) - (1 << 63)


def _class_bounds(n: int) -> tuple[int, int, int]:
    """The size class of n: its number and its least and greatest size."""
    c, lo = 0, 1
    while True:
        hi = max(lo, lo * 3 // 2)
        if n <= hi:
            return c, lo, hi
        c, lo = c + 1, hi + 1


def _ranges(lo: int, hi: int, num: int, den: int) -> tuple[int, int]:
    """For sets of up to hi elements: how many ranges, and how many that both hold may be of no use (empty, or common)."""
    least = 2 * hi * (den - num) // (den + num) + 1
    mu = least * math.exp(-lo / least)
    spare = 0 if least < 3 else math.ceil(mu + 2 * math.sqrt(mu)) + least // 16 + 1
    return least + spare, spare


def _classes_of(n: int, num: int, den: int) -> Iterator[tuple[int, int, int]]:
    """The size classes in which a set of n elements meets its partners."""
    c, lo, hi = _class_bounds(n)
    while True:
        yield c, lo, hi
        c, lo, hi = c + 1, hi + 1, max(hi + 1, (hi + 1) * 3 // 2)
        if n * den < num * lo:
            return


def _level(tokens: np.ndarray, c: int, ranges: int, level: int) -> tuple[np.ndarray, np.ndarray]:
    """A level's signatures, and the numbers of the ranges that they are of."""
    t = tokens if not level else np.sort(mix(tokens ^ _tag(level)))
    at = ((t >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)
    first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    return mix(np.add.reduceat(t, first) * _K1 + at[first] * _K2 ^ _tag(c, level)), at[first]


def _cut(tokens: np.ndarray, c: int, ranges: int, spare: int, out: list[np.ndarray]) -> bool:
    """Adds the signatures of one level after another until at most `spare` ranges of a level are empty; whether one was."""
    for level in range(LEVELS):
        sig, at = _level(tokens, c, ranges, level)
        out.append(sig)
        if ranges - len(at) <= spare:
            return True
    return False


def signatures(tokens: np.ndarray, num: int, den: int, common: np.ndarray | None = None) -> np.ndarray:
    """64-bit signatures of which any two sets with Jaccard >= num/den share at least one.

    Rare tokens alone differ as little as whole sets do, so they are cut first: tokens common to many documents (a
    sorted array, the same for all sets; any will do) tie nothing.  Of two partners' ranges more than `spare` are alike;
    if a level has at most that many empty in one of them, they share a signature there.  Sets with more empty ones on
    every level are cut anew with all their tokens, and if that leaves too many too, send their empty ranges.
    """
    out: list[np.ndarray] = []
    rare = tokens
    if common is not None and len(common) and len(tokens):
        rare = tokens[common[np.minimum(np.searchsorted(common, tokens), len(common) - 1)] != tokens]
    for c, lo, hi in _classes_of(len(tokens), num, den) if len(tokens) else ():
        ranges, spare = _ranges(lo, hi, num, den)
        if len(rare) and _cut(rare, c, ranges, spare, out):
            continue
        if not _cut(tokens, c + WHOLE, ranges, spare, out):
            at = _level(tokens, c + WHOLE, ranges, LEVELS - 1)[1]
            out.append(mix(np.setdiff1d(np.arange(ranges, dtype=np.uint64), at) * _K1 ^ _tag(c, WHOLE)))
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def _slices(batches: Iterator[pa.RecordBatch], n: int = 1000) -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    """The batches in slices of so many rows, with their texts: no more are Python objects at a time."""
    for batch in batches:
        for lo in range(0, batch.num_rows, n):
            part = batch.slice(lo, n)
            yield part, part.column("text").to_pylist()


def _int64(**columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({k: pa.array(v.view(np.int64)) for k, v in columns.items()})


def _frequent(size: int):
    """Shingles that several classes of a batch share, with their number."""

    def frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in _slices(batches, 3000):
            sets, seen = [], set()
            for text in texts:
                tokens = shingles(text, size)
                if len(tokens) and (key := set_key(tokens)) not in seen:
                    seen.add(key)
                    sets.append(tokens)
            if sets:
                token, n = np.unique(np.concatenate(sets), return_counts=True)
                yield _int64(token=token[n >= BATCH_COMMON], n=n[n >= BATCH_COMMON])

    return frequent


def _route(size: int, num: int, den: int, common: np.ndarray, nth: int = 0, passes: int = 1):
    """Signatures with their keys, those of the nth pass."""

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot, hot_owner = np.empty(0, np.uint64), np.empty(0, np.int64)  # signatures met more than once in this task, and their first keys
        for _, texts in _slices(batches):
            keys, sigs = [], []
            seen = set()
            for text in texts:
                tokens = shingles(text, size)
                if len(tokens) and (key := set_key(tokens)) not in seen:
                    seen.add(key)
                    s = np.unique(signatures(tokens, num, den, common))
                    if passes > 1:
                        s = s[((s >> np.uint64(32)) * np.uint64(passes)) >> np.uint64(32) == nth]
                        if not len(s):
                            continue
                    sigs.append(s)
                    keys.append(np.full(len(s), key, np.int64))
            if not keys:
                continue
            sig, key = np.concatenate(sigs), np.concatenate(keys)
            order = np.lexsort((key, sig))
            sig, key = sig[order], key[order]
            first = np.r_[True, sig[1:] != sig[:-1]]
            owner = key[first][np.cumsum(first) - 1]  # the smallest key of each signature here
            tied = np.stack([owner[~first], key[~first]])
            if not first.all() and len(hot) < HOT_SIGNATURES:
                more = np.flatnonzero(first)[np.unique(np.cumsum(first)[~first] - 1)]
                more = more[~np.isin(sig[more], hot)]
            else:
                more = np.empty(0, np.int64)
            if len(hot):  # those this task has sent before are tied to their owners instead
                at = np.minimum(np.searchsorted(hot, sig), len(hot) - 1)
                known = first & (hot[at] == sig)
                tied = np.concatenate([tied, np.stack([hot_owner[at[known]], key[known]])], axis=1)
                first &= ~known
            if len(more):
                hot, hot_owner = np.r_[hot, sig[more]], np.r_[hot_owner, key[more]]
                order = np.argsort(hot)
                hot, hot_owner = hot[order], hot_owner[order]
            tied = np.unique(tied[:, tied[0] != tied[1]], axis=1)
            salt = np.bitwise_xor.reduce(np.unique(key)).view(np.uint64) if len(key) else np.uint64(0)
            pseudo = mix(mix(tied[0].view(np.uint64)) ^ salt ^ _K3)
            yield _int64(sig=np.concatenate([sig[first], pseudo, pseudo]), key=np.concatenate([key[first], tied[0], tied[1]]))

    return route


def sketch(tokens: np.ndarray) -> np.ndarray:
    """How many of the tokens fall into each bucket, up to 255 (which brings two sketches no further apart)."""
    buckets = LEAST_BUCKETS
    while buckets < MOST_BUCKETS and 4 * buckets < len(tokens):
        buckets *= 2
    at = (tokens & np.uint64(buckets - 1)).astype(np.int64)
    return np.minimum(np.bincount(at, minlength=buckets), 255).astype(np.uint8)


def _folded(counts: np.ndarray, buckets: int) -> np.ndarray:
    """The sketch that the same tokens have with fewer buckets."""
    return counts.reshape(-1, buckets).sum(axis=0, dtype=np.int32)


def alike(sizes: np.ndarray, sketches: list[np.ndarray], num: int, den: int) -> list[tuple[int, int]]:
    """A spanning forest of the pairs (i, j) whose sketches leave it open that their sets' Jaccard is num/den or more."""
    order = np.argsort(sizes, kind="stable")
    n, wide = sizes[order], np.array([len(sketches[i]) for i in order])
    upto = np.searchsorted(n, n * den // num, side="right")  # beyond, sets are too large to link with this one
    label, links = np.arange(len(n)), []
    for buckets in np.unique(wide):
        lo, hi = np.searchsorted(wide, [buckets, buckets + 1])  # sketches grow with sizes
        counts = np.stack([_folded(sketches[i], buckets) for i in order[lo : upto[hi - 1]]])
        for i in range(lo, hi):
            others = i + 1 + np.flatnonzero(label[i + 1 : upto[i]] != label[i])
            if len(others):
                apart = np.abs(counts[others - lo] - counts[i - lo]).sum(axis=1, dtype=np.int64)
                for j in others[apart * (num + den) <= (n[i] + n[others]) * (den - num)]:
                    if label[j] != label[i]:
                        label[label == label[j]] = label[i]
                        links.append((int(order[i]), int(order[j])))
    return links


def _alike(num: int, den: int):
    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, block in rows.drop_duplicates(["block", "chunks", "key"]).groupby(["block", "chunks"]):
            keys = block["key"].to_numpy()
            pairs = alike(block["n_shingles"].to_numpy(), [np.frombuffer(x, np.uint8) for x in block["sketch"]], num, den)
            out += [(keys[i], keys[j]) for i, j in pairs]
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return compare


def _sets(size: int):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in _slices(batches):
            tokens = [shingles(x, size) for x in texts]
            n, keys = pa.array([len(x) for x in tokens], pa.int64()), pa.array([set_key(x) if len(x) else None for x in tokens], pa.int64())
            sketches = pa.array([sketch(x).tobytes() if len(x) else None for x in tokens], pa.binary())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), n, keys, sketches], ["doc_id", "n_shingles", "key", "sketch"])

    return sets


def link_block(sets: list[np.ndarray], num: int, den: int) -> list[tuple[int, int]]:
    """Links that connect what any chain of pairs with Jaccard >= num/den connects: a spanning forest of (i, j)."""
    m = len(sets)
    size = np.array([len(x) for x in sets])
    doc = np.repeat(np.arange(m), size)
    inverse = np.unique(np.concatenate(sets), return_inverse=True)[1].astype(np.int32)
    posting = doc[np.argsort(inverse, kind="stable")].astype(np.int32)
    length = np.bincount(inverse)
    start = np.r_[0, np.cumsum(length)]
    at = np.r_[0, np.cumsum(size)]
    root = np.arange(m)

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    score = np.add.reduceat(length[inverse], at[:-1])
    links, hub = [], -1
    for q in np.argsort(-score, kind="stable"):
        if hub >= 0 and find(q) == find(hub):
            continue  # what it could still meet lies outside the hub's component, and asks for itself
        mine = inverse[at[q] : at[q + 1]]
        n = len(mine)
        need = -(-num * (n + max(1, -(-num * n // den))) // (num + den))  # the least overlap with the smallest partner
        by = mine[np.argsort(length[mine], kind="stable")]
        long = by[max(0, n - max(0, need - 1)) :]
        long = long[length[long] > LONG_LIST]
        short = by[: n - len(long)]
        count = np.bincount(np.concatenate([posting[start[t] : start[t + 1]] for t in short]), minlength=m)
        found = np.flatnonzero(count >= max(1, need - len(long)))
        over = count[found]
        for t in long:
            part = posting[start[t] : start[t + 1]]
            i = np.searchsorted(part, found)
            over = over + (part[np.minimum(i, len(part) - 1)] == found)
        for j in found[den * over >= num * (n + size[found] - over)]:
            a, b = find(q), find(j)
            if a != b:
                root[max(a, b)] = min(a, b)
                links.append((int(q), int(j)))
        if hub < 0 and links:
            hub = q  # the first to link, of those with the most common shingles
    return links


def _search(size: int, num: int, den: int):
    def search(rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, block in rows.groupby(["block", "chunks"]):
            found = {}
            for key, text in zip(block["key"], block["text"], strict=True):
                if key not in found and set_key(tokens := shingles(text, size)) == key:
                    found[key] = tokens
            keys = list(found)
            if len(keys) > 1:
                out += [(keys[i], keys[j]) for i, j in link_block(list(found.values()), num, den)]
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return search


def _in_groups(blocks: DataFrame, one: DataFrame, most: int, most_shingles: int, bin_size: int) -> DataFrame:
    """(doc_id, key, block, chunks, bin) of every class in a block: rows of a bin go to one group, and in it those of equal (block, chunks) meet."""
    member = written(blocks.join(one, F.col("node") == F.col("key")).select("doc_id", "key", "n", F.col("component").alias("block")), "members")
    of_block = member.groupBy("block").agg(F.count("*").alias("classes"), F.sum("n").alias("shingles"))
    parts = F.greatest(F.ceil(F.col("classes") / (most / 2)), F.ceil(F.col("shingles") / (most_shingles / 2))).cast("int")
    of_block = of_block.withColumn("parts", F.when((F.col("classes") <= most) & (F.col("shingles") <= most_shingles), 1).otherwise(parts))
    many, total = of_block.agg(F.coalesce(F.max("parts"), F.lit(0)), F.coalesce(F.sum("classes"), F.lit(0))).first()
    member, parts = member.join(of_block, "block").select("doc_id", "key", "block", "classes", "parts"), F.col("parts")
    mine = F.pmod(F.xxhash64("key"), parts).cast("int")
    if many > 1:
        whole = F.when(parts == 1, F.array(F.lit("")))
        pair = F.transform(F.sequence(F.lit(0), parts - 1), lambda i: F.concat_ws("-", F.least(i, mine), F.greatest(i, mine)))
        other = F.filter(pair, lambda p: F.substring_index(p, "-", 1) != F.substring_index(p, "-", -1))
        member = member.withColumn("chunks", F.explode(F.coalesce(whole, other)))
    else:
        member = member.withColumn("chunks", F.lit(""))
    bins = max(1, math.ceil(total / bin_size))
    bin_ = F.when(F.col("classes") > bin_size, F.concat_ws("/", "block", "chunks")).otherwise(F.pmod(F.xxhash64("block"), F.lit(bins)).cast("string"))
    return small(written(member.select("doc_id", "key", "block", "chunks", bin_.alias("bin")), "members"))


def classes(docs: DataFrame, size: int = 3, num: int = 90, den: int = 100, max_block: int = MAX_BLOCK, max_sketches: int = MAX_SKETCHES, passes: int = 1) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id; documents link when den * common >= num * together.

    With more passes less is on disk at a time, and signatures are made so many times.
    """
    text = docs.select("doc_id", "text")
    sets = written(text.mapInArrow(lean(_sets(size)), "doc_id long, n_shingles long, key long, sketch binary"), "sets")

    # At most (shingles of a document) / COMMON_SHARE values, whatever the corpus; which they are changes cost, not results.
    count = sets.count()
    least = max(COMMON_LEAST, int(COMMON_SHARE * count))
    often = text.mapInArrow(lean(_frequent(size)), "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    common = np.sort(often.select("token").toPandas()["token"].to_numpy(np.int64).view(np.uint64))
    blocks = written(components(_ties(text, size, num, den, common, passes if count >= PASSES_FROM else 1), "key", "low"), "blocks")

    one = sets.where("key is not null and doc_id is not null").groupBy("key").agg(F.min("doc_id").alias("doc_id"), F.max("n_shingles").alias("n"))
    member = _in_groups(blocks, one, max_sketches, MAX_SKETCHED, SKETCH_BIN)
    near = sets.select("doc_id", "key", "n_shingles", "sketch").join(member, ["doc_id", "key"]).groupBy("bin").applyInPandas(lean_group(_alike(num, den)), "a long, b long")
    blocks = written(components(near, "a", "b"), "blocks")

    member = _in_groups(blocks, one, max_block, MAX_SHINGLES, BIN)
    links = text.join(member, "doc_id").groupBy("bin").applyInPandas(lean_group(_search(size, num, den)), "a long, b long")

    linked = written(components(links, "a", "b"), "linked")
    label = linked.join(one, F.col("node") == F.col("key"), "left")
    least = label.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    label = linked.join(least, "component").select(F.col("node").alias("key"), "component_id")
    label = one.join(label, "key", "left").select("key", F.coalesce("component_id", "doc_id").alias("component_id"))
    out = sets.select("doc_id", "n_shingles", "key").join(label, "key", "left")
    return out.select("doc_id", "n_shingles", F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def _ties(text: DataFrame, size: int, num: int, den: int, common: np.ndarray, passes: int) -> DataFrame:
    """(key, low): each class with the smallest that it shares a signature with; no signature is of two passes."""
    out = None
    for nth in range(passes):
        routed = text.mapInArrow(lean(_route(size, num, den, common, nth, passes)), "sig long, key long")
        low = routed.select("sig", "key", F.min("key").over(_by("sig")).alias("low"))
        ties = low.where("key <> low").select("key", "low")
        if passes > 1:
            ties = written(ties.distinct(), "ties")
        out = ties if out is None else out.unionByName(ties)
    return out


def _by(*names: str):
    from pyspark.sql import Window

    return Window.partitionBy(*names)


def deduplicated(docs: DataFrame, size: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The rows of docs that stay when one document of each class stays: that with the smallest doc_id, null ones last, then
    with the smallest hash of id and text, in one row.

    A document is a row's id with its text, so rows that share an id but not the text are documents of their own, and copies
    without an id go too.  Documents without words are no copies of each other and all stay.
    """
    row = F.xxhash64("doc_id", "text").alias("_row")
    found = classes(docs.select(row.alias("doc_id"), "text"), size, num, den, passes=PASSES).where("n_shingles > 0").select(F.col("doc_id").alias("_row"), "component_id").distinct()
    ids = docs.select(row, "doc_id").distinct().join(found, "_row", "left")
    rank = F.struct(F.col("doc_id").isNull(), "doc_id", "_row")
    first = ids.where("component_id is not null").groupBy("component_id").agg(F.min(rank).alias("r")).select("r._row")
    keep = written(first.unionByName(ids.where("component_id is null").select("_row")).distinct(), "kept")
    named = docs.withColumn("_row", row).join(small(keep), "_row", "left_semi")
    again = ids.where("component_id is not null").select("_row").join(small(keep), "_row", "left_semi")
    repeated = docs.select(row).groupBy("_row").count().where("count > 1").join(again.distinct(), "_row", "left_semi").select("_row")
    if repeated.limit(1).count():
        several = small(written(repeated, "repeated"))
        named = named.join(several, "_row", "left_anti").unionByName(named.join(several, "_row", "left_semi").dropDuplicates(["_row"]))
    return named.select(*docs.columns)


#: DuckDB: pairs by shared shingles, then the smallest id that links reach.
CLASSES_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 2), ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 2) + 1)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o FROM s AS a JOIN s AS b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
l AS (SELECT c.x, c.y FROM c JOIN n AS p ON p.doc_id = c.x JOIN n AS q ON q.doc_id = c.y WHERE 100 * c.o >= 90 * (p.n + q.n - c.o)),
r AS (SELECT x, y FROM l UNION SELECT r.x, l.y FROM r JOIN l ON l.x = r.y)
SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, least(w.doc_id, coalesce(m.y, w.doc_id)) AS component_id
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN (SELECT x, min(y) AS y FROM r GROUP BY x) AS m ON m.x = w.doc_id
"""
