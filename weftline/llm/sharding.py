"""Sharding by a hierarchical weighted hash tree.

A row descends region, rack and shard levels.  At each node every child draws from a hash of the row's key and the
child's name, scaled by the child's weight (an exponential draw of that rate; the smallest wins), so a child gets rows
in proportion to its weight and a changed weight moves rows only into or out of that child's subtree.

Shards 0 to n - 1 stand in blocks, each a tree of BLOCK = regions x racks x shards of a rack.  A row draws between the newest
block and all before it, by their weights, and descends where it is sent; on a shard that is not open yet it draws again.
No node's name or weight depends on n, so opening one more shard takes rows only into it, at every n.

Slots are gapless in each shard without gathering one: tasks number their own rows for each shard, and the tasks'
counts, a row for each task and shard, are summed up into offsets.

Defined results: null texts have no bytes (size 8); rows with a null doc_id share one key; rows with equal doc_ids share a
shard and have their own slots; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_rows, small, written

SHARDS = 24


@dataclass(frozen=True)
class Node:
    """A subtree: `shard` for a leaf, else children.  Its weight is its leaves'."""

    name: str
    weight: float
    children: tuple["Node", ...] = ()
    shard: int = -1


def parent(name: str, children: list[Node]) -> Node:
    return Node(name, sum(c.weight for c in children), tuple(children))


def topology(regions: int = 4, racks: int = 3, each: int = 2) -> Node:
    """A block: equal shards in racks in regions."""
    number = lambda r, k, s: (r * racks + k) * each + s
    return parent("block", [parent(f"{r}", [parent(f"{r}.{k}", [Node(f"{r}.{k}.{s}", 1.0, (), number(r, k, s)) for s in range(each)]) for k in range(racks)]) for r in range(regions)])


def _draw(keys: np.ndarray, name: str, seed: int) -> np.ndarray:
    """A uniform draw in (0, 1) for each key, from the child's name."""
    import xxhash

    x = keys ^ np.uint64(xxhash.xxh3_64_intdigest(name, seed=seed))
    for shift, odd in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(odd)
    x ^= x >> np.uint64(31)
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) / 2**53


def place(keys: np.ndarray, node: Node, seed: int = 0) -> np.ndarray:
    """The shard of each 64-bit key under node."""
    if not node.children:
        return np.full(len(keys), node.shard, np.int32)
    draws = np.stack([-np.log(_draw(keys, c.name, seed)) / c.weight for c in node.children])
    pick, out = draws.argmin(0), np.empty(len(keys), np.int32)
    for i, c in enumerate(node.children):
        at = pick == i
        out[at] = place(keys[at], c, seed)
    return out


def place_open(keys: np.ndarray, n: int, block: Node | None = None) -> np.ndarray:
    """The shard of each 64-bit key among shards 0 to n - 1, in blocks of one tree's shape."""
    block = block or topology()
    size = int(block.weight)
    out, here = np.empty(len(keys), np.int32), np.arange(len(keys))
    for b in range((n - 1) // size, -1, -1):
        older, again = [], 0
        while len(here):
            k = keys[here]
            if b:
                new = _draw(k, f"block {b}", again), _draw(k, f"before {b}", again)
                before = -np.log(new[1]) / (size * b) < -np.log(new[0]) / size
                older.append(here[before])
                here = here[~before]
            shard = place(keys[here], block, (b << 32) + again) + size * b
            is_open = shard < n
            out[here[is_open]] = shard[is_open]
            here, again = here[~is_open], again + 1
        here = np.concatenate(older) if older else here
    return out


def assign(docs: DataFrame, where: Callable, grown: Callable) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row; where and grown give the shards of an array of keys."""
    rows = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.xxhash64("doc_id").alias("h"),
        F.spark_partition_id().alias("task"),
    )

    def start():
        seen: dict[int, int] = {}

        def make(hashes: list[int]) -> dict:
            keys = np.array(hashes, np.int64).view(np.uint64)
            shard, local = where(keys), []
            for s in shard.tolist():
                local.append(seen.get(s, 0))
                seen[s] = local[-1] + 1
            return {"shard": shard, "grown_shard": grown(keys), "local": local}

        return make

    placed = written(map_rows(rows, "h", start, "shard int, grown_shard int, local long", 10_000), "placed")
    counts = placed.groupBy("task", "shard").count()
    before = Window.partitionBy("shard").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("task", "shard", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    out = placed.join(small(offsets), ["task", "shard"])
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col("base") + F.col("local")).alias("slot"), "grown_shard")


def shards(docs: DataFrame, n: int = SHARDS) -> DataFrame:
    """All docs in shards 0 to n - 1, and where each would be with one shard more."""
    return assign(docs, lambda keys: place_open(keys, n), lambda keys: place_open(keys, n + 1))
