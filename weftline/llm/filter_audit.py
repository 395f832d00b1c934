"""Filter interaction audit: what each filter of a chain removes, in every order of the filters.

One pass over the texts gives each document its failure mask, a bit for each filter.  All that any order does to a part
follows from the part's cells: how many documents have each mask (and how many of them are good, or toxic), at most
2 ** filters numbers a part.  Orders are visited by single swaps of neighbours (adjacent transpositions), so each visit
changes two steps only: of the documents that no earlier filter takes, those that fail both swapped filters move
from one step to the other, and everything else stands.  A filter's removals, summed along the walk, are its Shapley
value times the number of orders.

Repeats of a text (the filter E) need all documents: texts are known by their SHA-256, each hash's smallest doc_id
is found by a pre-aggregated grouping and joined back, so a hot text is split by the skew join and never gathered.

Defined results: null texts are empty; a null part is the empty string; a document without an id is no repeat and makes
none; rows with equal ids and texts do not repeat each other; a document is good (toxic) if any label row of its id (not null)
has quality (toxic) 1; repeated rows count each; an empty table gives no rows; extra columns are ignored.  A text is one
value of Spark and its words one array, so very long texts need a few times their size in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, let, map_rows, written

SPACE = r"[\x20\x09-\x0D]+"
#: What a step of an order reports, in this order.
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def failures(text: Column) -> dict[str, Column]:
    """The failure condition of each filter that sees one text, by its letter."""
    words = F.array_remove(F.split(text, SPACE), "")
    counted = let(words, lambda w: F.struct(F.size(w).alias("n"), F.size(F.array_distinct(w)).alias("distinct")))
    few = lambda c: F.array(c["n"] < 50, 100 * c["distinct"] < 65 * c["n"])
    both = let(counted, few)
    upper = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return {"A": both[0], "B": both[1], "C": 100 * upper > 5 * F.length(text), "D": text.rlike("[#$%&*|]")}


def masks(docs: DataFrame, fails: dict[str, Column], repeats: bool = True, part: str = "source") -> DataFrame:
    """(doc_id, part, mask) of every document; bit i is the i-th filter of `fails`, the last one repetition if asked for."""
    text = F.coalesce("text", F.lit(""))
    bits = sum((F.shiftleft(f.cast("int"), i) for i, f in enumerate(fails.values())), F.lit(0))
    rows = docs.select("doc_id", F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), bits.alias("mask"), *([F.unhex(F.sha2(text.cast("binary"), 256)).alias("key")] if repeats else []))
    if not repeats:
        return rows
    rows = written(rows, "masks")
    first = rows.groupBy("key").agg(F.min("doc_id").alias("first"))
    again = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False)).cast("int")
    out = rows.join(first, "key").select("doc_id", "part", (F.col("mask") + F.shiftleft(again, len(fails))).alias("mask"))
    out._weft_path = rows._weft_path
    return out


def cells(masked: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents of each part and mask."""
    is_one = lambda c: F.coalesce(F.max(F.col(c) == 1), F.lit(False)).cast("long").alias(c)
    known = labels.where("doc_id is not null and (quality = 1 or toxic = 1)").groupBy("doc_id").agg(is_one("quality"), is_one("toxic"))
    rows = masked.join(known, "doc_id", "left")
    return rows.groupBy("part", "mask").agg(F.count("*").alias("n"), F.coalesce(F.sum("quality"), F.lit(0)).alias("good"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"))


def swaps(n: int) -> Iterator[int]:
    """Positions i whose swap with i + 1 leads from one order of n things to the next, through all n! orders."""
    place, way = list(range(n)), [-1] * n  # of each thing
    at = list(range(n))
    while True:
        for thing in range(n - 1, 0, -1):
            to = place[thing] + way[thing]
            if 0 <= to < n and at[to] < thing:
                break
            way[thing] = -way[thing]  # and the next smaller one tries
        else:
            return
        other, here = at[to], place[thing]
        at[here], at[to], place[thing], place[other] = other, thing, to, here
        yield min(here, to)


def walk(table: np.ndarray, letters: str) -> tuple[list[str], np.ndarray]:
    """For cells [parts, masks, (n, good, toxic)]: every order, and [parts, orders, steps, COUNTS]."""
    filters, every = len(letters), np.arange(table.shape[1])
    number = lambda chosen: table[:, chosen].sum(1)
    fails = np.stack([number(every >> f & 1 == 1)[:, 0] for f in range(filters)], 1)
    alone = np.stack([table[:, 1 << f, 0] for f in range(filters)], 1)
    order, lost = list(range(filters)), []  # lost: of each step, what it removes
    for i, f in enumerate(order):
        lost.append(number((every >> f & 1 == 1) & (every & (1 << i) - 1 == 0)))
    total, orders, steps, shapley = table[:, :, 0].sum(1), [], [], np.zeros((len(table), filters), np.int64)

    def visit() -> None:
        removed = np.stack(lost, 1)
        shapley[:, order] += removed[:, :, 0]
        orders.append("".join(letters[f] for f in order))
        steps.append(np.stack([total[:, None] - removed[:, :, 0].cumsum(1), removed[:, :, 0], fails[:, order] - removed[:, :, 0], alone[:, order], removed[:, :, 1], removed[:, :, 2]], 2))

    visit()
    for i in swaps(filters):
        x, y = order[i], order[i + 1]
        before = sum(1 << f for f in order[:i])
        moved = number((every & before == 0) & (every >> x & 1 == 1) & (every >> y & 1 == 1))
        lost[i], lost[i + 1] = lost[i + 1] + moved, lost[i] - moved
        order[i], order[i + 1] = y, x
        visit()
    sums = np.stack([shapley[:, [letters.index(c) for c in o]] for o in orders], 1)
    return orders, np.concatenate([np.stack(steps, 1), sums[..., None]], 3)


def audited(counted: DataFrame, letters: str) -> DataFrame:
    """A row for each part, order and step: part, filter_order, step and COUNTS; parts are walked in parallel, many at a time."""

    def start():
        def make(parts: list[list[dict]]) -> dict:
            table = np.zeros((len(parts), 1 << len(letters), 3), np.int64)
            for p, found in enumerate(parts):
                for c in found:
                    table[p, c["mask"]] = c["n"], c["good"], c["toxic"]
            orders, out = walk(table, letters)
            n, each = len(orders), len(letters)
            columns = dict(zip(COUNTS, out.reshape(-1, len(COUNTS)).T, strict=True))
            return {None: np.repeat(np.arange(len(parts)), n * each), "filter_order": np.tile(np.repeat(orders, each), len(parts)), "step": np.tile(np.arange(1, each + 1, dtype=np.int32), len(parts) * n)} | columns

        return make

    by_part = counted.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("found"))  # at most 2 ** filters
    return map_rows(by_part, "found", start, "filter_order string, step int, " + ", ".join(f"{c} long" for c in COUNTS), 200)


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The five filters A to E over docs, by source, in all 120 orders."""
    masked = masks(docs, failures(F.coalesce("text", F.lit(""))))
    counted = written(cells(masked, labels), "cells")
    discard(masked)
    return audited(counted, "ABCDE")


#: DuckDB: masks, then every order's prefixes against the cells.
AUDIT_SQL = r"""
WITH w AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
m AS (SELECT doc_id, part, CAST(len(ws) < 50 AS INT) + 2 * CAST(100 * len(list_distinct(ws)) < 65 * len(ws) AS INT) + 4 * CAST(100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) AS INT)
  + 8 * CAST(regexp_matches(t, '[#$%&*|]') AS INT) + 16 * CAST(coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS INT) AS mask FROM w),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
c AS (SELECT part, mask, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic FROM m LEFT JOIN l ON l.doc_id = m.doc_id GROUP BY part, mask),
f AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS f(l, b)),
p AS (SELECT [a.b, b.b, c.b, d.b, e.b] AS bits, a.l || b.l || c.l || d.l || e.l AS filter_order FROM f AS a, f AS b, f AS c, f AS d, f AS e WHERE a.b | b.b | c.b | d.b | e.b = 31),
s AS (SELECT filter_order, step, bits[step] AS b, list_sum(list_slice(bits, 1, step - 1)) AS before FROM p, range(1, 6) AS r(step)),
o AS (SELECT part, filter_order, step, b, sum(CASE WHEN mask & (coalesce(before, 0)::INT | b) = 0 THEN n ELSE 0 END) AS kept, sum(CASE WHEN mask & coalesce(before, 0)::INT = 0 AND mask & b > 0 THEN n ELSE 0 END) AS removed,
  sum(CASE WHEN mask & coalesce(before, 0)::INT > 0 AND mask & b > 0 THEN n ELSE 0 END) AS redundant, sum(CASE WHEN mask = b THEN n ELSE 0 END) AS unique_fails,
  sum(CASE WHEN mask & coalesce(before, 0)::INT = 0 AND mask & b > 0 THEN good ELSE 0 END) AS good_lost, sum(CASE WHEN mask & coalesce(before, 0)::INT = 0 AND mask & b > 0 THEN toxic ELSE 0 END) AS toxic_lost FROM c, s GROUP BY part, filter_order, step, b)
SELECT part, filter_order, CAST(step AS INT) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
  CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, b) AS BIGINT) AS shapley FROM o
"""
