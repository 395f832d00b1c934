"""Graphs that fall into many small parts which no edge joins, like every sample's own: small parts are solved where their edges lie, in
batches of whole parts, and only the edges of larger ones are left to rounds of joins.

The small solvers take edges as numbers in the order of the nodes, of many parts at once: rounds pass over all parts of a batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .lineage import cut

#: A part with more rows is left to the rounds.
SMALL_PART = 5_000
#: Rows of whole parts that a task solves at a time.
ROWS_AT_ONCE = 100_000


def _whole_parts(batches: Iterator[pa.RecordBatch], small: int) -> Iterator[tuple[bool, pa.Table]]:
    """(large, rows) of rows sorted by their first column: many whole parts, or some rows of a large one."""
    ready: list[pa.RecordBatch] = []
    open_: list[pa.RecordBatch] = []
    key, large = None, False
    held = lambda x: sum(b.num_rows for b in x)
    for batch in batches:
        if not batch.num_rows:
            continue
        part = batch.column(0).to_numpy(zero_copy_only=False)
        begins = np.flatnonzero(part[1:] != part[:-1]) + 1
        same = key is not None and part[0] == key
        first = int(begins[0]) if len(begins) else batch.num_rows
        if same:
            open_.append(batch.slice(0, first))
        ended = not same or len(begins)
        if ended and key is not None:
            if large:
                if open_:
                    yield True, pa.Table.from_batches(open_)
            else:
                ready += open_
            open_, large = [], False
        last = int(begins[-1]) if len(begins) else 0
        if same:
            if len(begins):
                ready.append(batch.slice(first, last - first))
                open_ = [batch.slice(last)]
        else:
            ready.append(batch.slice(0, last))
            open_ = [batch.slice(last)]
        key = part[-1]
        if large or held(open_) > small:
            yield True, pa.Table.from_batches(open_)
            open_, large = [], True
        if held(ready) >= ROWS_AT_ONCE:
            yield False, pa.Table.from_batches(ready)
            ready = []
    if large:
        if open_:
            yield True, pa.Table.from_batches(open_)
    else:
        ready += open_
    if held(ready):
        yield False, pa.Table.from_batches(ready)


def solved(rows: DataFrame, part: str, solve: Callable[..., dict[str, np.ndarray]], out: dict[str, str]) -> tuple[DataFrame, DataFrame | None]:
    """(what solve() makes of the rows' other columns, of whole parts at a time; the rows of large parts, or None if there are none).

    Rows of one part are known by that column's value, which must be a number or a string; no task holds a part of over SMALL_PART rows.
    """
    columns = [c for c in rows.columns if c != part]
    spark, small = rows.sparkSession, SMALL_PART
    many = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    keyed = rows.select(F.col(part).alias("_part"), *columns).repartition(many, "_part").sortWithinPartitions("_part")
    schema = {**out, **{f"_{c}": keyed.schema[c].dataType.simpleString() for c in columns}, "_large": "boolean"}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for large, t in _whole_parts(batches, small):
            if large:
                yield from _filled(types, {**{f"_{c}": t.column(c) for c in columns}, "_large": pa.array(np.ones(t.num_rows, bool))}, t.num_rows)
            else:
                got = solve(*(t.column(c).to_numpy() for c in columns))
                n = len(next(iter(got.values())))
                yield from _filled(types, {**{c: pa.array(x) for c, x in got.items()}, "_large": pa.array(np.zeros(n, bool))}, n)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    ddl = ", ".join(f"`{c}` {t}" for c, t in schema.items())
    types = to_arrow_schema(_parse_datatype_string(ddl))
    done = cut(keyed.mapInArrow(run, ddl))
    left = done.where("_large").select(*(F.col(f"_{c}").alias(c) for c in columns))
    return done.where("not _large").select(*out), left if left.limit(1).count() else None


def _filled(types: pa.Schema, columns: dict, n: int) -> Iterator[pa.RecordBatch]:
    full = [columns[f.name].cast(f.type) if f.name in columns else pa.nulls(n, f.type) for f in types]
    yield from pa.Table.from_arrays(full, schema=types).to_batches()


def coded(*ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """The different nodes in order, and the ends as their numbers."""
    nodes, number = np.unique(np.concatenate(ends), return_inverse=True)
    return nodes, *np.split(number, len(ends))


def distinct(a: np.ndarray, b: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    pair = np.unique(a * n + b)
    return pair // n, pair % n


def component(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The smallest node that each is joined with, either way."""
    label = np.arange(n)
    while True:
        low, new = np.minimum(label[a], label[b]), label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def levels(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """graph.topological_levels() of numbered edges."""
    level, waits, k = np.full(n, -1), np.bincount(b, minlength=n), 0
    free = waits == 0
    while free.any():
        level[free], k = k, k + 1
        gone = free[a]
        met = b[gone]
        np.subtract.at(waits, met, 1)
        a, b = a[~gone], b[~gone]
        free = np.zeros(n, bool)
        free[met[waits[met] == 0]] = True
    return level


def coloured(a: np.ndarray, b: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(colour, steps) as cycles.coloured() tells them; both are one number, so that the smaller colour comes first."""
    base = n + 1
    told, fresh = np.arange(n) * base, np.ones(n, bool)
    while fresh.any():
        send = fresh[a]
        new = told.copy()
        np.minimum.at(new, b[send], told[a[send]] + 1)
        fresh, told = new != told, new
    return told // base, told % base


def strong(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The smallest node of each one's strongly connected component, by the rounds of cycles.strong_components()."""
    found = np.arange(n)
    a, b = a[a != b], b[a != b]
    while len(a):
        into, out = np.zeros(n, bool), np.zeros(n, bool)
        into[b] = out[a] = True
        inner = into[a] & out[b]
        if not inner.all():
            a, b = a[inner], b[inner]
            continue
        colour = coloured(a, b, n)[0]
        same = colour[a] == colour[b]
        a, b = a[same], b[same]
        back = colour == np.arange(n)
        fresh = back
        while fresh.any():
            more = np.zeros(n, bool)
            more[a[fresh[b]]] = True
            fresh = more & ~back
            back = back | fresh
        members = back & (found == np.arange(n))
        found[members] = colour[members]
        open_ = ~(back[a] | back[b])
        a, b = a[open_], b[open_]
    return found


def kept_acyclic(a: np.ndarray, b: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The edges that cycles.acyclic() keeps."""
    a, b = distinct(a[a != b], b[a != b], n)
    label = strong(a, b, n)
    inner = label[a] == label[b]
    x, y = a[inner], b[inner]
    steps = coloured(x, y, n)[1]
    rank = np.empty(n, np.int64)
    rank[np.lexsort((np.arange(n), np.bincount(y, minlength=n) - np.bincount(x, minlength=n), steps))] = np.arange(n)
    stays = ~inner | (rank[b] > rank[a])
    return a[stays], b[stays]


def on_chain(a: np.ndarray, b: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(head, rank) of links of which each node has one out and one in at most; rings are cut before their smallest node."""
    label = component(a, b, n)
    ring = np.bincount(label, minlength=n) == np.bincount(label[a], minlength=n)
    stays = ~(ring[label[b]] & (label[b] == b))
    head = np.arange(n)
    head[b[stays]] = a[stays]
    rank = (head != np.arange(n)).astype(np.int64)
    while True:
        far = head[head]
        if (far == head).all():
            return head, rank
        head, rank = far, rank + rank[head]


def chosen_first(rank: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which nodes graph.first_choice() keeps, of edges that are told both ways."""
    n = len(rank)
    open_, kept = np.ones(n, bool), np.zeros(n, bool)
    while open_.any():
        both = open_[a] & open_[b]
        a, b = a[both], b[both]
        least = np.full(n, np.iinfo(np.int64).max)
        np.minimum.at(least, a, rank[b])
        now = open_ & (rank < least)
        kept |= now
        open_ &= ~now
        open_[b[now[a]]] = False
    return kept


def near_heads(a: np.ndarray, b: np.ndarray, length: np.ndarray, least: int) -> np.ndarray:
    """Which nodes are less than `least` bases from a node without an edge in, both counted; unknown lengths are no way."""
    n = len(length)
    head = np.zeros(n, bool)
    head[a] = True
    head[b] = False
    depth = np.where(head, length, np.inf)
    depth[~(depth < least)] = np.inf
    fresh = np.isfinite(depth)
    while fresh.any():
        send = fresh[a]  # unknown lengths are NaN, and no NaN is less than anything
        new, way = depth.copy(), depth[a[send]] + length[b[send]]
        ok = way < least
        np.minimum.at(new, b[send][ok], way[ok])
        fresh, depth = new < depth, new
    return np.isfinite(depth)


def ways(a: np.ndarray, b: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, met): all that a way from each a leads to along a's one b, until it turns back; see phasing.scopes()."""
    to = np.full(n, -1)
    to[a] = b
    start, before, at, out = a, a, b, [(a, b)]
    while len(start):
        then = to[at]
        on = (then >= 0) & (then != before)
        start, before, at = start[on], at[on], then[on]
        out.append((start, at))
    return np.concatenate([x for x, _ in out]), np.concatenate([y for _, y in out])
