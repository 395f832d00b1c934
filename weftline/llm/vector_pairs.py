"""Embedding near-dedup by PCA-ordered tiled comparison.

Equal vectors of a label are one class, compared once however many copies there are.  All vectors are turned onto
the principal axes of their second moments (a rotation: products stay), sorted by cells of the leading axes and cut into
tiles of bounded size, so a hot label is many tiles and no task holds a label.  Two tiles meet only if the boxes
around their leading coordinates come close enough, and inside a meeting the leading dimensions are multiplied first: what
the rest can add is at most the product of the two suffix norms, so pairs, and whole blocks of them, end as soon as the
cosine cannot reach the threshold.  What is left is decided by the cosine of the vectors themselves in double precision:
no pair of unequal vectors at or over the threshold is lost and none below it is linked.

A meeting returns no pairs but a number of links for each class and a spanning forest of its links, so a large group
of near copies stays linear in what is shuffled after it; components come of the forests by star contraction.

Defined results: vectors that are null, empty or zero, or hold null or non-finite components, and those with a null label,
link with nothing, keep themselves (n_links 0, component_id their own id); vectors of unequal length never link; -0.0
equals 0.0; rows with equal ids are vectors of their own; null ids are passed over in component_id, and where it is null
a row is not kept; repeated rows each get a row; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from .common import discard, written
from .components import components

THRESHOLD = 0.93
#: Numbers of the vectors in a tile, and rows of it that are multiplied at once.
TILE_VALUES, BLOCK = 1 << 18, 512
#: Dimensions that are added at once, axes that bound a tile's box, and axes whose cells order vectors.
STEP, BOX, CELLS = 8, 16, 3
#: Slack of bounds for rounding; the final decision has none.
SLACK = 1e-9


def _vectors(column: pa.Array, dtype: type) -> tuple[np.ndarray, list[np.ndarray]]:
    """Which rows hold a usable vector, and those vectors; -0.0 as 0.0."""
    good, out = [], []
    for i, v in enumerate(column):
        if not v.is_valid or not len(v.values) or v.values.null_count:
            continue
        x = v.values.to_numpy().astype(dtype) + dtype(0)
        if np.isfinite(x).all() and x.any():
            good.append(i)
            out.append(x)
    return np.array(good, np.int64), out


def _label(rows: DataFrame) -> str:
    return rows.schema["label"].dataType.simpleString()


def keyed(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """(vec_id, label, key, size, vector): key and vector are the bytes of a usable vector with a label, else null."""
    dtype = np.float64 if isinstance(rows.schema[vector].dataType, ArrayType) and isinstance(rows.schema[vector].dataType.elementType, DoubleType) else np.float32

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            good, found = _vectors(batch.column("embedding"), dtype)
            keys, sizes, raw = ([None] * batch.num_rows for _ in range(3))
            for i, x in zip(good.tolist(), found, strict=True):
                raw[i] = x.tobytes()
                keys[i], sizes[i] = xxhash.xxh3_128_digest(raw[i]), len(x)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array(keys, pa.binary()), pa.array(sizes, pa.int32()), pa.array(raw, pa.binary())], ["vec_id", "label", "key", "size", "vector"])

    given = rows.select(F.col("vec_id").cast("long"), "label", F.col(vector).alias("embedding"))
    out = given.mapInArrow(run, f"vec_id long, label {_label(rows)}, key binary, size int, vector binary")
    return out.withColumn("key", F.when(F.col("label").isNotNull(), F.col("key")))


def _unit(raw: list[bytes], dtype: type) -> np.ndarray:
    x = np.frombuffer(b"".join(raw), dtype).reshape(len(raw), -1).astype(np.float64)
    x = x / np.abs(x).max(1, keepdims=True)  # so that squares neither vanish nor overflow
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def axes(classes: DataFrame, dtype: type) -> np.ndarray:
    """The principal axes (columns, leading first) of all unit vectors' second moments, shorter ones filled up with zeros.

    Each task sums its own moments and Spark adds them up; what reaches the driver is a square of the vectors' length.
    """
    longest = classes.agg(F.max("size")).first()[0] or 1

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((longest, longest))
        for batch in batches:
            for size, raw in _by_size(batch):
                x = _unit(raw, dtype)
                total[:size, :size] += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(longest**2)), pa.array(total.ravel())], ["i", "v"])

    sums = classes.select("size", "vector").mapInArrow(moments, "i long, v double").groupBy("i").agg(F.sum("v").alias("v")).toPandas()
    total = np.zeros(longest**2)
    total[sums["i"]] = sums["v"]
    return np.linalg.eigh(total.reshape(longest, longest))[1][:, ::-1]


def _by_size(batch: pa.RecordBatch) -> Iterator[tuple[int, list[bytes]]]:
    sizes = batch.column("size").to_numpy()
    for size in np.unique(sizes).tolist():
        yield size, batch.column("vector").take(pa.array(np.flatnonzero(sizes == size))).to_pylist()


def tiles(classes: DataFrame, turn: np.ndarray, dtype: type, threshold: float) -> DataFrame:
    """A row for each tile: label, size, tile, low and high (a box of leading coordinates), and its classes' ids, copies and vectors."""
    reach = np.sqrt(max(0.0, 2 - 2 * threshold)) or 1.0

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.zeros((batch.num_rows, CELLS + 1))
            sizes = batch.column("size").to_numpy()
            for size, raw in _by_size(batch):
                x = _unit(raw, dtype) @ turn[:size, : CELLS + 1]
                at[sizes == size, : x.shape[1]] = x
            order = [*(pa.array(np.floor(at[:, k] / reach).astype(np.int64)) for k in range(CELLS)), pa.array(at[:, 0])]
            yield pa.RecordBatch.from_arrays([*batch.columns, *order], [*batch.schema.names, *(f"c{k}" for k in range(CELLS)), "first"])

    sort = ["label", "size", *(f"c{k}" for k in range(CELLS)), "first"]
    placed = written(classes.mapInArrow(cells, f"label {_label(classes)}, size int, id long, copies long, vector binary, " + ", ".join(f"c{k} long" for k in range(CELLS)) + ", first double"), "placed")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {"key": None, "rows": [], "type": None}

        def closed() -> Iterator[pa.RecordBatch]:
            if held["rows"]:
                (label, size), (ids, copies, raw) = held["key"], zip(*held["rows"], strict=True)
                x = _unit(list(raw), dtype) @ turn[:size, :BOX]
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((label, size, len(ids), x.min(0), x.max(0), np.array(ids, np.int64).tobytes(), np.array(copies, np.int64).tobytes(), b"".join(raw)), (held["type"], *tile_types), strict=True)], tile_names)
                held["rows"] = []

        for batch in batches:
            held["type"] = batch.schema.field("label").type
            for label, size, *row in zip(*(batch.column(c).to_pylist() for c in ("label", "size", "id", "copies", "vector")), strict=True):
                if held["key"] != (label, size) or len(held["rows"]) >= max(64, TILE_VALUES // size):
                    yield from closed()
                    held["key"] = label, size
                held["rows"].append(row)
        yield from closed()

    tile_names = ["label", "size", "n", "low", "high", "ids", "copies", "vectors"]
    tile_types = [pa.int32(), pa.int64(), pa.list_(pa.float64()), pa.list_(pa.float64()), pa.binary(), pa.binary(), pa.binary()]
    ordered = placed.repartitionByRange(*sort).sortWithinPartitions(*sort).select("label", "size", "id", "copies", "vector")
    out = ordered.mapInArrow(cut, f"label {_label(classes)}, size int, n long, low array<double>, high array<double>, ids binary, copies binary, vectors binary")
    out = written(out.withColumn("tile", F.monotonically_increasing_id()), "tiles")
    discard(placed)
    return out


def _gap(low: str, high: str, other_low: str, other_high: str) -> Column:
    """The squared distance of two boxes."""
    apart = F.zip_with(F.zip_with(low, other_high, lambda a, b: a - b), F.zip_with(other_low, high, lambda a, b: a - b), lambda a, b: F.greatest(a, b, F.lit(0.0)))
    return F.aggregate(apart, F.lit(0.0), lambda s, v: s + v * v)


def linked(x: np.ndarray, y: np.ndarray, turned_x: np.ndarray, turned_y: np.ndarray, threshold: float) -> np.ndarray:
    """Which pairs of unit vectors (rows of x and y; turned: on the principal axes) have a cosine of threshold or more."""
    dims, out = turned_x.shape[1], np.zeros((len(x), len(y)), bool)
    rest_x, rest_y = (np.sqrt(np.maximum(np.cumsum((t * t)[:, ::-1], 1)[:, ::-1], 0)) for t in (turned_x, turned_y))
    sums, done, pairs = np.zeros((len(x), len(y))), 0, None
    while done < dims:
        upto = min(dims, done + STEP)
        if pairs is None:
            sums += turned_x[:, done:upto] @ turned_y[:, done:upto].T
        else:
            sums += np.einsum("ij,ij->i", turned_x[pairs[0], done:upto], turned_y[pairs[1], done:upto])
        done = upto
        if done == dims:
            break
        if pairs is None:
            alive = sums + np.outer(rest_x[:, done], rest_y[:, done]) >= threshold - SLACK
            if 4 * (n := int(alive.sum())) <= alive.size:  # few enough to go on pair by pair
                pairs, sums = np.nonzero(alive), sums[alive]
        else:
            alive = sums + rest_x[pairs[0], done] * rest_y[pairs[1], done] >= threshold - SLACK
            pairs, sums, n = (pairs[0][alive], pairs[1][alive]), sums[alive], int(alive.sum())
        if not n:
            return out
    near = sums >= threshold - SLACK
    at = np.nonzero(near) if pairs is None else (pairs[0][near], pairs[1][near])
    for lo in range(0, len(at[0]), 1 << 16):  # the decision, by the vectors themselves
        i, j = at[0][lo : lo + (1 << 16)], at[1][lo : lo + (1 << 16)]
        yes = np.einsum("ij,ij->i", x[i], y[j]) >= threshold
        out[i[yes], j[yes]] = True
    return out


def forest(links: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For a symmetric matrix of links: (member, root) of every component with a link, root its first member."""
    waiting = links.any(1)
    members, roots = [], []
    for root in np.flatnonzero(waiting).tolist():
        if not waiting[root]:
            continue
        front = np.array([root])
        waiting[root] = False
        while len(front):
            members.append(front)
            roots.append(np.full(len(front), root))
            front = np.flatnonzero(links[front].any(0) & waiting)
            waiting[front] = False
    none = np.zeros(0, np.int64)
    return (np.concatenate(members), np.concatenate(roots)) if members else (none, none)


def _meeting(turn: np.ndarray, dtype: type, threshold: float):
    """Of two tiles, or one with itself: for each class with links how many, and the root of its component here."""

    def meet(table: pa.Table) -> pa.Table:
        rows = table.select(["size", "ids", "copies", "vectors"]).to_pylist()
        size = rows[0]["size"]
        ids, copies, vectors, turned = [], [], [], []
        for r in rows:
            ids.append(np.frombuffer(r["ids"], np.int64))
            copies.append(np.frombuffer(r["copies"], np.int64))
            x = np.frombuffer(r["vectors"], dtype).reshape(-1, size)
            vectors.append(_unit([v.tobytes() for v in x], dtype))
            turned.append(vectors[-1] @ turn[:size])
        a, b = 0, len(rows) - 1
        n, split = (len(ids[0]) + len(ids[1]), len(ids[0])) if b else (len(ids[0]), 0)
        links = np.zeros((n, n), bool)
        for lo in range(0, len(ids[a]), BLOCK):
            part = slice(lo, min(lo + BLOCK, len(ids[a])))
            links[part, split:] = linked(vectors[a][part], vectors[b], turned[a][part], turned[b], threshold)
        if b:
            links[split:, :split] = links[:split, split:].T
        else:
            links |= links.T  # rounding is alike either way
            np.fill_diagonal(links, False)
        id_, copy = np.concatenate(ids), np.concatenate(copies)
        member, root = forest(links)
        count = np.array([copy[links[m]].sum() for m in member.tolist()], np.int64)
        return pa.table({"id": id_[member], "root": id_[root], "n": count})

    return meet


def near(rows: DataFrame, threshold: float = THRESHOLD, vector: str = "embedding") -> DataFrame:
    """One row per row of `rows` (vec_id, label, vector): vec_id, n_links, component_id, kept."""
    spark: SparkSession = rows.sparkSession
    kind = rows.schema[vector].dataType
    dtype = np.float64 if isinstance(kind, ArrayType) and isinstance(kind.elementType, DoubleType) else np.float32
    every = keyed(rows, vector)
    alike = every.where("key is not null").groupBy("label", "key").agg(F.count("*").alias("copies"), F.min("vec_id").alias("low"), F.first("size").alias("size"), F.first("vector").alias("vector"))
    classes = written(alike.withColumn("id", F.monotonically_increasing_id()), "classes")
    given = classes.select("label", "size", "id", "copies", "vector")
    turn = axes(given, dtype)
    placed = tiles(given, turn, dtype, threshold)

    one, two = (placed.select("label", "size", F.col("tile").alias(t), F.col("low").alias(f"low_{t}"), F.col("high").alias(f"high_{t}")) for t in ("s", "t"))
    close = _gap("low_s", "high_s", "low_t", "high_t") <= 2 - 2 * threshold + SLACK
    pairs = one.join(two, ["label", "size"]).where((F.col("s") <= F.col("t")) & close).select("s", "t")
    sides = pairs.select("s", "t", F.explode(F.array_distinct(F.array("s", "t"))).alias("tile"))
    meetings = sides.join(placed.select("tile", "size", "ids", "copies", "vectors"), "tile").groupBy("s", "t")
    met = written(meetings.applyInArrow(_meeting(turn, dtype, threshold), "id long, root long, n long"), "met")

    count = met.groupBy("id").agg(F.sum("n").alias("n"))
    joined = components(met, "id", "root")
    low = joined.join(classes.select(F.col("id").alias("node"), "low"), "node").groupBy("component").agg(F.min("low").alias("least"))
    joined = joined.join(low, "component").select(F.col("node").alias("id"), "least")
    told = classes.select("label", "key", "id", "copies", "low").join(count, "id", "left").join(joined, "id", "left")
    told = told.select("label", "key", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("least", "low").alias("component_id"))
    told = written(told, "told")
    for used in (classes, placed, met):
        discard(used)
    out = every.select("vec_id", "label", "key").join(told, ["label", "key"], "left")
    alone = F.col("key").isNull()
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.when(alone, F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


#: DuckDB: all pairs of a label, then the smallest id that links reach.
NEAR_SQL = r"""
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS x, b.vec_id AS y FROM v AS a JOIN v AS b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
r AS (SELECT x, y FROM l UNION SELECT r.x, l.y FROM r JOIN l ON l.x = r.y),
n AS (SELECT x, count(*) AS n FROM l GROUP BY x), c AS (SELECT x, min(y) AS y FROM r GROUP BY x)
SELECT e.vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, least(e.vec_id, coalesce(c.y, e.vec_id)) AS component_id, e.vec_id <= coalesce(c.y, e.vec_id) AS kept
FROM embeddings AS e LEFT JOIN n ON n.x = e.vec_id LEFT JOIN c ON c.x = e.vec_id
"""
