"""Helpers shared by the training-data operators: input tables, shared storage, size-checked broadcast."""

from __future__ import annotations

import atexit
import ctypes
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.lineage import shuffles_dropped

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rows of a few machine words up to which a table is sent to every executor; larger ones are shuffled.
BROADCAST_ROWS = 400_000
_own: list[str] = []
#: Tables of written() that are still there.
_tables: list[str] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: the session's spark.checkpoint.dir; in one process, one of our own if that is unset."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not _own:
        _own.append(tempfile.mkdtemp(prefix="weftline-"))
        atexit.register(shutil.rmtree, _own[0], ignore_errors=True)
    return _own[0]


def written(df: DataFrame, label: str) -> DataFrame:
    """df as a table in the shared folder: its lineage is cut, lost executors cost nothing of it, and what was shuffled for it is deleted."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    with shuffles_dropped(spark):
        df.write.parquet(path)
    _tables.append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._weft_path = path
    return out


def delete(spark: SparkSession, path: str) -> None:
    """Deletes a folder wherever Spark reads it from."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    if path in _tables:
        _tables.remove(path)


def discard(df: DataFrame) -> None:
    """Deletes a table made by written() that nothing reads any more."""
    path = getattr(df, "_weft_path", None)
    if path:
        delete(df.sparkSession, path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Deletes at its end the tables that written() makes in it; what is to stay must be stored before."""
    before = set(_tables)
    try:
        yield
    finally:
        for path in [t for t in _tables if t not in before]:
            delete(spark, path)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """df, marked for broadcast if it has been counted to have few rows; call it on narrow, materialised tables."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def let(value: Column, body) -> Column:
    """body(value), with value evaluated once however often body uses it."""
    return F.transform(F.array(value), body)[0]


def give_back() -> None:
    """Hands memory that Python and Arrow have freed back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's, which else keeps it
    if trim:
        trim(0)


def lean(run: Callable) -> Callable:
    """run, for mapInArrow, with what its task has freed handed back at its end: a worker that waits for its next task, often through
    stages without Python, shares the executor's memory with the JVM."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return whole


def lean_group(run: Callable) -> Callable:
    """The same for a function of applyInPandas, after each group."""

    def whole(rows):
        try:
            return run(rows)
        finally:
            give_back()

    return whole


ARROW = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(), "string": pa.string(), "binary": pa.binary()}


def map_rows(df: DataFrame, given: str | list[str], start: Callable, schema: str, rows: int = 1000) -> DataFrame:
    """df's other columns beside those of `schema` (name type, ...) that Python makes of the given one or ones.

    start() is called once in a task and returns make(*columns), which gets the given columns of up to `rows` rows as lists
    and returns the new columns by name; with a key None it also says which row each new row is of, else there is one for
    each.  The other columns stay Arrow arrays, so that longs beside nulls keep all their digits.
    """
    given = [given] if isinstance(given, str) else given
    kept = [f for f in df.schema.fields if f.name not in given]
    new = [tuple(c.split()) for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = start()
        for batch in batches:
            for lo in range(0, batch.num_rows, rows):
                part = batch.slice(lo, rows)
                made = make(*(part.column(g).to_pylist() for g in given))
                at = made.get(None)
                old = [part.column(f.name) if at is None else part.column(f.name).take(pa.array(at, pa.int64())) for f in kept]
                yield pa.RecordBatch.from_arrays([*old, *(pa.array(made[n], ARROW[t]) for n, t in new)], [*(f.name for f in kept), *(n for n, _ in new)])

    fields = [*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), *(f"`{n}` {t}" for n, t in new)]
    return df.mapInArrow(lean(run), ", ".join(fields))
