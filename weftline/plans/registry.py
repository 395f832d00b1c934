"""Where queries register under their names, with SQL for the same result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
oracles: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query under its function's name."""

    def add(f):
        queries[f.__name__] = f
        if sql:
            oracles[f.__name__] = sql
        return f

    return add
