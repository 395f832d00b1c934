"""Every registered query against DuckDB on the same tables."""

import os

import duckdb
import numpy as np
import pytest

from weftline.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents benchmark".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{p}{'/*.parquet' if os.path.isdir(p) else ''}'")
    return c


def _rows(frame):
    def cell(v):
        if v is None or v != v:
            return ""
        return round(float(v), 9) if isinstance(v, (int, float, np.number)) and not isinstance(v, bool) else str(v)

    return sorted(tuple(map(cell, r)) for r in frame[sorted(frame.columns)].itertuples(index=False))


@pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are not here")
@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    got, want = catalog.queries()[name](spark, SF).toPandas(), duck.execute(catalog.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert _rows(got) == _rows(want)
