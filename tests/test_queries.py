"""Every query with SQL against DuckDB, on the smallest tables."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pytest

from lorekiln.plans import catalogue

DATA = Path("/root/testdata/sf0.001")


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 5) + 0.0
    return value


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in DATA.glob("*.parquet"):
        con.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, duck, name):
    df = catalogue.QUERIES[name](spark, str(DATA))
    columns = sorted(df.columns)
    rows = [tuple(map(plain, r)) for r in df.select(*columns).collect()]
    if name in catalogue.ORACLE_SQL:
        wanted = duck.sql(catalogue.ORACLE_SQL[name])
        assert sorted(wanted.columns) == columns
        order = [wanted.columns.index(c) for c in columns]
        wanted = [tuple(plain(r[k]) for k in order) for r in wanted.fetchall()]
        assert sorted(rows, key=repr) == sorted(wanted, key=repr)


def test_flagship(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 100
