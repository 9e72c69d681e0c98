"""Every registered query runs on the smallest tables; those with SQL give what DuckDB gives."""

from __future__ import annotations

import math

import duckdb
import numpy as np
import pytest

from tidemill.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("set TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def plain(value):
    """A form in which both engines' values compare."""
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "null"
    if isinstance(value, (float, np.floating)):
        return f"{float(value):.6g}"
    if isinstance(value, (list, np.ndarray)):
        return str([plain(v) for v in value])
    if isinstance(value, (bool, np.bool_)):
        return str(bool(value))
    if isinstance(value, np.integer):
        return str(int(value))
    return str(value)


def rows_of(frame):
    frame = frame[sorted(frame.columns)].astype(object)
    frame = frame.where(frame.notna(), None)
    return sorted(tuple(map(plain, r)) for r in frame.itertuples(index=False))


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, duck, name):
    got = registry.queries()[name](spark, SF).toPandas()
    sql = registry.oracle_sql().get(name)
    if sql is None:
        assert len(got.columns) and len(got) >= 0
        return
    want = duck.execute(sql).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows_of(got) == rows_of(want)


def test_names_are_unique_and_sql_has_queries():
    assert set(registry.oracle_sql()) <= set(registry.queries())


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
