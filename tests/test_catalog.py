"""Every registered query against its SQL on the smallest test tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from sessionlake.plans import adapt

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
duckdb = pytest.importorskip("duckdb")
check = pytest.importorskip("check")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in check.TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    df = entry.queries()[name](spark, SF)
    got = check.rows(df.columns, df.collect())
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert got
        return
    result = con.execute(sql)
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert got == check.rows(columns, result.fetchall())


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["geo_network_city", "count"]


def test_split_sessions_lose_nothing(spark):
    """Sessions made with a low part size hold the same hits as the tables."""
    raw = adapt.event_sessions(spark, SF)
    assert raw.selectExpr("sum(size(hits))").collect()[0][0] == adapt.table(spark, SF, "events").count()
