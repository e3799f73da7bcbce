"""A user's day with more events than a row holds goes through every zone query."""

from __future__ import annotations

import os

import pytest

from sessionlake.plans.catalog import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
duckdb = pytest.importorskip("duckdb")
check = pytest.importorskip("check")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")

NAMES = [
    "bronze_roundtrip", "silver_roundtrip", "gold_roundtrip", "zone_audit", "publish_sessions", "publish_count",
    "load_parquet", "session_keys", "tile_published_weeks", "publish_two_customers", "publish_late_sessions",
    "publish_rerun_fewer_days", "silver_as_is", "has_partition",
]


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    root = tmp_path_factory.mktemp("split")
    duckdb.sql(f"""
        COPY (SELECT * FROM '{SF}/events.parquet' UNION ALL
              SELECT * EXCLUDE (n) REPLACE (10000000 + n AS event_id)
              FROM (SELECT * FROM '{SF}/events.parquet' ORDER BY event_id LIMIT 1), range(45000) r(n))
        TO '{root}/events.parquet' (FORMAT parquet)""")
    return str(root)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, folder, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{folder}/events.parquet')")
    df = QUERIES[name](spark, folder)
    result = con.execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    assert check.rows(df.columns, df.collect()) == check.rows(columns, result.fetchall())
