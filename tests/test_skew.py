"""A third of all line items belong to one order, most of them exact copies."""

from __future__ import annotations

import os

import duckdb
import pytest
from pyspark.sql import functions as F

from sessionlake.contracts import GOLD, PART
from sessionlake.operators.conform import conform
from sessionlake.plans import adapt
from sessionlake.plans.catalog.conforming import total
from sessionlake.plans.semantic import count, explore, total_sessions

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("skewed")
    for t in ("orders", "customer", "nation", "region"):
        (root / f"{t}.parquet").symlink_to(f"{SF}/{t}.parquet")
    items = f"read_parquet('{SF}/lineitem.parquet')"
    duckdb.sql(f"""
        COPY (SELECT * FROM {items}
              UNION ALL
              SELECT i.* FROM (SELECT * FROM {items} WHERE l_orderkey = (SELECT min(l_orderkey) FROM {items})
                               ORDER BY ALL LIMIT 1) i, range(3000))
        TO '{root}/lineitem.parquet' (FORMAT parquet)""")
    return str(root)


@pytest.fixture(scope="module")
def gold(spark, skewed):
    raw = adapt.order_sessions(spark, skewed, part_items=1000)
    return conform(raw, GOLD, keep=[PART]).cache()


def sql(skewed, text):
    con = duckdb.connect()
    for t in ("orders", "customer", "nation", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{skewed}/{t}.parquet')")
    return con.execute(text).fetchall()


def ordered(rows):
    return sorted(map(tuple, rows), key=repr)


def test_the_hot_session_has_several_rows_and_no_row_is_big(gold):
    sizes = gold.filter(F.col("hits").isNotNull()).select("visitId", PART, F.size("hits").alias("n")).collect()
    hot = [r for r in sizes if sum(s.visitId == r.visitId for s in sizes) > 1]
    assert len({r.visitId for r in hot}) == 1 and len(hot) == 4
    assert max(r.n for r in sizes) < 1200 and sum(r.n for r in hot) > 3000


def test_totals_hold_all_hits(gold, skewed):
    got = gold.groupBy("visitId").agg(
        F.max("totals.hits").alias("n"), F.sum(total("hits.transaction.transactionRevenue")).alias("r")
    )
    want = sql(skewed, """
        SELECT o_orderkey, count(l_orderkey),
               CAST(coalesce(sum(CAST(round(l_extendedprice * 100) AS BIGINT)), 0) AS BIGINT)
        FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1""")
    assert ordered(got.collect()) == ordered(want)


def test_session_measures_count_the_hot_session_once(gold, skewed):
    want = sql(skewed, """
        SELECT n_name, count(*) FROM orders LEFT JOIN customer ON o_custkey = c_custkey
        LEFT JOIN nation ON c_nationkey = n_nationkey GROUP BY 1""")
    assert ordered(count(gold, ["geo_network.country"]).collect()) == ordered(want)
    assert ordered(total_sessions(gold, ["geo_network.country"]).collect()) == ordered(want)


def test_hit_measures_see_every_part(gold, skewed):
    rows = explore(gold, ["sessions.visit_id", "hits.type"])
    got = rows.groupBy("hits_type").agg(F.count(F.lit(1)))
    want = sql(skewed, """
        SELECT l_returnflag, count(*) FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1""")
    assert ordered(got.collect()) == ordered(want)
    visits = sql(skewed, """
        SELECT l_returnflag, count(DISTINCT o_orderkey) FROM orders LEFT JOIN lineitem
        ON o_orderkey = l_orderkey GROUP BY 1""")
    assert ordered(total_sessions(gold, ["hits.type"]).collect()) == ordered(visits)
