from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from sessionlake.contracts import GOLD, PART
from sessionlake.plans import dashboard
from sessionlake.plans.semantic import (
    VIEWS, Not, Tile, count, dimension, explore, flag_above, predicate, snake, total_sessions,
)


def session(i, visitor, date="2017-06-01", country="United States", city="A", source="s", visits=1, hits=(), part=0):
    return {
        "visitId": i, "visitNumber": 1, "visitStartTime": i, "fullVisitorId": visitor,
        "date": dt.date.fromisoformat(date),
        "totals": {"visits": visits, "hits": len(hits)},
        "trafficSource": {"source": source},
        "geoNetwork": {"city": city, "country": country},
        "hits": [{"type": t, "isEntrance": e, "hitNumber": n} for n, (t, e) in enumerate(hits, 1)] or None,
        PART: part,
    }


@pytest.fixture
def sessions(spark):
    rows = [
        session(1, "u1", hits=[("PAGE", True), ("EVENT", False), ("PAGE", True)]),
        session(2, "u1", city="B", source="t", hits=[("PAGE", True)]),
        session(3, "u2", city="B", country=None, source="t", visits=2),
        session(4, "u3", date="2017-07-01", city="B", country="Turkey", hits=[("PAGE", True)]),
        session(5, "u3", date="2016-06-30", country="Turkey", source="t", hits=[("EVENT", True)]),
        session(5, "u3", date="2016-06-30", country="Turkey", source="t", hits=[("PAGE", False)], part=1),
    ]
    return spark.createDataFrame(rows, GOLD.simpleString().removeprefix("struct<").removesuffix(">") + ", part int")


def values(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_views_follow_the_contract():
    assert set(VIEWS) == {
        "sessions", "totals", "traffic_source", "device", "geo_network", "hits", "hits_page", "hits_transaction",
    }
    # 43 named dimensions and the date, which is a group of timeframes
    assert sum(map(len, VIEWS.values())) == 44
    assert VIEWS["hits_transaction"]["transaction_id"] == "hits.transaction.transactionId"
    assert snake("isTrueDirect") == "is_true_direct"


def test_unknown_dimension():
    with pytest.raises(KeyError):
        dimension("geo_network.planet")


def test_session_grain_ignores_further_parts(sessions):
    assert sorted(r.sessions_visit_id for r in explore(sessions, ["sessions.visit_id"]).collect()) == [1, 2, 3, 4, 5]


def test_hit_grain_keeps_sessions_without_hits(sessions):
    rows = values(explore(sessions, ["sessions.visit_id", "hits.type"]))
    assert (3, None) in rows and len(rows) == 8


def test_count_is_distinct_visitors_once_hits_fan_out(sessions):
    assert values(count(sessions, ["geo_network.city"])) == [("A", 2), ("B", 3)]
    assert values(count(sessions, ["hits.type"])) == [("EVENT", 2), ("PAGE", 2), (None, 1)]


def test_approximate_visitors(sessions):
    assert values(count(sessions, ["hits.type"], approximate=True)) == values(count(sessions, ["hits.type"]))


def test_sum_is_not_inflated_by_hits(sessions):
    assert values(total_sessions(sessions, ["geo_network.city"])) == [("A", 2), ("B", 4)]
    assert values(total_sessions(sessions, ["hits.type"])) == [("EVENT", 2), ("PAGE", 4), (None, 2)]


def test_copies_and_sessions_without_key_count_alike_at_any_grain(spark):
    rows = [session(i, None if i > 2 else "u", hits=[("PAGE", True), ("PAGE", False)]) for i in (1, 1, 2, 3, 4)]
    df = spark.createDataFrame(rows, GOLD.simpleString().removeprefix("struct<").removesuffix(">") + ", part int")
    assert values(total_sessions(df, ["date.year"])) == [(2017, 5)]
    assert values(total_sessions(df, ["hits.type"])) == [("PAGE", 5)]
    plan = total_sessions(df, ["hits.type"])._jdf.queryExecution().executedPlan().toString()
    assert "visitStartTime" not in "".join(x for x in plan.splitlines() if "Exchange" in x)


def test_hit_filters_work_inside_the_array(sessions):
    assert values(total_sessions(sessions, ["geo_network.city"], {"hits.type": "PAGE"})) == [("A", 2), ("B", 2)]
    assert values(total_sessions(sessions, ["geo_network.city"], {"hits.type": Not("PAGE")})) == [("A", 2), ("B", 2)]
    assert values(count(sessions, ["hits.type"], {"hits.is_entrance": False})) == [("EVENT", 1), ("PAGE", 1)]


def test_not_equal_keeps_null_unless_told(sessions):
    tile = dashboard.top_countries()
    assert values(tile.rows(sessions)) == [("Turkey", 1), (None, 1)]
    strict = sessions.filter(predicate("geo_network.country", Not("United States", keep_null=False), []))
    assert strict.filter("geoNetwork.country IS NULL").isEmpty()
    tile = Tile(by=["geo_network.country"], limit=9, filters={"geo_network.country": Not("United States", keep_null=False)})
    assert values(tile.rows(sessions)) == [("Turkey", 2)]
    # a minus is part of the value
    assert values(count(sessions, ["geo_network.city"], {"geo_network.country": "-United States"})) == []


def test_top_cities_and_referrers(sessions):
    assert [tuple(r) for r in dashboard.top_cities().rows(sessions).collect()] == [("A", 1), ("B", 1)]
    assert [tuple(r) for r in dashboard.top_referrers().rows(sessions).collect()] == [("s", 2), ("t", 2)]


def test_page_hits(sessions):
    rows = dashboard.page_hits().rows(sessions).collect()
    assert [tuple(r) for r in rows] == [(True, "PAGE", 2)]


def test_report(sessions):
    rows = Tile(by=["geo_network.city"], limit=1).report(sessions, highlight=2).collect()
    assert [r.asDict() for r in rows] == [
        {"geo_network_city": "B", "count": 3, "row_number": 1, "total": 3, "share": 1.0, "highlight": True}
    ]


def test_flag_above(spark):
    df = spark.sql("SELECT explode(array(1, 3, NULL)) AS n")
    assert [r.f for r in df.select(flag_above(F.col("n"), 2).alias("f")).collect()] == [False, True, False]


def test_filters_reach_the_partitions(spark, sessions, tmp_path):
    path = str(tmp_path / "gold")
    dated = sessions.select("*", F.year("date").alias("year"), F.month("date").alias("month"))
    dated.write.partitionBy("year", "month").parquet(path)
    zone = spark.read.parquet(path)
    tile = Tile(
        by=["geo_network.city"], limit=5,
        filters={"date.year": 2017, "date.month_name": "June", "geo_network.country": "United States"},
    )
    df = tile.rows(zone)
    assert values(df) == [("A", 1), ("B", 1)]
    plan = df._jdf.queryExecution().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "year" in scan.split("PartitionFilters")[1] and "month" in scan.split("PartitionFilters")[1]
    assert "hits" not in scan.split("ReadSchema")[1]
    assert "geoNetwork.country" in scan.split("PushedFilters")[1]


def test_only_the_used_hit_fields_are_read(spark, sessions, tmp_path):
    path = str(tmp_path / "gold")
    sessions.write.parquet(path)
    df = dashboard.page_hits().rows(spark.read.parquet(path))
    plan = df._jdf.queryExecution().toString()
    schema = next(line for line in plan.splitlines() if "FileScan" in line).split("ReadSchema")[1]
    assert "isEntrance" in schema and "transaction" not in schema and "page" not in schema
