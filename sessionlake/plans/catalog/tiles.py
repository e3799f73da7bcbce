"""Dashboard tiles and semantic-layer queries over the gold zone."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionlake.plans import dashboard
from sessionlake.plans.adapt import gold
from sessionlake.plans.catalog.registry import query
from sessionlake.plans.semantic import VIEWS, Tile, explore, is_hit_level, label, total_sessions

# One row per session, as the sessions are made from the tables.
SESSIONS = """
    SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS d, o_orderpriority,
           o_orderstatus, o_totalprice, c_mktsegment, n_name
    FROM orders
    LEFT JOIN customer ON o_custkey = c_custkey
    LEFT JOIN nation ON c_nationkey = n_nationkey
"""

CITIES = f"""
    SELECT c_mktsegment AS geo_network_city, count(*) AS "count"
    FROM ({SESSIONS}) WHERE n_name = 'NATION_1' AND month(d) = 3
    GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10
"""

COUNTRIES = f"""
    SELECT n_name AS geo_network_country, count(*) AS "count"
    FROM ({SESSIONS}) WHERE n_name IS DISTINCT FROM 'NATION_1' AND month(d) = 6
    GROUP BY 1 ORDER BY 2 DESC, 1 NULLS LAST LIMIT 10
"""

REFERRERS = f"""
    SELECT o_orderpriority AS traffic_source_source, count(*) AS "count"
    FROM ({SESSIONS}) WHERE year(d) = 1997
    GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5
"""


@query("tile_top_cities", CITIES)
def tile_top_cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.top_cities("NATION_1", "March").rows(gold(spark, sf_dir))


@query("tile_top_countries", COUNTRIES)
def tile_top_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.top_countries("NATION_1", "June").rows(gold(spark, sf_dir))


@query("tile_top_referrers", REFERRERS)
def tile_top_referrers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.top_referrers(1997).rows(gold(spark, sf_dir))


@query(
    "tile_referrer_share",
    f'SELECT *, round("count" / sum("count") OVER (), 6) AS share FROM ({REFERRERS})',
)
def tile_referrer_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = dashboard.top_referrers(1997).report(gold(spark, sf_dir))
    return report.select("traffic_source_source", "count", "share")


@query(
    "tile_page_hits",
    """
    SELECT TRUE AS hits_is_entrance, l_returnflag AS hits_type,
           count(DISTINCT o_custkey) AS "count"
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey
    WHERE l_linenumber = 1 AND year(o_orderdate) = 1997
    GROUP BY l_returnflag ORDER BY 3 DESC, 2 LIMIT 500
    """,
)
def tile_page_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.page_hits(1997).rows(gold(spark, sf_dir))


@query(
    "tile_threshold_flag",
    f'SELECT *, "count" > 60 AS highlight FROM ({COUNTRIES})',
)
def tile_threshold_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    tile = dashboard.top_countries("NATION_1", "June")
    report = tile.report(gold(spark, sf_dir), highlight=60)
    return report.select("geo_network_country", "count", "highlight")


@query(
    "tile_row_numbers",
    f"""
    SELECT *, row_number() OVER (ORDER BY "count" DESC, geo_network_city) AS row_number
    FROM ({CITIES})
    """,
)
def tile_row_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = dashboard.top_cities("NATION_1", "March").report(gold(spark, sf_dir))
    return report.select("geo_network_city", "count", F.col("row_number").cast("bigint"))


@query(
    "tile_grand_total",
    f"""
    SELECT *, CAST(sum(total_sessions) OVER () AS BIGINT) AS total FROM (
        SELECT n_name AS geo_network_country, count(*) AS total_sessions
        FROM ({SESSIONS}) WHERE n_name IS DISTINCT FROM 'NATION_1' AND month(d) = 6
        GROUP BY 1 ORDER BY 2 DESC, 1 NULLS LAST LIMIT 10)
    """,
)
def tile_grand_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    tile = replace(dashboard.top_countries("NATION_1", "June"), measure="total_sessions")
    return tile.report(gold(spark, sf_dir)).select("geo_network_country", "total_sessions", "total")


@query(
    "measure_total_sessions",
    f"""
    SELECT n_name AS geo_network_country, l_returnflag AS hits_type,
           count(DISTINCT o_orderkey) AS total_sessions
    FROM ({SESSIONS}) LEFT JOIN lineitem ON o_orderkey = l_orderkey
    GROUP BY 1, 2
    """,
)
def measure_total_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return total_sessions(gold(spark, sf_dir), ["geo_network.country", "hits.type"])


@query(
    "tile_pruned_year",
    f"""
    SELECT monthname(d) AS date_month_name, count(*) AS "count"
    FROM ({SESSIONS}) WHERE year(d) = 1998 AND month(d) = 2 GROUP BY 1
    """,
)
def tile_pruned_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Year and month filters on the partition columns: one partition is read."""
    tile = Tile(
        by=["date.month_name"], limit=12, filters={"date.year": 1998, "date.month_name": "February"}
    )
    return tile.rows(gold(spark, sf_dir))


@query(
    "explore_structs",
    f"""
    SELECT o_orderkey AS sessions_visit_id, CAST(o_custkey AS VARCHAR) AS sessions_full_visitor_id,
           o_orderpriority AS sessions_channel_grouping, c_mktsegment AS geo_network_city,
           n_name AS geo_network_country, c_mktsegment AS device_device_category,
           c_mktsegment = 'MACHINERY' AS device_is_mobile,
           o_orderstatus = 'O' AS traffic_source_is_true_direct,
           CAST(round(o_totalprice * 100) AS BIGINT) AS totals_transaction_revenue,
           coalesce(n, 0) AS totals_hits
    FROM ({SESSIONS})
    LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey
    """,
)
def explore_structs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore(
        gold(spark, sf_dir),
        [
            "sessions.visit_id", "sessions.full_visitor_id", "sessions.channel_grouping",
            "geo_network.city", "geo_network.country", "device.device_category",
            "device.is_mobile", "traffic_source.is_true_direct",
            "totals.transaction_revenue", "totals.hits",
        ],
    )


@query(
    "explore_hits",
    f"""
    SELECT o_orderkey AS sessions_visit_id, n_name AS geo_network_country,
           coalesce(CAST(l_linenumber AS VARCHAR), 'none') AS hit_number, l_returnflag AS hits_type,
           '/' || l_suppkey AS hits_page_page_path, 'Item ' || l_partkey AS hits_page_page_title,
           o_orderkey || '-' || l_linenumber AS hits_transaction_transaction_id,
           coalesce(CAST(round(l_extendedprice * 100) AS BIGINT), -1) AS revenue
    FROM ({SESSIONS}) LEFT JOIN lineitem ON o_orderkey = l_orderkey
    """,
)
def explore_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits joined to page and transaction; sessions without hits stay."""
    rows = explore(
        gold(spark, sf_dir),
        [
            "sessions.visit_id", "geo_network.country", "hits.hit_number", "hits.type",
            "hits_page.page_path", "hits_page.page_title", "hits_transaction.transaction_id",
            "hits_transaction.transaction_revenue",
        ],
    )
    number = F.coalesce(F.col("hits_hit_number").cast("string"), F.lit("none"))
    revenue = F.coalesce("hits_transaction_transaction_revenue", F.lit(-1))
    return rows.select(
        "sessions_visit_id", "geo_network_country", number.alias("hit_number"), "hits_type",
        "hits_page_page_path", "hits_page_page_title", "hits_transaction_transaction_id",
        revenue.alias("revenue"),
    )


# What fills a dimension in the tables; the others stay empty.
FILLED = {
    "sessions_visit_id": "o_orderkey",
    "sessions_visit_number": "o_orderkey",
    "sessions_visit_start_time": "o_orderdate",
    "sessions_channel_grouping": "o_orderpriority",
    "sessions_full_visitor_id": "o_custkey",
    "sessions_social_engagement_type": "o_orderkey",
    "totals_hits": "o_orderkey",
    "totals_transaction_revenue": "o_totalprice",
    "totals_transactions": "o_orderstatus",
    "totals_visits": "o_orderkey",
    "traffic_source_is_true_direct": "o_orderstatus",
    "traffic_source_source": "o_orderpriority",
    "device_device_category": "c_mktsegment",
    "device_is_mobile": "c_mktsegment",
    "geo_network_city": "c_mktsegment",
    "geo_network_country": "n_name",
    "hits_type": "l_returnflag",
    "hits_time": "l_partkey",
    "hits_hit_number": "l_linenumber",
    "hits_is_entrance": "l_linenumber",
    "hits_is_exit": "l_linestatus",
    "hits_is_interaction": "l_quantity",
    "hits_page_hostname": "l_orderkey",
    "hits_page_page_path": "l_suppkey",
    "hits_page_page_title": "l_partkey",
    "hits_transaction_currency_code": "l_orderkey",
    "hits_transaction_transaction_id": "l_linenumber",
    "hits_transaction_transaction_revenue": "l_extendedprice",
    "hits_transaction_transaction_tax": "l_tax",
}


def dimensions(of_hits: bool) -> list[str]:
    """All dimensions of the session views or of the hit views, but for the date group."""
    refs = [f"{view}.{name}" for view, names in VIEWS.items() for name in names]
    return [r for r in refs if is_hit_level(r) == of_hits and r != "sessions.date"]


def fill_sql(refs: list[str], source: str) -> str:
    rows = [
        f"SELECT '{label(r)}' AS dimension, count({FILLED.get(label(r), 'NULL')}) AS filled FROM ({source})"
        for r in refs
    ]
    return " UNION ALL ".join(rows)


@query(
    "dimension_fill",
    fill_sql(dimensions(False), SESSIONS.replace("SELECT", "SELECT o_orderdate,", 1))
    + " UNION ALL "
    + fill_sql(dimensions(True), "SELECT * FROM orders JOIN lineitem ON o_orderkey = l_orderkey"),
)
def dimension_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many sessions or hits have a value, for every dimension of the eight views."""
    filled = []
    for refs in (dimensions(False), dimensions(True)):
        names = [label(r) for r in refs]
        counts = explore(gold(spark, sf_dir), refs).agg(*[F.count(n).alias(n) for n in names])
        filled.append(counts.unpivot([], names, "dimension", "filled"))
    return filled[0].union(filled[1])


@query(
    "explore_dates",
    f"""
    SELECT CAST(CAST(date_trunc('week', d) AS DATE) AS VARCHAR) AS date_week,
           strftime(d, '%Y-%m') AS date_month, monthname(d) AS date_month_name,
           year(d) || '-Q' || quarter(d) AS date_quarter, count(*) AS n_sessions
    FROM ({SESSIONS}) GROUP BY ALL
    """,
)
def explore_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions by the timeframes of the date group."""
    frames = ["date.week", "date.month", "date.month_name", "date.quarter"]
    rows = explore(gold(spark, sf_dir), frames)
    week = F.col("date_week").cast("string").alias("date_week")
    return rows.groupBy(week, *[label(r) for r in frames[1:]]).agg(F.count(F.lit(1)).alias("n_sessions"))
