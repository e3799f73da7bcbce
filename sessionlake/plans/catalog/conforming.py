"""Casts, dates, strings and the conforming and nesting operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sessionlake.contracts import GOLD, PART, PART_FIELD, RAW, SESSION_KEY, SILVER_TYPES, read_schema, record
from sessionlake.functions.dates import date_group, day_of, epoch_seconds, parse_date, two_digits, ymd
from sessionlake.functions.paths import (
    data_glob,
    parse_upload_path,
    staging_name,
    zone_path_column,
)
from sessionlake.operators.conform import cast_columns, conform, silver
from sessionlake.operators.nested import (
    explode_hits,
    flatten,
    pack,
    rejoin,
    renest,
    unpack,
    unwrap_list,
)
from sessionlake.plans.adapt import bronze, cents, gold, table, with_row_id
from sessionlake.plans.catalog.registry import query

CENTS = "CAST(round(l_extendedprice * 100) AS BIGINT)"


def as_text(df: DataFrame) -> DataFrame:
    """All columns as text, so that NULLs compare the same in every engine."""
    return df.select([F.col(c).cast("string").alias(c) for c in df.columns])


def marker_path() -> Column:
    """An upload's marker path from an order date."""
    return F.concat(
        F.lit("customer01/orders/"), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("/end_file.txt")
    )


@query(
    "silver_cast",
    """
    SELECT CAST(o_orderkey AS VARCHAR) AS "visitId", '1' AS "visitNumber",
           CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS "date", o_orderpriority AS "channelGrouping"
    FROM orders
    """,
)
def silver_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Root columns cast by name and the text date replaced."""
    raw = bronze(spark, sf_dir).filter(F.col(PART) == 0)
    made = silver(raw, SILVER_TYPES)
    return as_text(made.select("visitId", "visitNumber", "date", "channelGrouping"))


@query(
    "scalar_casts",
    """
    SELECT event_id,
           CAST(TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS VARCHAR) AS k_number,
           CAST(TRY_CAST(event_type AS BIGINT) AS VARCHAR) AS type_number,
           CASE json_extract_string(props, '$.k') WHEN '1' THEN 'true' WHEN '0' THEN 'false' END AS k_flag,
           CAST(NULL AS VARCHAR) AS missing
    FROM events
    """,
)
def scalar_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Casts that give NULL for a bad value instead of failing."""
    k = F.get_json_object("props", "$.k").alias("k")
    events = table(spark, sf_dir, "events").select("event_id", "event_type", k)
    made = cast_columns(
        events.select(
            "event_id", F.col("k").alias("k_number"), F.col("event_type").alias("type_number"),
            F.col("k").alias("k_flag"), F.lit(None).cast("string").alias("missing"),
        ),
        {"k_number": "bigint", "type_number": "int", "k_flag": "boolean"},
    )
    return made.select("event_id", *[F.col(c).cast("string").alias(c) for c in made.columns[1:]])


@query(
    "scalar_dates",
    """
    SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS parsed,
           CAST(NULL AS VARCHAR) AS bad, CAST(epoch(o_orderdate) AS BIGINT) AS seconds,
           CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS load_day,
           CAST(CAST(CAST(o_orderdate AS DATE) + INTERVAL 1 DAY AS DATE) AS VARCHAR) AS next_day
    FROM orders
    """,
)
def scalar_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    day_text = F.date_format("o_orderdate", "yyyyMMdd")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        parse_date(day_text).cast("string").alias("parsed"),
        parse_date(F.col("o_orderpriority")).cast("string").alias("bad"),
        epoch_seconds(F.col("o_orderdate")).alias("seconds"),
        day_of(F.col("o_orderdate")).cast("string").alias("load_day"),
        F.date_add(parse_date(day_text), 1).cast("string").alias("next_day"),
    )


@query(
    "date_dimensions",
    """
    SELECT o_orderkey, CAST(d AS VARCHAR) AS date_date,
           CAST(CAST(date_trunc('week', d) AS DATE) AS VARCHAR) AS date_week,
           strftime(d, '%Y-%m') AS date_month, monthname(d) AS date_month_name,
           year(d) || '-Q' || quarter(d) AS date_quarter, year(d) AS date_year
    FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)
    """,
)
def date_dimensions(spark: SparkSession, sf_dir: str) -> DataFrame:
    group = date_group(F.to_date("o_orderdate"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        group["date_date"].cast("string").alias("date_date"),
        group["date_week"].cast("string").alias("date_week"),
        group["date_month"].alias("date_month"),
        group["date_month_name"].alias("date_month_name"),
        group["date_quarter"].alias("date_quarter"),
        group["date_year"].cast("bigint").alias("date_year"),
    )


@query(
    "ymd_partitions",
    """
    SELECT o_orderkey, year(o_orderdate) AS "year", month(o_orderdate) AS "month",
           day(o_orderdate) AS "day", strftime(o_orderdate, '%d') AS day_text
    FROM orders
    """,
)
def ymd_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    date = F.to_date("o_orderdate")
    parts = table(spark, sf_dir, "orders").select("o_orderkey", *ymd(date))
    return parts.select(
        "o_orderkey", *[F.col(c).cast("bigint").alias(c) for c in ("year", "month", "day")],
        two_digits(F.col("day")).alias("day_text"),
    )


@query(
    "scalar_strings",
    """
    SELECT c_custkey, replace(c_name, '#', '_') AS replaced, split_part(c_name, '#', 1) AS head,
           split_part(c_name, '#', 2) AS tail, ends_with(c_name, '7') AS ends_7,
           starts_with(c_name, 'Cust') AS starts_cust, 'seg-' || c_mktsegment AS prefixed,
           lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS padded
    FROM customer
    """,
)
def scalar_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.col("c_name")
    parts = F.split(name, "#")
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.replace(name, F.lit("#"), F.lit("_")).alias("replaced"),
        parts[0].alias("head"),
        F.try_element_at(parts, F.lit(2)).alias("tail"),
        name.endswith("7").alias("ends_7"),
        name.startswith("Cust").alias("starts_cust"),
        F.concat(F.lit("seg-"), "c_mktsegment").alias("prefixed"),
        two_digits(F.col("c_nationkey")).alias("padded"),
    )


@query(
    "upload_path",
    """
    SELECT o_orderkey, 'customer01' AS customer, 'orders' AS entity,
           strftime(o_orderdate, '%Y-%m-%d') AS upload_date, 'end_file.txt' AS file,
           'customer01/orders/' || strftime(o_orderdate, '%Y-%m-%d') || '/*.json' AS glob,
           'lake/bronze/customer01/orders' AS bronze_path, 'lake/gold/customer01/orders' AS gold_path
    FROM orders
    """,
)
def upload_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer, entity and day of a marker path, its data glob and zone folders."""
    paths = table(spark, sf_dir, "orders").select("o_orderkey", marker_path().alias("path"))
    parts = {n: c.cast("string").alias(n) for n, c in parse_upload_path(F.col("path")).items()}
    zone = {
        z: zone_path_column("lake", z, parts["customer"], parts["entity"]).alias(f"{z}_path")
        for z in ("bronze", "gold")
    }
    return paths.select(
        "o_orderkey", *parts.values(), data_glob(F.col("path")).alias("glob"), *zone.values()
    )


@query(
    "staging_name",
    """
    SELECT o_orderkey,
           'customer01_orders_' || replace(strftime(o_orderdate, '%Y-%m-%d'), '-', '_') AS staging
    FROM orders
    """,
)
def staging_name_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return orders.select("o_orderkey", staging_name(marker_path()).alias("staging"))


@query(
    "conform_root",
    """
    SELECT CAST(o_orderkey AS VARCHAR) AS "visitId", CAST(NULL AS VARCHAR) AS "visitNumber",
           CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS "date",
           o_orderpriority AS "channelGrouping", CAST(NULL AS VARCHAR) AS "socialEngagementType"
    FROM orders
    """,
)
def conform_root(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Root fields that the source lacks become typed NULLs."""
    raw = bronze(spark, sf_dir).filter(F.col(PART) == 0)
    made = conform(raw.drop("visitNumber", "socialEngagementType"), GOLD)
    assert made.schema["visitNumber"].dataType.simpleString() == "bigint"
    return as_text(
        made.select("visitId", "visitNumber", "date", "channelGrouping", "socialEngagementType")
    )


@query(
    "conform_struct",
    """
    SELECT CAST(o_orderkey AS VARCHAR) AS visit_id,
           CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS VARCHAR) AS revenue,
           CAST(NULL AS VARCHAR) AS bounces, CAST(NULL AS VARCHAR) AS browser,
           CAST(NULL AS VARCHAR) AS country, o_orderpriority AS source,
           CASE WHEN o_orderstatus = 'O' THEN 'true' ELSE 'false' END AS is_true_direct
    FROM orders
    """,
)
def conform_struct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A struct the source lacks becomes one of NULLs; fields are cast in place."""
    raw = bronze(spark, sf_dir).filter(F.col(PART) == 0)
    made = conform(raw.drop("geoNetwork"), GOLD)
    return as_text(
        made.select(
            F.col("visitId").alias("visit_id"),
            F.col("totals.transactionRevenue").alias("revenue"),
            "totals.bounces", "device.browser", "geoNetwork.country", "trafficSource.source",
            F.col("trafficSource.isTrueDirect").alias("is_true_direct"),
        )
    )


@query(
    "conform_array",
    f"""
    SELECT CAST(o_orderkey AS VARCHAR) AS visit_id, CAST(count(l_orderkey) AS VARCHAR) AS n_hits,
           CAST(coalesce(sum({CENTS}), 0) AS VARCHAR) AS revenue,
           CAST(coalesce(sum(l_partkey), 0) AS VARCHAR) AS "time",
           CAST(count(*) FILTER (l_linestatus = 'F') AS VARCHAR) AS exits,
           CAST(count(*) FILTER (l_quantity > 25) AS VARCHAR) AS interactions
    FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey
    """,
)
def conform_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits and their nested page and transaction cast in place, without a shuffle."""
    needed = StructType([*read_schema(RAW, GOLD).fields, PART_FIELD])
    made = conform(bronze(spark, sf_dir, needed), GOLD).select(
        "visitId",
        F.when(F.col("hits").isNull(), 0).otherwise(F.size("hits")).alias("n"),
        total("hits.transaction.transactionRevenue").alias("revenue"),
        total("hits.time").alias("time"),
        true_count("hits.isExit").alias("exits"),
        true_count("hits.isInteraction").alias("interactions"),
    )
    sums = [F.sum(c).alias(c) for c in ("revenue", "time", "exits", "interactions")]
    per_session = made.groupBy(F.col("visitId").alias("visit_id")).agg(F.sum("n").alias("n_hits"), *sums)
    return as_text(per_session)


def total(leaf: str) -> Column:
    """Sum of a numeric leaf over the items of an array; 0 for a NULL array."""
    zero = F.lit(0).cast("bigint")
    return F.coalesce(F.aggregate(leaf, zero, lambda acc, x: acc + F.coalesce(x, zero)), zero)


def true_count(leaf: str) -> Column:
    """Number of items of an array whose boolean leaf is true; 0 for a NULL array."""
    return F.greatest(F.size(F.filter(leaf, lambda x: x)), F.lit(0)).cast("bigint")


@query(
    "json_contract",
    """
    SELECT event_id, CAST(json_extract_string(props, '$.k') AS VARCHAR) AS k, CAST(NULL AS VARCHAR) AS z
    FROM events
    """,
)
def json_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON in a column, parsed by a schema of which one field is never there."""
    props = F.from_json("props", record(k="long", z="string"))
    events = table(spark, sf_dir, "events").select("event_id", props.alias("p"))
    return events.select("event_id", F.col("p.k").cast("string").alias("k"), F.col("p.z").alias("z"))


@query(
    "struct_pack",
    "SELECT c_custkey, c_name, CAST(round(c_acctbal * 100) AS BIGINT) AS cents FROM customer",
)
def struct_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").withColumn("cents", cents(F.col("c_acctbal")))
    packed = pack(customers.select("c_custkey", "c_name", "cents"), "account", ["c_name", "cents"])
    return packed.select("c_custkey", "account.c_name", "account.cents")


@query(
    "struct_nested",
    f"SELECT l_orderkey, l_linenumber, '/' || l_suppkey AS path, {CENTS} AS revenue FROM lineitem",
)
def struct_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page and transaction structs inside a hit struct."""
    items = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.concat(F.lit("/"), F.col("l_suppkey").cast("string")).alias("path"),
        cents(F.col("l_extendedprice")).alias("revenue"),
    )
    packed = pack(pack(items, "page", ["path"]), "transaction", ["revenue"])
    hit = pack(packed, "hit", ["page", "transaction"])
    return hit.select("l_orderkey", "l_linenumber", "hit.page.path", "hit.transaction.revenue")


@query("struct_unpack", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def struct_unpack(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return unpack(pack(customers, "s", ["c_name", "c_mktsegment"]), "s")


@query(
    "flatten_nested",
    f"""
    SELECT CAST(o_orderkey AS VARCHAR) AS "body_visitId", n_name AS "body_geoNetwork_country",
           CAST(l_linenumber AS VARCHAR) AS "body_hits_hitNumber",
           '/' || l_suppkey AS "body_hits_page_pagePath",
           CAST({CENTS} AS VARCHAR) AS "body_hits_transaction_transactionRevenue"
    FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey
    LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
    """,
)
def flatten_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One flat row per hit with prefixed column names; sessions without hits have one."""
    leaves = ["hitNumber", "page.pagePath", "transaction.transactionRevenue"]
    hits = explode_hits(bronze(spark, sf_dir), fields=leaves)
    flat = flatten(hits, prefix="body_")
    return flat.select(
        "body_visitId", "body_geoNetwork_country", "body_hits_hitNumber",
        "body_hits_page_pagePath", "body_hits_transaction_transactionRevenue",
    )


@query(
    "unwrap_list",
    f"""
    SELECT o_orderkey AS visit_id, count(l_orderkey) AS n_hits, CAST(coalesce(sum({CENTS}), 0) AS BIGINT) AS revenue
    FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1
    """,
)
def unwrap_list_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits in the ``list[].element`` layout of other writers."""
    sessions = gold(spark, sf_dir)
    wrapped = F.struct(F.transform("hits", lambda h: F.struct(h.alias("element"))).alias("list"))
    plain = sessions.select("visitId", wrapped.alias("hits")).select(
        "visitId", unwrap_list(F.col("hits")).alias("hits")
    )
    return plain.groupBy(F.col("visitId").alias("visit_id")).agg(
        F.coalesce(F.sum(F.when(F.col("hits").isNotNull(), F.size("hits"))), F.lit(0)).cast("bigint").alias("n_hits"),
        F.coalesce(F.sum(total("hits.transaction.transactionRevenue")), F.lit(0)).cast("bigint").alias("revenue"),
    )


def in_order(column: str) -> Column:
    """True if the hits of an array are sorted by hit number."""
    numbers = F.col(f"{column}.hitNumber")
    return numbers == F.sort_array(numbers)


RENESTED = f"""
    SELECT CAST(l_orderkey AS VARCHAR) AS visit_id, count(*) AS n_hits,
           CAST(sum({CENTS}) AS BIGINT) AS revenue, min(l_linenumber) AS first_hit,
           max(l_linenumber) AS last_hit, TRUE AS in_order
    FROM lineitem GROUP BY 1
"""


def per_session(nested: DataFrame) -> DataFrame:
    """Facts about the hits of each session, over all its parts."""
    return nested.groupBy(F.col("visitId").cast("string").alias("visit_id")).agg(
        F.sum(F.size("hits")).cast("bigint").alias("n_hits"),
        F.sum(total("hits.transaction.transactionRevenue")).alias("revenue"),
        F.min(F.col("hits")[0]["hitNumber"]).cast("int").alias("first_hit"),
        F.max(F.element_at("hits", -1)["hitNumber"]).cast("int").alias("last_hit"),
        F.bool_and(in_order("hits")).alias("in_order"),
    )


@query("renest_hits", RENESTED)
def renest_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Explode the hits of the gold zone and group them back into sorted arrays."""
    hits = with_row_id(gold(spark, sf_dir)).select(
        "visitId", "_row", F.posexplode("hits").alias("_pos", "hit")
    )
    nested = renest(
        hits, ["visitId"], F.col("hit"), "hits",
        order_by=F.col("hit.hitNumber"), spread_by=["_row", "_pos"],
    )
    return per_session(nested)


@query("renest_rejoin", RENESTED.replace("FROM lineitem", "FROM orders JOIN lineitem ON o_orderkey = l_orderkey"))
def renest_rejoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Re-nested hits joined back to their sessions; sessions without hits drop out."""
    sessions = with_row_id(gold(spark, sf_dir).select(*SESSION_KEY, "date", "totals", "hits"))
    return per_session(rejoin(sessions, spread_by=["_row"]))


UNNESTED = """
    SELECT o_orderkey AS visit_id, coalesce(CAST(l_linenumber AS VARCHAR), 'none') AS hit_number,
           l_returnflag AS type
    FROM orders {join} lineitem ON o_orderkey = l_orderkey
"""


def unnested(spark: SparkSession, sf_dir: str, outer: bool) -> DataFrame:
    sessions = gold(spark, sf_dir).select("visitId", "hits")
    rows = explode_hits(sessions, outer=outer, fields=["hitNumber", "type"])
    number = F.coalesce(F.col("hits.hitNumber").cast("string"), F.lit("none"))
    return rows.select(F.col("visitId").alias("visit_id"), number.alias("hit_number"), "hits.type")


@query("unnest_cross", UNNESTED.format(join="JOIN"))
def unnest_cross(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unnested(spark, sf_dir, outer=False)


@query("unnest_left", UNNESTED.format(join="LEFT JOIN"))
def unnest_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unnested(spark, sf_dir, outer=True)
