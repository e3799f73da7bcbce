"""Readers and writers: NDJSON, gzip, CSV, Parquet partitions, shards, text."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionlake.contracts import RAW
from sessionlake.functions.dates import with_ymd
from sessionlake.operators.audit import peek
from sessionlake.operators.text import word_count
from sessionlake.plans.adapt import bronze, event_sessions, table
from sessionlake.plans.catalog.registry import query
from sessionlake.sources.files import (
    CORRUPT,
    export_ndjson,
    read_csv,
    read_sessions,
    read_shards,
    read_text,
    union_shards,
    write_csv,
)
from sessionlake.sources.zones import read_zone, write_zone
from sessionlake.workspace import scratch


@query(
    "scan_ndjson",
    """
    SELECT o_orderkey AS visit_id, strftime(o_orderdate, '%Y%m%d') AS date_text,
           n_name AS country, coalesce(n, 0) AS n_hits, 0 AS corrupt
    FROM orders
    LEFT JOIN customer ON o_custkey = c_custkey
    LEFT JOIN nation ON c_nationkey = n_nationkey
    LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey
    """,
)
def scan_ndjson(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw sessions as compressed NDJSON, read back with the declared schema."""
    path = scratch(spark, "ndjson")
    export_ndjson(bronze(spark, sf_dir).select(*RAW.fieldNames()), path, gzip=True)
    hits = F.when(F.col("hits").isNull(), 0).otherwise(F.size("hits"))
    return (
        read_sessions(spark, path)
        .groupBy(
            F.col("visitId").cast("bigint").alias("visit_id"),
            F.col("date").alias("date_text"),
            F.col("geoNetwork.country").alias("country"),
        )
        .agg(
            F.sum(hits).alias("n_hits"),
            F.count_if(F.col(CORRUPT).isNotNull()).cast("int").alias("corrupt"),
        )
    )


@query(
    "scan_gzip_json",
    "SELECT event_id, user_id, event_type, CAST(round(value * 100) AS BIGINT) AS cents, props FROM events",
)
def scan_gzip_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "gzip")
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value", "props")
    export_ndjson(events, path, gzip=True)
    back = read_sessions(spark, path, events.schema, pattern="*.json.gz")
    return back.select(
        "event_id", "user_id", "event_type",
        F.round(F.col("value") * 100).cast("bigint").alias("cents"), "props",
    )


@query("export_ndjson", "SELECT c_mktsegment AS segment, count(*) AS n FROM customer GROUP BY 1")
def export_ndjson_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "export")
    customers = table(spark, sf_dir, "customer")
    export_ndjson(customers, path)
    back = read_sessions(spark, path, customers.schema)
    return back.groupBy(F.col("c_mktsegment").alias("segment")).agg(F.count(F.lit(1)).alias("n"))


@query("scan_csv", "SELECT c_custkey AS customer_id, c_name AS customer_name FROM customer")
def scan_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "csv")
    customers = table(spark, sf_dir, "customer")
    write_csv(
        customers.select(F.col("c_custkey").alias("CustomerId"), F.col("c_name").alias("CustomerName")),
        path,
    )
    back = read_csv(spark, path, "CustomerId bigint, CustomerName string")
    return back.select(
        F.col("CustomerId").alias("customer_id"), F.col("CustomerName").alias("customer_name")
    )


@query(
    "scan_partition",
    """
    SELECT event_id, user_id, year(ts) AS "year", month(ts) AS "month", day(ts) AS "day"
    FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-20'
    """,
)
def scan_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events by year, month and day; only the partitions of the asked days are read."""
    path = scratch(spark, "days")
    events = with_ymd(table(spark, sf_dir, "events"), F.to_date("ts"))
    write_zone(events, path)
    back = read_zone(spark, path, dt.date(2024, 1, 10), dt.date(2024, 1, 20))
    return back.select(
        "event_id", "user_id", *[F.col(c).cast("bigint").alias(c) for c in ("year", "month", "day")]
    )


@query(
    "shard_range",
    """
    SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, count(*) AS n_events,
           count(DISTINCT user_id) AS n_users
    FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-25' GROUP BY 1
    """,
)
def shard_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily shards read as one range of days."""
    path = scratch(spark, "shards")
    shards = table(spark, sf_dir, "events").withColumn("shard_date", F.to_date("ts"))
    write_zone(shards, path, by=["shard_date"])
    days = read_shards(spark, path, dt.date(2024, 1, 5), dt.date(2024, 1, 25))
    return days.groupBy(F.col("shard_date").cast("string").alias("day")).agg(
        F.count(F.lit(1)).alias("n_events"), F.count_distinct("user_id").alias("n_users")
    )


@query(
    "shard_range_drift",
    """
    SELECT event_id, CASE WHEN CAST(ts AS DATE) >= DATE '2024-01-16' THEN props END AS props,
           CASE WHEN CAST(ts AS DATE) < DATE '2024-01-16' THEN event_type END AS event_type
    FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-25'
    """,
)
def shard_range_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A range of shards of which the early ones lack ``props`` and the others ``event_type``."""
    path = scratch(spark, "shards")
    shards = table(spark, sf_dir, "events").withColumn("shard_date", F.to_date("ts"))
    early = F.col("shard_date") < F.lit("2024-01-16").cast("date")
    write_zone(shards.filter(early).select("event_id", "event_type", "shard_date"), path, by=["shard_date"])
    write_zone(shards.filter(~early).select("event_id", "props", "shard_date"), path, by=["shard_date"])
    days = read_shards(spark, path, dt.date(2024, 1, 5), dt.date(2024, 1, 25))
    return days.select("event_id", "props", "event_type")


@query(
    "shard_union",
    """
    SELECT event_id, user_id, event_type,
           CASE WHEN CAST(ts AS DATE) < DATE '2024-01-16' THEN props END AS props
    FROM events
    """,
)
def shard_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards with and without the column ``props``."""
    events = table(spark, sf_dir, "events")
    early = F.to_date("ts") < F.lit("2024-01-16").cast("date")
    columns = ["event_id", "user_id", "event_type"]
    return union_shards(
        [events.filter(early).select(*columns, "props"), events.filter(~early).select(*columns)]
    )


@query(
    "word_count",
    """
    SELECT word, count(*) AS n
    FROM (SELECT unnest(string_split_regex(lower(text), '\\s+')) AS word FROM documents)
    WHERE word <> '' GROUP BY word
    """,
)
def word_count_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_count(table(spark, sf_dir, "documents"), "text", lower=True)


@query(
    "word_count_lines",
    """
    SELECT word, count(*) AS n
    FROM (SELECT unnest(string_split_regex(regexp_replace(html, '[\\r\\n]+', ' ', 'g'), '\\s+')) AS word
          FROM pages)
    WHERE word <> '' GROUP BY word
    """,
)
def word_count_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word count over text files, one row per line, upper and lower case apart."""
    path = scratch(spark, "text")
    one_line = F.regexp_replace("html", r"[\r\n]+", " ").alias("value")
    table(spark, sf_dir, "pages").select(one_line).write.text(path)
    return word_count(read_text(spark, path))


@query(
    "peek_rows",
    "SELECT o_orderkey, o_custkey, o_orderpriority FROM orders ORDER BY o_orderkey LIMIT 10",
)
def peek_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    return peek(orders.orderBy("o_orderkey"))


@query(
    "scan_day_files",
    """
    SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, count(*) AS n_hits,
           count(DISTINCT user_id) AS n_sessions
    FROM events GROUP BY 1
    """,
)
def scan_day_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event sessions as gzip NDJSON, read with the schema of the fields in use."""
    path = scratch(spark, "sessions")
    export_ndjson(event_sessions(spark, sf_dir).select(*RAW.fieldNames()), path, gzip=True)
    back = read_sessions(spark, path).filter(F.col(CORRUPT).isNull())
    day = F.date_format(F.try_to_date("date", "yyyyMMdd"), "yyyy-MM-dd")
    return back.groupBy(day.alias("day")).agg(
        F.sum(F.size("hits")).cast("bigint").alias("n_hits"),
        F.count_distinct("visitId").alias("n_sessions"),
    )
