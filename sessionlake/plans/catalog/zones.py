"""Uploads, zones and the final table, fed with the event sessions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sessionlake.contracts import GOLD, LINE, PART, PART_FIELD, RAW, SESSION_KEY
from sessionlake.operators.audit import row_count
from sessionlake.plans.adapt import event_sessions, table
from sessionlake.plans.batch import Refined, publish_upload, refine, run_upload
from sessionlake.plans.catalog.conforming import total
from sessionlake.plans.catalog.registry import query
from sessionlake.plans.semantic import Tile
from sessionlake.sources.files import export_ndjson, list_files
from sessionlake.sources.uploads import next_date, pending_dates, present_days, ready_uploads
from sessionlake.sources.warehouse import create_database, create_table, load_parquet
from sessionlake.streaming.uploads import notification_stream, ready_stream, start_ready_log
from sessionlake.workspace import fingerprint, materialize, scratch

RAW_PARTS = StructType([*RAW.fields, PART_FIELD])
UPLOAD = "customer01/events/2024-01-31/end_file.txt"

_refined: dict[tuple[str, ...], Refined] = {}


def refine_events(spark: SparkSession, sf_dir: str) -> Refined:
    """The event sessions as an upload of NDJSON files, refined into new zones."""
    root = scratch(spark, "events")
    folder = f"{root}/ingestion/{UPLOAD.rpartition('/')[0]}"
    export_ndjson(event_sessions(spark, sf_dir), folder, gzip=True)
    customer, entity, upload = UPLOAD.split("/")[:3]
    return refine(spark, folder, f"{root}/lake", customer, entity, upload, RAW_PARTS)


def refined(spark: SparkSession, sf_dir: str) -> Refined:
    """The zones of the event sessions, written once while the events stay the same."""
    key = (spark.sparkContext.applicationId, sf_dir, fingerprint(spark, f"{sf_dir}/events.parquet"))
    if key not in _refined:
        _refined[key] = refine_events(spark, sf_dir)
    return _refined[key]


# The sessions of the event table: a user's day.
EVENT_SESSIONS = """
    SELECT user_id, CAST(ts AS DATE) AS d, count(*) AS n_hits,
           CAST(epoch(date_trunc('second', min(ts))) AS BIGINT) AS started,
           count(*) FILTER (event_type = 'purchase') AS purchases,
           CAST(coalesce(sum(CAST(round(value * 100) AS BIGINT))
                         FILTER (event_type = 'purchase'), 0) AS BIGINT) AS revenue
    FROM events GROUP BY 1, 2
"""


@query(
    "bronze_roundtrip",
    f"""
    SELECT year(d) AS "year", month(d) AS "month", day(d) AS "day", count(*) AS sessions,
           CAST(sum(n_hits) AS BIGINT) AS hits, strftime(d, '%Y%m%d') AS date_text
    FROM ({EVENT_SESSIONS}) GROUP BY d
    """,
)
def bronze_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw columns as they came, by day."""
    zone = refined(spark, sf_dir).zone(spark, "bronze")
    days = [F.col(c).cast("bigint").alias(c) for c in ("year", "month", "day")]
    return zone.groupBy(*days, F.col("date").alias("date_text")).agg(
        F.count_if(F.col(PART) == 0).alias("sessions"),
        F.sum(F.size("hits.hitNumber")).cast("bigint").alias("hits"),
    )


@query(
    "silver_roundtrip",
    f"""
    SELECT CAST(d AS VARCHAR) AS "date", count(*) AS sessions,
           CAST(sum(user_id) AS BIGINT) AS visit_ids, CAST(sum(day(d)) AS BIGINT) AS visit_numbers,
           CAST(sum(started) AS BIGINT) AS started
    FROM ({EVENT_SESSIONS}) GROUP BY 1
    """,
)
def silver_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Root numbers cast and the date a DATE, by day."""
    zone = refined(spark, sf_dir).zone(spark, "silver").filter(F.col(PART) == 0)
    return zone.groupBy(F.col("date").cast("string").alias("date")).agg(
        F.count(F.lit(1)).alias("sessions"),
        F.sum("visitId").alias("visit_ids"),
        F.sum("visitNumber").alias("visit_numbers"),
        F.sum("visitStartTime").alias("started"),
    )


@query(
    "gold_roundtrip",
    f"""
    SELECT CAST(d AS VARCHAR) AS "date", count(*) AS sessions, CAST(sum(n_hits) AS BIGINT) AS hits,
           CAST(sum(revenue) AS BIGINT) AS revenue, CAST(sum(purchases) AS BIGINT) AS purchases,
           CAST(sum(revenue) AS BIGINT) AS hit_revenue, count(*) FILTER (n_hits = 1) AS bounces
    FROM ({EVENT_SESSIONS}) GROUP BY 1
    """,
)
def gold_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract columns only, nested numbers cast, by day."""
    zone = refined(spark, sf_dir).zone(spark, "gold")
    first = F.col(PART) == 0

    def once(c: str):
        return F.coalesce(F.sum(F.when(first, F.col(c))), F.lit(0))

    return zone.groupBy(F.col("date").cast("string").alias("date")).agg(
        F.count_if(first).alias("sessions"),
        F.sum(F.size("hits.hitNumber")).cast("bigint").alias("hits"),
        once("totals.transactionRevenue").alias("revenue"),
        once("totals.transactions").alias("purchases"),
        F.sum(total("hits.transaction.transactionRevenue")).alias("hit_revenue"),
        once("totals.bounces").alias("bounces"),
    )


@query(
    "zone_audit",
    f"""
    SELECT unnest(['sessions', 'bronze', 'silver', 'gold', 'with_hits', 'hits', 'rejected']) AS step,
           unnest([n, n, n, n, n, h, 0]) AS n_rows
    FROM (SELECT count(*) AS n, CAST(sum(n_hits) AS BIGINT) AS h FROM ({EVENT_SESSIONS}))
    """,
)
def zone_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of the steps of the batch flow, as observed while it ran."""
    counts = refine_events(spark, sf_dir).counts
    return spark.createDataFrame(list(counts.items()), "step string, n_rows bigint")


@query(
    "publish_sessions",
    f"""
    SELECT CAST(d AS VARCHAR) AS "date", count(*) AS sessions, CAST(sum(n_hits) AS BIGINT) AS hits,
           CAST(sum(revenue) AS BIGINT) AS revenue
    FROM ({EVENT_SESSIONS}) GROUP BY 1
    """,
)
def publish_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Create the final table, publish the same upload twice, and find it there once."""
    return per_day(spark.table(publish_twice(spark, sf_dir)))


def publish_twice(spark: SparkSession, sf_dir: str) -> str:
    """A new final table into which the upload is published twice."""
    database = new_table(spark, "wh_")
    for _ in range(2):
        publish_upload(spark, refined(spark, sf_dir), UPLOAD, database, "sessions")
    return f"`{database}`.sessions"


def new_table(spark: SparkSession, prefix: str) -> str:
    """A new database with an empty final table; the database's name."""
    location = scratch(spark, "warehouse")
    database = prefix + location.rpartition("-")[2]
    create_database(spark, database, location)
    create_table(
        spark, f"`{database}`.sessions", GOLD, "date", "Sessions by day", ("team", "analytics")
    )
    return database


_published: dict[tuple[str, ...], str] = {}


def published(spark: SparkSession, sf_dir: str) -> str:
    """The final table with the upload published twice; made once while the events stay the same."""
    key = (spark.sparkContext.applicationId, sf_dir, fingerprint(spark, f"{sf_dir}/events.parquet"))
    if key not in _published:
        _published[key] = publish_twice(spark, sf_dir)
    return _published[key]


def per_day(final: DataFrame) -> DataFrame:
    """Sessions, hits and revenue of each day."""
    return final.groupBy(F.col("date").cast("string").alias("date")).agg(
        F.count_if(F.col(PART) == 0).alias("sessions"),
        F.sum(F.size("hits.hitNumber")).cast("bigint").alias("hits"),
        F.coalesce(
            F.sum(F.when(F.col(PART) == 0, F.col("totals.transactionRevenue"))), F.lit(0)
        ).alias("revenue"),
    )


PER_DAY = f"""
    SELECT CAST(d AS VARCHAR) AS "date", count(*) AS sessions, CAST(sum(n_hits) AS BIGINT) AS hits,
           CAST(sum(revenue) AS BIGINT) AS revenue
    FROM ({EVENT_SESSIONS}) {{where}} GROUP BY 1
"""


def uploaded(spark: SparkSession, sf_dir: str, uploads: list[tuple[str, str]]) -> DataFrame:
    """The final table after the whole flow for each (marker, condition on raw sessions)."""
    root, database = scratch(spark, "uploads"), new_table(spark, "up_")
    sessions = materialize(event_sessions(spark, sf_dir), "event_sessions")
    for n, (marker, condition) in enumerate(uploads):
        folder = f"{root}/in{n}/{marker.rpartition('/')[0]}"
        export_ndjson(sessions.filter(condition), folder, gzip=True)
        run_upload(spark, f"{root}/in{n}", f"{root}/lake", marker, database, "sessions", RAW_PARTS)
    return spark.table(f"`{database}`.sessions")


@query("publish_two_customers", PER_DAY.format(where=""))
def publish_two_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two customers with sessions of the same days in one table."""
    return per_day(uploaded(spark, sf_dir, [
        ("customer01/events/2024-01-31/end_file.txt", "CAST(visitId AS bigint) % 3 = 0"),
        ("customer02/events/2024-01-31/end_file.txt", "CAST(visitId AS bigint) % 3 <> 0"),
    ]))


@query("publish_late_sessions", PER_DAY.format(where=""))
def publish_late_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Later uploads that hold sessions of days which earlier ones brought."""
    late = "CAST(visitId AS bigint) % 5 = 0"
    return per_day(uploaded(spark, sf_dir, [
        ("customer01/events/2024-01-15/end_file.txt", f"date <= '20240115' AND NOT {late}"),
        ("customer01/events/2024-01-16/end_file.txt", f"date > '20240115' OR {late}"),
    ]))


@query("publish_rerun_fewer_days", PER_DAY.format(where="WHERE d > DATE '2024-01-10'"))
def publish_rerun_fewer_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An upload run again without some of its days: those are gone, from zones and table."""
    return per_day(uploaded(spark, sf_dir, [
        ("customer01/events/2024-01-31/end_file.txt", "true"),
        ("customer01/events/2024-01-31/end_file.txt", "date > '20240110'"),
    ]))


@query(
    "silver_as_is",
    """
    SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS "date", count(*) AS n, CAST(sum(user_id) AS BIGINT) AS users,
           count(DISTINCT event_type) AS types
    FROM events GROUP BY 1
    """,
)
def silver_as_is(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as session lines with fields that the schema does not have, counted in silver."""
    root, database = scratch(spark, "as_is"), new_table(spark, "as_")
    events = table(spark, sf_dir, "events").select(
        F.date_format("ts", "yyyyMMdd").alias("date"), F.struct("user_id", "event_type").alias("unforeseen")
    )
    marker = "customer01/lines/2024-01-31/end_file.txt"
    export_ndjson(events, f"{root}/in/{marker.rpartition('/')[0]}")
    done = run_upload(spark, f"{root}/in", f"{root}/lake", marker, database, "sessions")
    silver = done.zone(spark, "silver")
    field = F.from_json(LINE, "unforeseen struct<user_id: bigint, event_type: string>")["unforeseen"]
    return silver.groupBy(F.col("date").cast("string").alias("date")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(field["user_id"]).alias("users"), F.count_distinct(field["event_type"]).alias("types")
    )


@query(
    "tile_published_weeks",
    f"""
    SELECT CAST(CAST(date_trunc('week', d) AS DATE) AS VARCHAR) AS date_week, count(*) AS "count"
    FROM ({EVENT_SESSIONS}) WHERE year(d) = 2024 GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 3
    """,
)
def tile_published_weeks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tile over the final table, which is partitioned by date."""
    tile = Tile(by=["date.week"], limit=3, filters={"date.year": 2024})
    rows = tile.rows(spark.table(published(spark, sf_dir)))
    return rows.select(F.col("date_week").cast("string").alias("date_week"), "count")


@query("publish_count", f"SELECT count(*) AS n_rows FROM ({EVENT_SESSIONS})")
def publish_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    final = spark.table(published(spark, sf_dir))
    return row_count(final.filter(F.col(PART) == 0))


@query(
    "load_parquet",
    f"""
    SELECT CAST(user_id AS VARCHAR) AS visit_id, CAST(d AS VARCHAR) AS "date", n_hits
    FROM ({EVENT_SESSIONS})
    """,
)
def load_parquet_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parquet files with sessions of the same days loaded straight into a table."""
    name, gold = f"`{new_table(spark, 'ld_')}`.sessions", refined(spark, sf_dir).path("gold")
    # two files of the same days, one of them loaded twice
    for n, condition in ((0, "visitId % 2 = 0"), (1, "visitId % 2 = 1"), (1, "visitId % 2 = 1")):
        part = f"{scratch(spark, 'files')}/{n}"
        spark.read.parquet(gold).filter(condition).write.parquet(part)
        load_parquet(spark, part, name, f"file {n}")
    final = spark.table(name)
    return final.groupBy(
        F.col("visitId").cast("string").alias("visit_id"), F.col("date").cast("string").alias("date")
    ).agg(F.sum(F.size("hits.hitNumber")).cast("bigint").alias("n_hits"))


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file list: a data file per order and an end marker for the even days of a month."""
    orders = table(spark, sf_dir, "orders")
    folder = F.concat(F.lit("customer01/orders/"), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("/"))
    data = orders.select(
        F.concat(folder, F.lit("data_"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0"), F.lit(".json"))
        .alias("path")
    )
    markers = (
        orders.filter(F.dayofmonth("o_orderdate") % 2 == 0)
        .select(F.concat(folder, F.lit("end_file.txt")).alias("path")).distinct()
    )
    return data.union(markers)


@query(
    "listed_uploads",
    """
    SELECT event_type AS customer, CAST(d AS VARCHAR) AS upload_date
    FROM (SELECT DISTINCT event_type, CAST(ts AS DATE) AS d FROM events) WHERE day(d) % 2 = 0
    """,
)
def listed_uploads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Real files of a folder per event type and day, of which the even days have an end marker."""
    root = scratch(spark, "listed")
    events = table(spark, sf_dir, "events").select("event_id", "event_type", F.to_date("ts").alias("d"))
    days = events.hint("rebalance", "event_type", "d")
    days.write.partitionBy("event_type", "d").json(f"{root}/data")
    marks = events.filter(F.dayofmonth("d") % 2 == 0).select("event_type", "d").distinct()
    marks.withColumn("value", F.lit("DONE")).coalesce(1).write.partitionBy("event_type", "d").text(f"{root}/marks")
    name = F.regexp_extract("path", "event_type=([^/]+)/d=([^/]+)/", 1)
    day = F.regexp_extract("path", "event_type=([^/]+)/d=([^/]+)/", 2)
    # a partitioned write names its files itself: a text file stands for the marker
    file = F.when(F.col("path").contains("/marks/"), "end_file.txt").otherwise("data.json")
    files = list_files(spark, f"{root}/data", "*.json").unionByName(list_files(spark, f"{root}/marks", "*.txt"))
    ready = ready_uploads(files.select(F.concat_ws("/", name, F.lit("events"), day, file).alias("path")))
    return ready.select("customer", F.col("upload_date").cast("string").alias("upload_date"))


READY = """
    SELECT 'customer01/orders/' || strftime(d, '%Y-%m-%d') AS folder, 'customer01' AS customer,
           'orders' AS entity, CAST(d AS VARCHAR) AS upload_date{more}
    FROM (SELECT CAST(o_orderdate AS DATE) AS d FROM orders) WHERE day(d) % 2 = 0 GROUP BY d
"""


@query("ready_uploads", READY.format(more=", count(*) AS data_files"))
def ready_uploads_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready = ready_uploads(manifest(spark, sf_dir))
    return ready.withColumn("upload_date", F.col("upload_date").cast("string"))


@query(
    "ready_uploads_stream",
    READY.format(more=", 'customer01/orders/' || strftime(d, '%Y-%m-%d') || '/end_file.txt' AS path"),
)
def ready_uploads_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from a stream of notifications, one per written file."""
    root = scratch(spark, "notifications")
    made = manifest(spark, sf_dir).select(
        F.lit("ingestion").alias("bucket"), F.col("path").alias("name"),
        F.lit("2024-01-31T00:00:00Z").alias("timeCreated"),
    )
    made.write.json(f"{root}/in")
    ready = ready_stream(notification_stream(spark, f"{root}/in"))
    start_ready_log(ready, f"{root}/ready", f"{root}/checkpoint", once=True).awaitTermination()
    log = spark.read.schema(ready.schema).parquet(f"{root}/ready")
    return log.withColumn("upload_date", F.col("upload_date").cast("string"))


@query(
    "pending_dates",
    """
    SELECT CAST(d AS VARCHAR) AS "date" FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)
    WHERE day(d) % 2 = 1
    """,
)
def pending_dates_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order days whose upload is not complete."""
    available = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("date"))
    done = ready_uploads(manifest(spark, sf_dir)).select(F.col("upload_date").alias("date"))
    return pending_dates(available, done).select(F.col("date").cast("string").alias("date"))


@query(
    "next_date",
    """
    SELECT CAST(min(d) AS VARCHAR) AS next_date FROM (SELECT CAST(o_orderdate AS DATE) AS d FROM orders)
    WHERE d > (SELECT max(CAST(o_orderdate AS DATE)) FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01')
    """,
)
def next_date_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first order day after those of 1995, which are the done ones."""
    days = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("date"))
    done = days.filter(F.col("date") < F.lit("1996-01-01").cast("date"))
    return next_date(days, done).select(F.col("next_date").cast("string").alias("next_date"))


@query(
    "has_partition",
    """
    SELECT CAST(d AS VARCHAR) AS "date", CAST(d AS DATE) IN (SELECT CAST(ts AS DATE) FROM events) AS present
    FROM (VALUES ('2023-12-31'), ('2024-01-01'), ('2024-01-30'), ('2024-03-01')) v(d)
    """,
)
def has_partition_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the gold zone has sessions of a day."""
    zone = refined(spark, sf_dir).zone(spark, "gold")
    days = [dt.date(2023, 12, 31), dt.date(2024, 1, 1), dt.date(2024, 1, 30), dt.date(2024, 3, 1)]
    found = present_days(zone, spark.createDataFrame([(d,) for d in days], "date date"))
    return found.select(F.col("date").cast("string").alias("date"), "present")


@query(
    "session_keys",
    f"SELECT count(*) AS n_keys, count(*) AS n_sessions FROM ({EVENT_SESSIONS})",
)
def session_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The session key is unique in the gold zone."""
    zone = refined(spark, sf_dir).zone(spark, "gold").filter(F.col(PART) == 0)
    keys = zone.groupBy(*SESSION_KEY).agg(F.count(F.lit(1)).alias("n"))
    return keys.agg(F.count(F.lit(1)).alias("n_keys"), F.sum("n").alias("n_sessions"))
