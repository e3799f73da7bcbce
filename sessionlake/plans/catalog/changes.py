"""Change data: log, latest, replica, routing, dead letters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionlake.operators.cdc import (
    apply_changes,
    high_watermark,
    latest,
    route,
    select_sources,
    since,
    split_valid,
    with_backfill,
    with_reasons,
)
from sessionlake.plans.adapt import cents, event_changes, table
from sessionlake.plans.catalog.registry import query
from sessionlake.sources.files import read_changes
from sessionlake.streaming.changes import Replica, change_stream, start_log, start_merge
from sessionlake.workspace import scratch

# Change records as they are made from the events.
CHANGES = """
    SELECT event_type AS tbl, CASE event_type WHEN 'signup' THEN 'INSERT' WHEN 'error' THEN 'DELETE'
           ELSE 'UPDATE' END AS op, ts, event_id AS seq, user_id,
           CAST(round(value * 100) AS BIGINT) AS cents, props
    FROM events
"""
LATEST = f"""
    SELECT * FROM ({CHANGES})
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, seq DESC) = 1
"""
ROW = "user_id, cents, props"


def payload(df: DataFrame) -> DataFrame:
    return df.select("user_id", cents(F.col("value")).alias("cents"), "props")


def change_files(spark: SparkSession, sf_dir: str, root: str) -> DataFrame:
    """The changes as Parquet change files in the order they happened; returns the stream."""
    changes = event_changes(spark, sf_dir)
    changes.repartitionByRange("_seq").write.parquet(f"{root}/in")
    return change_stream(spark, f"{root}/in", changes.schema, "parquet", max_files=2)


@query("cdc_log", f"SELECT tbl || '_log' AS target, op, count(*) AS n FROM ({CHANGES}) GROUP BY 1, 2")
def cdc_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change files streamed into the change log of each table."""
    root = scratch(spark, "log")
    stream = change_files(spark, sf_dir, root)
    start_log(stream, f"{root}/log", f"{root}/checkpoint", once=True).awaitTermination()
    log = spark.read.parquet(f"{root}/log")
    return log.groupBy(F.col("_target").alias("target"), F.col("_op").alias("op")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query("cdc_changes", f"SELECT seq, user_id, cents FROM ({CHANGES})")
def cdc_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change files read as a batch."""
    path = scratch(spark, "changes")
    changes = event_changes(spark, sf_dir)
    changes.write.json(path)
    back = read_changes(spark, path, changes.schema, "json")
    return back.select(F.col("_seq").alias("seq"), "user_id", cents(F.col("value")).alias("cents"))


@query("cdc_latest", f"SELECT tbl, op, seq, {ROW} FROM ({LATEST})")
def cdc_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = latest(event_changes(spark, sf_dir), ["user_id"])
    return last.select(
        F.col("_metadata_table").alias("tbl"), F.col("_op").alias("op"), F.col("_seq").alias("seq"),
        "user_id", cents(F.col("value")).alias("cents"), "props",
    )


@query(
    "cdc_replica",
    f"""
    SELECT {ROW} FROM ({LATEST}) WHERE op <> 'DELETE'
    UNION ALL
    SELECT c_custkey, CAST(round(c_acctbal * 100) AS BIGINT), c_mktsegment FROM customer
    WHERE c_custkey NOT IN (SELECT user_id FROM events)
    """,
)
def cdc_replica(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customers as the table before the changes, and the changes applied to it."""
    base = customers(spark, sf_dir)
    return payload(apply_changes(base, event_changes(spark, sf_dir), ["user_id"]))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"),
        F.col("c_acctbal").alias("value"),
        F.col("c_mktsegment").alias("props"),
    )


@query("cdc_replica_stream", f"SELECT {ROW} FROM ({LATEST}) WHERE op <> 'DELETE'")
def cdc_replica_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The replica that a stream merged from the change files, several files at a time."""
    return payload(merged(spark, sf_dir).rows())


def merged(spark: SparkSession, sf_dir: str) -> Replica:
    root = scratch(spark, "replica")
    stream = change_files(spark, sf_dir, root)
    # the events of a user are one row here, whatever their type
    replica = Replica(spark, f"{root}/replica", stream.schema, ["user_id"], template="users")
    rules = {"key": F.col("user_id").isNotNull(), "op": F.col("_op").isin("INSERT", "UPDATE", "DELETE")}
    start_merge(
        stream, replica, f"{root}/dead", f"{root}/checkpoint", rules, once=True
    ).awaitTermination()
    return replica


@query(
    "cdc_replica_tables",
    f"""
    SELECT tbl, {ROW} FROM (
        SELECT * FROM ({CHANGES}) QUALIFY row_number() OVER (PARTITION BY tbl, user_id ORDER BY ts DESC, seq DESC) = 1)
    WHERE op <> 'DELETE'
    """,
)
def cdc_replica_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One replica for each event type, from one stream of changes."""
    root = scratch(spark, "replicas")
    stream = change_files(spark, sf_dir, root)
    replica = Replica(spark, f"{root}/replica", stream.schema, ["user_id"])
    rules = {"key": F.col("user_id").isNotNull()}
    start_merge(stream, replica, f"{root}/dead", f"{root}/checkpoint", rules, once=True).awaitTermination()
    alive = replica.stored().filter("_op <> 'DELETE'")
    return alive.select(F.col("_target").alias("tbl"), "user_id", cents(F.col("value")).alias("cents"), "props")


@query(
    "cdc_backfill_stream",
    f"""
    SELECT {ROW} FROM (
        SELECT op, ts, seq, {ROW} FROM ({CHANGES})
        UNION ALL
        SELECT 'INSERT', NULL, -2, c_custkey, CAST(round(c_acctbal * 100) AS BIGINT), c_mktsegment FROM customer
        UNION ALL
        SELECT 'INSERT', NULL, -1, s_suppkey, CAST(round(s_acctbal * 100) AS BIGINT), s_name FROM supplier)
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, seq DESC) = 1 AND op <> 'DELETE'
    """,
)
def cdc_backfill_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two full copies, the second over the first, then the changes under one checkpoint and again under a new one."""
    root = scratch(spark, "backfills")
    stream = change_files(spark, sf_dir, root)
    replica = Replica(spark, f"{root}/replica", stream.schema, ["user_id"], template="users")
    suppliers = table(spark, sf_dir, "supplier")
    replica.backfill(customers(spark, sf_dir), "users")
    replica.backfill(
        suppliers.select(F.col("s_suppkey").alias("user_id"), F.col("s_acctbal").alias("value"), F.col("s_name").alias("props")), "users"
    )
    rules = {"key": F.col("user_id").isNotNull()}
    for checkpoint in ("first", "second"):
        start_merge(stream, replica, f"{root}/dead/{checkpoint}", f"{root}/{checkpoint}", rules, once=True).awaitTermination()
    return payload(replica.rows())


@query(
    "cdc_backfill_union",
    f"""
    SELECT {ROW}, op FROM (
        SELECT op, ts, seq, {ROW} FROM ({CHANGES})
        UNION ALL
        SELECT 'INSERT', NULL, -1, c_custkey, CAST(round(c_acctbal * 100) AS BIGINT), c_mktsegment FROM customer)
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, seq DESC) = 1
    """,
)
def cdc_backfill_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A full copy of the source before its changes; the latest of both wins."""
    changes = with_backfill(customers(spark, sf_dir), event_changes(spark, sf_dir), "customer")
    last = latest(changes, ["user_id"])
    return last.select(
        "user_id", cents(F.col("value")).alias("cents"), "props", F.col("_op").alias("op")
    )


@query("cdc_route", f"SELECT tbl || '_log' AS target, count(*) AS n FROM ({CHANGES}) GROUP BY 1")
def cdc_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes written to the table their template names."""
    path = scratch(spark, "routed")
    routed = route(event_changes(spark, sf_dir), "{_metadata_table}_log")
    routed.hint("rebalance", "_target").write.partitionBy("_target").parquet(path)
    back = spark.read.parquet(path)
    return back.groupBy(F.col("_target").alias("target")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "cdc_allowlist",
    f"SELECT tbl, op, count(*) AS n FROM ({CHANGES}) WHERE tbl IN ('click', 'purchase') GROUP BY 1, 2",
)
def cdc_allowlist(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = select_sources(
        event_changes(spark, sf_dir), allow=["click", "purchase", "view"], reject=["view"]
    )
    return changes.groupBy(F.col("_metadata_table").alias("tbl"), F.col("_op").alias("op")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    "cdc_since",
    f"SELECT tbl, count(*) AS n FROM ({CHANGES}) WHERE ts >= TIMESTAMP '2024-01-15 00:00:00' GROUP BY 1",
)
def cdc_since(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = since(event_changes(spark, sf_dir), "2024-01-15 00:00:00")
    return changes.groupBy(F.col("_metadata_table").alias("tbl")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "cdc_dead_letter",
    f"""
    SELECT CASE WHEN TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) < 90 THEN 'valid' ELSE 'k' END AS outcome,
           tbl, count(*) AS n FROM ({CHANGES}) GROUP BY 1, 2
    """,
)
def cdc_dead_letter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes that break a rule are set aside with its name."""
    k = F.get_json_object("props", "$.k").try_cast("bigint")
    checked = with_reasons(event_changes(spark, sf_dir), {"k": k < 90})
    outcome = F.when(F.size("_reasons") == 0, "valid").otherwise(F.concat_ws(",", "_reasons"))
    return checked.groupBy(outcome.alias("outcome"), F.col("_metadata_table").alias("tbl")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    "cdc_split",
    f"""
    SELECT user_id, seq, 'valid' AS outcome FROM ({CHANGES}) WHERE op <> 'DELETE' AND cents < 5000
    UNION ALL
    SELECT user_id, seq, concat_ws(',', CASE WHEN op = 'DELETE' THEN 'op' END,
                                        CASE WHEN cents >= 5000 THEN 'value' END)
    FROM ({CHANGES}) WHERE op = 'DELETE' OR cents >= 5000
    """,
)
def cdc_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid changes and dead letters written apart and read back."""
    path = scratch(spark, "split")
    rules = {"op": F.col("_op") != "DELETE", "value": cents(F.col("value")) < 5000}
    valid, rejected = split_valid(event_changes(spark, sf_dir), rules)
    valid.write.parquet(f"{path}/valid")
    rejected.write.json(f"{path}/dead")
    letters = spark.read.schema(rejected.schema).json(f"{path}/dead")
    columns = ["user_id", F.col("_seq").alias("seq")]
    return spark.read.parquet(f"{path}/valid").select(*columns, F.lit("valid").alias("outcome")).union(
        letters.select(*columns, F.concat_ws(",", "_reasons").alias("outcome"))
    )


@query(
    "cdc_high_watermark",
    f"SELECT tbl, max(seq) AS high_watermark FROM ({CHANGES}) GROUP BY 1",
)
def cdc_high_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    marks = high_watermark(event_changes(spark, sf_dir), "_seq", by="_metadata_table")
    return marks.withColumnRenamed("_metadata_table", "tbl")
