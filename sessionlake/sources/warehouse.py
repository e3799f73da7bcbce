"""Staging tables and the final table, partitioned by upload and day."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sessionlake.contracts import PART, PART_FIELD, UPLOAD, UPLOAD_FIELD
from sessionlake.session import unsorted_writes

_MODE = "spark.sql.sources.partitionOverwriteMode"


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


@contextmanager
def static_overwrite(spark: SparkSession) -> Iterator[None]:
    """An overwrite replaces all partitions below the one it names."""
    before = spark.conf.get(_MODE)
    spark.conf.set(_MODE, "static")
    try:
        yield
    finally:
        spark.conf.set(_MODE, before)


def create_database(spark: SparkSession, name: str, location: str) -> None:
    """A database whose tables live below ``location``."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}` LOCATION {_quoted(location)}")


def create_table(
    spark: SparkSession,
    table: str,
    contract: StructType,
    partition: str = "date",
    comment: str = "",
    label: tuple[str, str] | None = None,
) -> None:
    """An empty Parquet table with the contract's columns, the part of a session and the upload.

    Partitioned by upload and then by day.
    """
    have = contract.fieldNames()
    fields = [*contract.fields, *[f for f in (PART_FIELD, UPLOAD_FIELD) if f.name not in have]]
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    properties = f" TBLPROPERTIES ({_quoted(label[0])} = {_quoted(label[1])})" if label else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet "
        f"PARTITIONED BY (`{UPLOAD}`, `{partition}`) COMMENT {_quoted(comment)}{properties}"
    )


def stage(df: DataFrame, table: str) -> DataFrame:
    """Replace the staging table of one upload and return it as stored."""
    df.write.mode("overwrite").saveAsTable(table)
    return df.sparkSession.table(table)


def publish(staged: DataFrame, table: str, upload: str, partition: str = "date", gather: bool = False) -> None:
    """Put the rows of one upload into the final table, columns matched by name.

    Replaces all rows that ``upload`` brought before, of whatever days, and
    leaves those of other uploads alone. So an upload published twice is there
    once, and customers and late sessions of one day stand side by side. Rows
    staged from a zone by day are not shuffled again; ``gather`` does so for
    other sources. A table must have a column for the part of a session, or a
    session of several rows would count more than once.
    """
    spark = staged.sparkSession
    columns = spark.table(table).columns
    if PART not in columns or UPLOAD not in columns:
        raise ValueError(f"{table} needs the columns {PART} and {UPLOAD}")
    rows = staged if PART in staged.columns else staged.withColumn(PART, F.lit(0))
    rows = rows.select(*[c for c in columns if c not in (UPLOAD, partition)], partition)
    if gather:
        rows = rows.hint("rebalance", partition)
    view = f"staged_{uuid.uuid4().hex}"
    rows.createOrReplaceTempView(view)
    try:
        with static_overwrite(spark), unsorted_writes(spark):
            spark.sql(
                f"INSERT OVERWRITE TABLE {table} PARTITION (`{UPLOAD}` = {_quoted(upload)}, `{partition}`) "
                f"SELECT * FROM {view}"
            )
    finally:
        spark.catalog.dropTempView(view)


def load_parquet(spark: SparkSession, path: str, table: str, upload: str | None = None) -> None:
    """Load Parquet files of any layout into the final table, as an upload of their own.

    The upload is named by the path unless a name is given; loading it again
    replaces what it brought. Columns may differ between the files.
    """
    rows = spark.read.option("mergeSchema", True).parquet(path)
    publish(rows.drop(UPLOAD), table, upload or path, gather=True)


def unstage(spark: SparkSession, table: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def reset_table(spark: SparkSession, table: str) -> None:
    """Empty a table and keep its definition."""
    spark.sql(f"TRUNCATE TABLE {table}")
