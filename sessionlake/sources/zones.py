"""The bronze, silver and gold Parquet zones."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sessionlake.contracts import DAY
from sessionlake.operators.audit import audited
from sessionlake.session import unsorted_writes


def write_zone(
    df: DataFrame,
    path: str,
    by: list[str] = DAY,
    gather: bool = True,
    metrics: dict[str, Column] | None = None,
    max_records_per_file: int = 0,
    whole: bool = False,
) -> dict[str, object]:
    """Write partitions and replace those of an earlier run, so a re-run changes nothing.

    Only partitions that the new rows have are replaced; with ``whole`` all
    that is below ``path`` is, so ``path`` belongs to one writer.

    ``gather`` brings the rows of a partition together, so a day gets few files,
    and lets adaptive execution cut a day that is too big for one task. Rows
    that come from a zone of the same layout are gathered already; without it
    they are written where they are, and nothing is shuffled.

    ``metrics`` are aggregates taken while writing and returned. They are taken
    after the shuffle: there a task that is repeated counts once.
    """
    if gather:
        df = df.hint("rebalance", *by)
    df, seen = audited(df, f"write {path}", **(metrics or {}))
    writer = (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "static" if whole else "dynamic")
        .option("maxRecordsPerFile", max_records_per_file)
        .partitionBy(*by)
    )
    with unsorted_writes(df.sparkSession):
        writer.parquet(path)
    return seen.get


def _day_number() -> Column:
    """Year, month and day of a row's partition as one number, 20170601."""
    return F.col("year") * 10000 + F.col("month") * 100 + F.col("day")


def between(df: DataFrame, start: dt.date | None, end: dt.date | None) -> DataFrame:
    """The days from ``start`` to ``end``, by partition columns only, so that others are not read."""
    if start is not None:
        df = df.filter(_day_number() >= int(start.strftime("%Y%m%d")))
    if end is not None:
        df = df.filter(_day_number() <= int(end.strftime("%Y%m%d")))
    return df


def read_zone(
    spark: SparkSession,
    path: str,
    start: dt.date | None = None,
    end: dt.date | None = None,
    schema: StructType | None = None,
) -> DataFrame:
    """The days from ``start`` to ``end``; with ``schema`` only its columns and leaves are read.

    Without it the columns of all files are read, for which all footers are looked at.
    """
    reader = spark.read.schema(schema) if schema is not None else spark.read.option("mergeSchema", True)
    return between(reader.parquet(path), start, end)


def read_day(spark: SparkSession, path: str, day: dt.date) -> DataFrame:
    """One day's partition."""
    return spark.read.parquet(path).filter(
        (F.col("year") == day.year) & (F.col("month") == day.month) & (F.col("day") == day.day)
    )
