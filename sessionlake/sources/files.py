"""Readers for session files, change files, CSV and text, and the NDJSON export."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from sessionlake.contracts import RAW

CORRUPT = "_corrupt_record"


def read_sessions(
    spark: SparkSession, path: str, schema: StructType = RAW, pattern: str = "*.json*", line: str | None = None
) -> DataFrame:
    """Newline-delimited JSON with a given schema: no pass over the data to infer one.

    Absent fields and structs are typed NULLs. A line that is no JSON is kept
    in ``_corrupt_record``. ``.gz`` and ``.gzip`` files are decoded by suffix.
    With ``line`` the whole line is kept in a column of that name, so fields
    that the schema does not have are not lost.
    """
    with_corrupt = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    if line is not None:
        lines = spark.read.option("pathGlobFilter", pattern).text(path).filter(F.trim("value") != "")
        parsed = F.from_json("value", with_corrupt, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
        return lines.select(parsed.alias("_row"), F.col("value").alias(line)).select("_row.*", line)
    return (
        spark.read.schema(with_corrupt)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("pathGlobFilter", pattern)
        .json(path)
    )


def export_ndjson(df: DataFrame, path: str, gzip: bool = False) -> None:
    """Write newline-delimited JSON, one file per task."""
    df.write.mode("overwrite").option("compression", "gzip" if gzip else "none").json(path)


def read_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """CSV with a header line."""
    return spark.read.schema(schema).option("header", True).csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """One row per line in the column ``value``."""
    return spark.read.text(path)


def read_changes(spark: SparkSession, path: str, schema: StructType, fmt: str = "avro") -> DataFrame:
    """Change files of one stream. Avro needs the spark-avro package on the cluster."""
    return spark.read.format(fmt).schema(schema).load(path)


def read_shards(
    spark: SparkSession, base: str, start: dt.date, end: dt.date, shard: str = "shard_date",
    schema: StructType | None = None,
) -> DataFrame:
    """Daily shards ``base/shard_date=.../`` as one range; other days are not read.

    Columns may differ between shards: those of ``schema`` are read, or without
    it those of any shard, for which the footers of all files are looked at.
    """
    reader = spark.read.option("mergeSchema", schema is None)
    reader = reader if schema is None else reader.schema(schema)
    return reader.parquet(base).filter(F.col(shard).between(F.lit(start), F.lit(end)))


def union_shards(shards: list[DataFrame]) -> DataFrame:
    """Shards whose columns differ; a column a shard lacks is NULL for it."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), shards)


def list_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Path, length and time of all files below ``path``; their content is not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(path)
        .select("path", "length", "modificationTime")
    )
