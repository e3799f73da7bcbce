"""Cuts between the steps of a long job."""

from __future__ import annotations

import gc

from pyspark.sql import DataFrame

from sessionlake.workspace import materialize, scratch


def step(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and go on from the table.

    Then the driver collects its garbage, so that Spark removes the shuffle
    files of the steps before: they would stay until it happens to do so.
    """
    out = materialize(df, name)
    spark = df.sparkSession
    del df
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    return out


def bucketed(df: DataFrame, name: str, column: str, count: int) -> DataFrame:
    """Write ``df`` to the shared folder as a table in ``count`` buckets of ``column`` and go on from it.

    Grouping by the column then reads the buckets where they are, without a
    shuffle. The table is one of a database below the job's folder, which
    ``workspace.clear`` removes.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    database = "llm_" + path.rsplit("-", 1)[1]
    spark.sql(f"CREATE DATABASE `{database}` LOCATION '{path}'")
    df.write.bucketBy(count, column).saveAsTable(f"{database}.{name}")
    return spark.table(f"{database}.{name}")
