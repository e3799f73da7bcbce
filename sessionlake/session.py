"""Sessions for tests and benchmarks, and the settings a cluster should use."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# What a cluster session should set for inputs of tens of terabytes; ``cluster_session`` does. The
# initial partition number is high because adaptive execution merges small
# partitions back but never splits a group of an aggregate.
CLUSTER_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(
    cores: int | str = 8, app: str = "sessionlake", more: dict[str, str] | None = None
) -> SparkSession:
    """Single-machine session for tests and ``bench.py``."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config(map=more or {})
        .getOrCreate()
    )


def cluster_session(app: str) -> SparkSession:
    """The session of a submitted job: ``CLUSTER_SETTINGS`` where the submit sets nothing else.

    A session that is there already is used as it is.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    spark = SparkSession.builder.appName(app).getOrCreate()
    given = dict(spark.sparkContext.getConf().getAll())
    for key, value in CLUSTER_SETTINGS.items():
        if key not in given:
            spark.conf.set(key, value)
    return spark


#: Files a task may have open at once while it writes partitions. Rows of further ones are sorted.
OPEN_FILES = 64


@contextmanager
def unsorted_writes(spark: SparkSession) -> Iterator[None]:
    """Tasks write rows to the files of their partitions as they come.

    Otherwise a task sorts its rows by partition first. Rows of a Parquet file
    are a few dozen times as large in memory, so that sort spills even where
    the rows lie by partition already.
    """
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    spark.conf.set(key, str(max(int(before), OPEN_FILES)))
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextmanager
def file_a_task(spark: SparkSession) -> Iterator[None]:
    """Tasks read one file each, or a split of one, however small the files are."""
    key = "spark.sql.files.openCostInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, spark.conf.get("spark.sql.files.maxPartitionBytes"))
    try:
        yield
    finally:
        spark.conf.set(key, before)
