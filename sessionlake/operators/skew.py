"""Split the groups that are too big for one task or one row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionlake.contracts import PART
from sessionlake.operators.audit import audited
from sessionlake.workspace import materialize

# Items one row's array should hold. Groups beyond it go on in further parts.
PART_ITEMS = 20_000

# Items a task groups. A hit has some hundred bytes in memory and a tenth of
# that in a shuffle, so tasks whose size is taken from the shuffle would spill.
TASK_ITEMS = 100_000


def hot_keys(df: DataFrame, keys: list[str], part_items: int = PART_ITEMS) -> DataFrame:
    """Keys with more than ``part_items`` rows and the number of parts each needs."""
    return counted_keys(df, keys, part_items)[0]


def counted_keys(df: DataFrame, keys: list[str], part_items: int = PART_ITEMS) -> tuple[DataFrame, int]:
    """The hot keys, and how many tasks should group the rows of all keys.

    Reads the key columns only and counts before it shuffles. The result is a
    written table, so the planner knows its size: it is broadcast below the
    session's threshold and sort-merge joined above it.
    """
    if part_items < 1000:
        raise ValueError("part_items below 1000 could leave a part empty")
    sizes, seen = audited(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")), "keys", items=F.sum("_n"))
    hot = sizes.filter(F.col("_n") > part_items).select(
        *[F.col(k).alias(f"_hot_{k}") for k in keys],
        "_n",
        F.ceil(F.col("_n") / part_items).cast("int").alias("_parts"),
    )
    hot = materialize(hot, "hot_keys")
    return hot, max(1, -(-(seen.get["items"] or 0) // TASK_ITEMS))


def _with_hot(df: DataFrame, hot: DataFrame, keys: list[str]) -> DataFrame:
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_hot_{k}")) for k in keys])
    return df.join(hot, same, "left").drop(*[f"_hot_{k}" for k in keys])


def with_part(df: DataFrame, hot: DataFrame, keys: list[str], spread_by: list[str]) -> DataFrame:
    """Add the part each row of its key belongs to.

    ``spread_by`` names columns that tell the rows of one key apart, copies
    included; the part is a hash of them, so a task that runs again assigns the
    same parts.
    """
    part = F.when(F.col("_parts").isNull(), F.lit(0)).otherwise(
        F.pmod(F.xxhash64(*spread_by), F.col("_parts")).cast("int")
    )
    return _with_hot(df, hot, keys).withColumn(PART, part).drop("_parts", "_n")


def expand_parts(df: DataFrame, hot: DataFrame, keys: list[str]) -> DataFrame:
    """One row per part of the key: the other side of a join on (keys, part).

    ``_n`` holds the number of items of a hot key and is NULL for the others.
    """
    parts = F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1)
    return _with_hot(df, hot, keys).withColumn(PART, F.explode(parts)).drop("_parts")
