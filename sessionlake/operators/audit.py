"""Row counts of the steps of a job without extra jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def audited(df: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, Observation]:
    """``df`` with a row count, and further metrics, taken while it is computed.

    Exact where no shuffle follows. Before a shuffle, rows of a task that had
    to be repeated may be counted again.
    """
    seen = Observation(name)
    extra = [c.alias(n) for n, c in metrics.items()]
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *extra), seen


def row_count(df: DataFrame, name: str = "n_rows") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def peek(df: DataFrame, n: int = 10) -> DataFrame:
    """Some rows for a look at the data; sort ``df`` first for a fixed choice."""
    return df.limit(n)
