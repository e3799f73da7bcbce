"""Features of visitors as they were known at a day: nothing of that day or later goes in."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def daily(df: DataFrame, keys: list[str], day: Column, measures: Mapping[str, Column]) -> DataFrame:
    """Sums per key and day: ``n`` rows, and each measure. A key with very many rows is one row a task and day."""
    rows = df.select(*keys, day.alias("day"), *[c.alias(m) for m, c in measures.items()]).where("day IS NOT NULL")
    return rows.groupBy(*keys, "day").agg(F.count(F.lit(1)).alias("n"), *[F.sum(m).alias(m) for m in measures])


def features_asof(
    df: DataFrame, keys: list[str], day: Column, measures: Mapping[str, Column], spans: Mapping[str, int | None],
) -> DataFrame:
    """One row per key and day with rows: what was known about the key when the day began.

    Columns: the keys, ``day``, ``days_since`` the last day before (NULL at the
    first), and for each span ``n_<span>`` and ``<measure>_<span>``: rows and sums
    over that many days before the day, which is not among them, or over all
    with None. Zero where there was nothing. A row without a day is left out.

    Windows run over days of a key, of which there are no more than the data
    has days, however many rows the key has.
    """
    days = daily(df, keys, day, measures).withColumn("_day", F.unix_date("day"))
    per_key = Window.partitionBy(*keys).orderBy("_day")
    out = [(F.col("_day") - F.lag("_day").over(per_key)).alias("days_since")]
    for span, size in spans.items():
        before = per_key.rangeBetween(Window.unboundedPreceding if size is None else -size, -1)
        out += [F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_{span}") for c in ("n", *measures)]
    return days.select(*keys, "day", *out)


def with_features(df: DataFrame, features: DataFrame, keys: list[str], day: Column) -> DataFrame:
    """``df`` with the features of its key and day; adaptive execution splits the rows of a key that has very many."""
    named = features.select(*[F.col(k).alias(f"_f_{k}") for k in keys], F.col("day").alias("_f_day"), *[c for c in features.columns if c not in (*keys, "day")])
    same = [F.col(k).eqNullSafe(F.col(f"_f_{k}")) for k in keys]
    joined = df.withColumn("_own_day", day).join(named, [F.col("_own_day") == F.col("_f_day"), *same], "left")
    return joined.drop("_own_day", "_f_day", *[f"_f_{k}" for k in keys])
