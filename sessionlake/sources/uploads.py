"""Which uploads are complete and which days are still to be loaded."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionlake.contracts import MARKER
from sessionlake.functions.paths import is_marker, parse_upload_path, upload_folder


def ready_uploads(files: DataFrame, path: str = "path") -> DataFrame:
    """Folders of a file list that hold the end marker, with their number of data files."""
    marker = is_marker(F.col(path))
    folders = (
        files.groupBy(upload_folder(F.col(path)).alias("folder"))
        .agg(F.bool_or(marker).alias("ready"), F.count_if(~marker).alias("data_files"))
        .filter("ready")
    )
    # concat keeps the shape parse_upload_path expects
    parts = parse_upload_path(F.concat("folder", F.lit("/" + MARKER)))
    return folders.select(
        "folder", "data_files", *[parts[c].alias(c) for c in ("customer", "entity", "upload_date")]
    )


def pending_dates(available: DataFrame, done: DataFrame, column: str = "date") -> DataFrame:
    """Available days that are not among the done ones."""
    return (
        available.select(column).distinct()
        .join(done.select(column).distinct(), column, "left_anti")
    )


def next_date(available: DataFrame, done: DataFrame, column: str = "date") -> DataFrame:
    """The first pending day in one row; NULL when nothing is pending."""
    return pending_dates(available, done, column).agg(F.min(column).alias(f"next_{column}"))


def next_day(last: dt.date | None, first: dt.date, end: dt.date | None = None) -> dt.date:
    """The day after the last uploaded one, in the range from ``first`` to ``end``."""
    day = first if last is None else last + dt.timedelta(days=1)
    if end is not None and day > end:
        raise ValueError("all days of the range are uploaded; reset the cursor")
    return day


def has_partition(df: DataFrame, day: dt.date, column: str = "date") -> bool:
    """True if any row of that day exists; reads at most one."""
    return not df.filter(F.col(column) == F.lit(day)).select(column).limit(1).isEmpty()


def present_days(df: DataFrame, days: DataFrame, column: str = "date") -> DataFrame:
    """``days`` with ``present``: whether ``df`` has rows of each, in one job."""
    found = df.select(column).distinct().withColumn("present", F.lit(True))
    return days.join(found, column, "left").withColumn("present", F.coalesce("present", F.lit(False)))
