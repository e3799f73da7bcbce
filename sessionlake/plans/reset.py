"""Take a customer out of the lake, and let its uploads begin at a time."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionlake.contracts import UPLOAD
from sessionlake.functions.paths import ZONES
from sessionlake.sources.warehouse import publish
from sessionlake.workspace import child_paths, exists, read_text, remove, write_text


def _cursor_folder(lake: str) -> str:
    return f"{lake.rstrip('/')}/cursors"


def seek(spark: SparkSession, lake: str, customer: str, to: dt.datetime) -> None:
    """Uploads of the customer that were written before ``to`` are not taken any more, by streams that start from now on."""
    write_text(spark, f"{_cursor_folder(lake)}/{customer}", to.astimezone(dt.UTC).isoformat())


def cursors(spark: SparkSession, lake: str) -> dict[str, dt.datetime]:
    """The time from which each customer's uploads are taken; none for customers that were never reset."""
    paths = [p for p in child_paths(spark, _cursor_folder(lake)) if not p.rpartition("/")[2].startswith(".")]
    return {p.rpartition("/")[2]: dt.datetime.fromisoformat(read_text(spark, p)) for p in paths}


def after_cursors(uploads: DataFrame, at: dict[str, dt.datetime], path: str = "path", written: str = "written") -> DataFrame:
    """The uploads of a batch or stream without those written before their customer's cursor."""
    customer = F.element_at(F.split(F.col(path), "/"), -4)
    keep = F.lit(True)
    for name, time in at.items():
        keep = keep & ~((customer == name) & (F.col(written) < F.lit(time)))
    return uploads.where(F.coalesce(keep, F.lit(True)))


def reset_customer(
    spark: SparkSession, lake: str, table: str, customer: str, to: dt.datetime | None = None, also: list[str] | None = None
) -> int:
    """Remove a customer's zones, rejected lines and rows of the final table, and what is below the paths ``also``.

    The cursor moves first, to now unless ``to`` names a time, so no stream that
    starts in between brings old uploads back. Other customers keep what they
    have. Returns the number of uploads taken out of the table; running it again
    changes nothing more.
    """
    if not customer or "/" in customer:
        raise ValueError(f"{customer!r} is not a customer")
    seek(spark, lake, customer, to or dt.datetime.now(dt.UTC))
    for folder in (*ZONES, "rejected"):
        remove(spark, f"{lake.rstrip('/')}/{folder}/{customer}")
    rows = spark.table(table)
    # partition values only; as many as the customer has sent uploads
    uploads = [r[0] for r in rows.where(F.col(UPLOAD).startswith(f"{customer}/")).select(UPLOAD).distinct().collect()]
    for upload in uploads:
        publish(spark.createDataFrame([], rows.schema), table, upload)
    for path in also or []:
        if exists(spark, path):
            remove(spark, path)
    return len(uploads)
