"""Start work when an upload is complete."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sessionlake.contracts import MARKER, record
from sessionlake.functions.paths import is_marker, parse_upload_path, relative_marker, upload_folder

# The fields of a "file was written" notification that are used.
NOTIFICATION = record(bucket="string", name="string", timeCreated="string")


def notification_stream(spark: SparkSession, path: str, max_files: int = 30) -> DataFrame:
    """Notifications of written files, as NDJSON."""
    return (
        spark.readStream.schema(NOTIFICATION).option("maxFilesPerTrigger", max_files).json(path)
    )


def ready_stream(notifications: DataFrame) -> DataFrame:
    """The complete uploads among the notifications: those of an end marker, with its path."""
    name = F.col("name")
    return notifications.filter(is_marker(name)).select(
        relative_marker(name).alias("path"),
        upload_folder(name).alias("folder"),
        *[c.alias(n) for n, c in parse_upload_path(name).items() if n != "file"],
    )


def marker_stream(spark: SparkSession, root: str, max_files: int = 30) -> DataFrame:
    """The end markers below an ingestion folder by their path in it, at most ``max_files`` per trigger.

    Lists the folder at every trigger. Where the store sends notifications,
    ``notification_stream`` reads those instead. ``written`` is the marker's
    time, for ``plans.reset.after_cursors``.
    """
    return (
        spark.readStream.schema("value string")
        .option("pathGlobFilter", f"*{MARKER}")
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", max_files)
        .text(root)
        .select(
            relative_marker(F.col("_metadata.file_path")).alias("path"), F.col("_metadata.file_modification_time").alias("written")
        )
    )


def start_ready_log(ready: DataFrame, path: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Append the complete uploads to a table that the batch flow works off."""
    writer = ready.writeStream.format("parquet").option("path", path)
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def start_on_ready(
    markers: DataFrame, handle: Callable[[list[str]], object], checkpoint: str, once: bool = False
) -> StreamingQuery:
    """Call ``handle`` with the marker paths of each trigger, from ``marker_stream`` or ``ready_stream``.

    ``plans.batch.upload_handler`` makes one that runs the batch flow.

    A trigger brings at most the stream's ``max_files`` markers, so the list is
    short. A trigger that failed is repeated, so ``handle`` must be idempotent,
    as the batch flow is.
    """

    def batch(df: DataFrame, batch_id: int) -> None:
        paths = sorted(r.path for r in df.select("path").distinct().collect())
        if paths:
            handle(paths)

    writer = markers.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
