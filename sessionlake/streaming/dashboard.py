"""A dashboard that follows a stream: windowed aggregates kept in state, and a table of their latest values."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from sessionlake.workspace import exists, folders, remove

#: Loads after which they are folded into one, so that a read opens few folders.
FOLD_LOADS = 50

#: The bounds of a window, as columns of the aggregate.
START, END = "window_start", "window_end"


def windowed(
    rows: DataFrame, time: str, size: str, by: list[str], measures: Mapping[str, Column],
    delay: str | None = None, unique: list[str] | None = None,
) -> DataFrame:
    """Measures per window of event time and group: of a stream with ``delay``, of a batch without.

    A stream's rows that come more than ``delay`` after the latest event time
    seen are dropped, and windows that old are no longer held. Of rows with
    equal ``unique`` one counts, as far apart as ``delay`` in a stream. Rows
    without a time are in no window.
    """
    rows = rows.where(F.col(time).isNotNull())
    if delay is not None:
        rows = rows.withWatermark(time, delay)
    if unique:
        rows = rows.dropDuplicates(unique) if delay is None else rows.dropDuplicatesWithinWatermark(unique)
    made = rows.groupBy(F.window(time, size).alias("w"), *by).agg(*[c.alias(n) for n, c in measures.items()])
    return made.select(F.col("w.start").alias(START), F.col("w.end").alias(END), *by, *measures)


class Latest:
    """The latest value of every key of an aggregate, from loads that replace what earlier ones said.

    A load is a folder named by its micro-batch, so a batch that is repeated
    writes the same folder. Corrections of a batch are loads of their own after
    it. Loads are folded into a base now and then; a batch that is in the base
    is not taken again. The folder belongs to one stream and its checkpoint.
    """

    def __init__(self, spark: SparkSession, root: str, schema: StructType, keys: list[str], fold_loads: int = FOLD_LOADS) -> None:
        self.spark, self.root, self.schema, self.keys, self.fold_loads = spark, root, schema, keys, fold_loads

    def _at(self, kind: str, number: tuple[int, int]) -> str:
        return f"{self.root}/{kind}/{number[0]}-{number[1]}"

    def _numbers(self, kind: str) -> list[tuple[int, int]]:
        """Complete folders of a kind: (batch, correction)."""
        names = [n for n in folders(self.spark, f"{self.root}/{kind}") if exists(self.spark, f"{self.root}/{kind}/{n}/_SUCCESS")]
        return sorted(tuple(map(int, n.split("-"))) for n in names)

    def _parts(self) -> tuple[tuple[int, int], list[tuple[int, int]]]:
        base = max(self._numbers("base"), default=(-1, 0))
        return base, [n for n in self._numbers("load") if n > base]

    def _write(self, rows: DataFrame, kind: str, number: tuple[int, int]) -> None:
        rows.select(*self.schema.fieldNames()).write.mode("overwrite").parquet(self._at(kind, number))

    def put(self, rows: DataFrame, batch_id: int) -> None:
        """Add what a micro-batch says; one that is in the base already changes nothing."""
        base, loads = self._parts()
        if (batch_id, 0) <= base:
            return
        self._write(rows, "load", (batch_id, 0))
        if len(set(loads) | {(batch_id, 0)}) >= self.fold_loads:
            self.fold()

    def correct(self, rows: DataFrame) -> None:
        """Replace the values of some keys for good; for keys that the stream no longer changes."""
        base, loads = self._parts()
        batch, fix = max([base, *loads])
        self._write(rows, "load", (max(batch, 0), fix + 1))

    def rows(self) -> DataFrame:
        """One row per key."""
        base, loads = self._parts()
        parts = ([("base", base)] if base[0] >= 0 else []) + [("load", n) for n in loads]
        if not parts:
            return self.spark.createDataFrame([], self.schema)
        order = {self._at(*p).rpartition("/" + p[0] + "/")[2] + "/" + p[0]: i for i, p in enumerate(parts)}
        read = self.spark.read.schema(self.schema).parquet(*[self._at(*p) for p in parts])
        found = F.element_at(F.split("_metadata.file_path", "/"), -2)
        kind = F.element_at(F.split("_metadata.file_path", "/"), -3)
        place = F.create_map(*[F.lit(x) for pair in order.items() for x in pair])[F.concat(found, F.lit("/"), kind)]
        values = [c for c in self.schema.fieldNames() if c not in self.keys]
        # one row per key and task before the shuffle
        last = read.groupBy(*self.keys).agg(F.max_by(F.struct(*values), place).alias("v"))
        return last.select(*[F.col(c) if c in self.keys else F.col(f"v.{c}").alias(c) for c in self.schema.fieldNames()])

    def fold(self) -> None:
        """Write base and loads as a new base, then remove them; one that broke off leaves them as they were."""
        base, loads = self._parts()
        if not loads:
            return
        self._write(self.rows(), "base", loads[-1])
        for kind, numbers in (("base", [base] if base[0] >= 0 else []), ("load", loads)):
            for n in numbers:
                remove(self.spark, self._at(kind, n))


def start_dashboard(aggregate: DataFrame, to: Latest, checkpoint: str, once: bool = False, every: str = "1 minute") -> StreamingQuery:
    """Keep ``to`` up to date with a streamed ``windowed`` aggregate: each micro-batch sends the groups that it changed."""
    writer = aggregate.writeStream.outputMode("update").foreachBatch(to.put).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if once else {"processingTime": every}
    return writer.trigger(**trigger).start()


def watermark(query: StreamingQuery) -> dt.datetime | None:
    """The event time before which the stream no longer holds windows; None before the first."""
    marks = [p.eventTime.get("watermark") for p in query.recentProgress if p.eventTime]
    found = max((m for m in marks if m), default=None)
    return dt.datetime.fromisoformat(found.replace("Z", "+00:00")) if found else None


def dropped_late(query: StreamingQuery) -> int:
    """Rows that came too late for the state, over the progress that the query remembers."""
    return sum(o.numRowsDroppedByWatermark for p in query.recentProgress for o in p.stateOperators)


def settle(aggregate: DataFrame, to: Latest, start: dt.datetime | None, end: dt.datetime) -> None:
    """Replace the windows from ``start`` that ended by ``end``, from a batch aggregate over all that is stored.

    For windows that the stream has let go (``end`` at most its watermark), where
    rows may have come too late. The stored rows are pruned by the caller.
    """
    closed = aggregate.where(F.col(END) <= F.lit(end))
    to.correct(closed if start is None else closed.where(F.col(START) >= F.lit(start)))
