"""Change files to a change log, replicas and dead letters."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType

from sessionlake.operators.cdc import ORDER, latest, route, split_valid, with_backfill
from sessionlake.workspace import exists, folders, remove, size_of

# File reads at a time and minutes between merges.
FILES_PER_TRIGGER = 30
MERGE_INTERVAL = "15 minutes"

#: Size of the loads, as a share of the base, at which they are folded into a new base.
FOLD_SHARE = 0.25

#: Loads at which they are folded whatever their size, so a read opens few folders.
FOLD_LOADS = 50

TARGET, LOAD, TABLE = "_target", "_load", "_metadata_table"


def change_stream(
    spark: SparkSession, path: str, schema: StructType, fmt: str = "avro",
    max_files: int = FILES_PER_TRIGGER,
) -> DataFrame:
    """New change files as they arrive. Avro needs the spark-avro package on the cluster."""
    reader = spark.readStream.format(fmt).schema(schema)
    return reader.option("maxFilesPerTrigger", max_files).load(path)


def start_log(
    changes: DataFrame, path: str, checkpoint: str, once: bool = False,
    template: str = "{_metadata_table}_log",
) -> StreamingQuery:
    """Append every change to the log of its table; each log is one partition."""
    writer = (
        route(changes, template).writeStream.format("parquet").partitionBy("_target")
        .option("path", path).option("checkpointLocation", checkpoint)
    )
    writer = writer.trigger(availableNow=True) if once else writer
    return writer.start()


class Replica:
    """The last change of every key of every source table: a base and the loads since.

    A merge writes the latest changes of its batch as one further load and
    leaves all other files alone. A read takes the latest of the loads, and the
    base rows whose key is in none of them. Loads that have become large beside
    the base are folded into a new one.

    A source table's replica is the partition that ``template`` names, so keys
    of two tables never meet. Taking the latest of stored and new changes can be
    repeated without harm, so batches need no record of what was applied:
    whatever a checkpoint, a backfill or a repeated batch brings is merged.
    Between changes of equal time and sequence the later load counts.
    Deleted keys stay as tombstones, hidden by ``rows``, so that a change that
    arrives late is still compared with the delete. One writer at a time.
    """

    def __init__(
        self, spark: SparkSession, path: str, schema: StructType, keys: list[str],
        template: str = "{_metadata_table}", fold_share: float = FOLD_SHARE, fold_loads: int = FOLD_LOADS,
    ):
        self.spark, self.path, self.template = spark, path.rstrip("/"), template
        self.keys, self.fold_share, self.fold_loads = keys, fold_share, fold_loads
        self.columns = schema.fieldNames()
        self.schema = StructType([*schema.fields, StructField(LOAD, LongType()), StructField(TARGET, StringType())])

    def _complete(self, kind: str) -> list[int]:
        """Numbers of the bases or loads that were written to their end."""
        found = [int(name) for name in folders(self.spark, f"{self.path}/{kind}")]
        return sorted(n for n in found if exists(self.spark, f"{self._at(kind, n)}/_SUCCESS"))

    def _at(self, kind: str, number: int) -> str:
        return f"{self.path}/{kind}/{number:012d}"

    def _parts(self) -> tuple[int, list[int]]:
        """The base, by the last load it holds (-1: none yet), and the loads after it."""
        base = max(self._complete("base"), default=-1)
        return base, [n for n in self._complete("load") if n > base]

    def _read(self, paths: list[str]) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return reduce(DataFrame.unionByName, [self.spark.read.schema(self.schema).parquet(p) for p in paths])

    def _latest(self, df: DataFrame) -> DataFrame:
        return latest(df, [TARGET, *self.keys], [*ORDER, LOAD]).select(*self.schema.fieldNames())

    def stored(self) -> DataFrame:
        """The last change of every key, deletes included."""
        base, loads = self._parts()
        old = self._read([self._at("base", base)] if base >= 0 else [])
        if not loads:
            return old
        new = self._latest(self._read([self._at("load", n) for n in loads]))
        # base rows without a newer change; where there is one, both are compared
        same = [F.col(f"o.{c}").eqNullSafe(F.col(f"n.{c}")) for c in (TARGET, *self.keys)]
        joined = old.alias("o").join(new.alias("n"), reduce(Column.__and__, same), "full")
        order = [F.struct(*[F.col(f"{side}.{c}") for c in (*ORDER, LOAD)]) for side in "on"]
        newer = F.col(f"o.{LOAD}").isNull() | (F.col(f"n.{LOAD}").isNotNull() & (order[1] >= order[0]))
        return joined.select(
            *[F.when(newer, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c) for c in self.schema.fieldNames()]
        )

    def rows(self, target: str | None = None) -> DataFrame:
        """A replica as its source has it, without the deleted keys; all of them if none is named."""
        alive = self.stored().filter(~F.col("_op").eqNullSafe("DELETE"))
        if target is not None:
            alive = alive.filter(F.col(TARGET) == target)
        return alive.select(*[c for c in self.columns if not c.startswith("_")])

    def backfill(self, snapshot: DataFrame, table: str) -> None:
        """Load a full copy of a source table; it precedes all changes, and a later copy an earlier one."""
        none = self.spark.createDataFrame([], StructType(self.schema.fields[:-2]))
        self.merge(with_backfill(snapshot, none, table))

    def merge(self, changes: DataFrame) -> None:
        """Add one batch; nothing that is stored is written again, unless the loads are folded."""
        base, loads = self._parts()
        number = max([base, *loads], default=-1) + 1
        routed = route(changes, self.template, TARGET).withColumn(LOAD, F.lit(number).cast("bigint"))
        self._latest(routed.select(*self.schema.fieldNames())).write.mode("overwrite").partitionBy(TARGET).parquet(
            self._at("load", number)
        )
        self._fold_if_large(base, [*loads, number])

    def _fold_if_large(self, base: int, loads: list[int]) -> None:
        held = size_of(self.spark, self._at("base", base)) if base >= 0 else 0
        new = sum(size_of(self.spark, self._at("load", n)) for n in loads)
        if len(loads) >= self.fold_loads or new > self.fold_share * held:
            self.fold()

    def fold(self) -> None:
        """Write base and loads as a new base, then remove them. A fold that broke off leaves them as they were."""
        base, loads = self._parts()
        if not loads:
            return
        self.stored().hint("rebalance", TARGET).write.mode("overwrite").partitionBy(TARGET).parquet(
            self._at("base", loads[-1])
        )
        for kind, numbers in (("base", [base]), ("load", loads)):
            for n in numbers:
                remove(self.spark, self._at(kind, n))


def start_merge(
    changes: DataFrame,
    replica: Replica,
    dead_letters: str,
    checkpoint: str,
    rules: Mapping[str, Column],
    every: str = MERGE_INTERVAL,
    once: bool = False,
) -> StreamingQuery:
    """Merge the valid changes into the replica and set the others aside.

    A batch is held while both parts are written, so its files are read once.
    """

    def batch(df: DataFrame, batch_id: int) -> None:
        held = df.persist()
        try:
            valid, rejected = split_valid(held, rules)
            rejected.write.mode("overwrite").json(f"{dead_letters}/batch_{batch_id}")
            replica.merge(valid)
        finally:
            held.unpersist()

    writer = changes.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if once else {"processingTime": every}
    return writer.trigger(**trigger).start()
