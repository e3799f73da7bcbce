"""A table as versions of a set of Parquet files: appends, compaction, clustering and pruning.

Files are never changed. A version is a marker file that is created if it is
not there yet, and names a list of the files it adds and removes. Readers take
the versions that have markers, so they see the old set until the new one is
there, and a run that broke off has changed nothing.

    data/load=<id>/<partitions>/*.parquet    rows
    lists/<id>/*.parquet                     files that a version adds or removes, with their size and ranges
    versions/<n>                             the marker
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from sessionlake.operators.curve import with_curve
from sessionlake.workspace import child_paths, create_once, read_text, remove

#: Bytes of a file that compaction and clustering aim at.
TARGET_BYTES = 256 << 20

#: Share of the target below which a file is small.
SMALL_SHARE = 0.5

#: Versions after which the whole list is written anew, so that a reader opens few lists.
FULL_EVERY = 50

#: Columns of a list besides the ranges.
LISTED = "file string, folder string, bytes long, n_rows long, added boolean"


class Conflict(Exception):
    """Another writer has removed a file that this one has rewritten."""


@dataclass(frozen=True)
class Marker:
    """What a version says: its list, whether that is the whole set, and who asked for it."""

    number: int
    files: str
    full: bool
    tag: str


class FileSet:
    """A versioned set of Parquet files below ``root``.

    ``by`` are partition columns, ``ranges`` expressions by name whose least and
    greatest value each file's entry keeps.
    """

    def __init__(
        self, spark: SparkSession, root: str, schema: StructType, by: list[str] | None = None,
        ranges: Mapping[str, Column] | None = None,
    ) -> None:
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema
        self.by, self.ranges = list(by or []), dict(ranges or {})

    # versions

    def _at(self, *parts: object) -> str:
        return "/".join([self.root, *map(str, parts)])

    def versions(self) -> list[Marker]:
        """All committed versions in order."""
        paths = child_paths(self.spark, self._at("versions"))
        numbers = sorted(int(p.rpartition("/")[2]) for p in paths if p.rpartition("/")[2].isdigit())
        return [Marker(**json.loads(read_text(self.spark, self._at("versions", n)))) for n in numbers]

    def _list_schema(self) -> StructType:
        shown = self.spark.createDataFrame([], self.schema).select(
            *[f(c).alias(f"{side}_{n}") for n, c in self.ranges.items() for f, side in ((F.min, "low"), (F.max, "high"))]
        ) if self.ranges else None
        fields = StructType.fromDDL(LISTED).fields
        return StructType([*fields, *(shown.schema.fields if shown is not None else [])])

    def _lists(self, markers: list[Marker]) -> DataFrame:
        schema = self._list_schema()
        if not markers:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[self._at("lists", m.files) for m in markers])

    def files(self, version: int | None = None) -> DataFrame:
        """The files of a version, the latest unless one is named, with size, rows and ranges."""
        markers = [m for m in self.versions() if version is None or m.number <= version]
        last_full = max((i for i, m in enumerate(markers) if m.full), default=0)
        listed = self._lists(markers[last_full:])
        gone = listed.where("NOT added").select("file")
        return listed.where("added").join(gone, "file", "left_anti").drop("added")

    def _commit(self, files: DataFrame, removed: DataFrame | None, tag: str, seen: int) -> int | None:
        """Add a version that adds ``files`` and removes ``removed``; None if ``tag`` has one already.

        ``seen`` is the version that the writer has read.
        """
        added = files.withColumn("added", F.lit(True))
        listed = added if removed is None else added.unionByName(
            removed.select("file", F.lit(False).alias("added")), allowMissingColumns=True
        )
        name = uuid.uuid4().hex
        listed.coalesce(1).write.parquet(self._at("lists", name))
        while True:
            markers = self.versions()
            if tag and any(m.tag == tag for m in markers):
                return None
            newer = [m for m in markers if m.number > seen]
            if removed is not None and newer:
                lost = self._lists(newer).where("NOT added").join(removed.select("file"), "file", "left_semi")
                if not lost.isEmpty() or any(m.full for m in newer):
                    raise Conflict(f"files of version {seen} have been rewritten since")
            number = (markers[-1].number if markers else 0) + 1
            if self._mark(Marker(number, name, False, tag)):
                break
        if number % FULL_EVERY == 0:
            self._write_full()
        return number

    def _mark(self, marker: Marker) -> bool:
        return create_once(self.spark, self._at("versions", marker.number), json.dumps(asdict(marker)))

    def _write_full(self) -> None:
        """A version that changes nothing and lists all files; given up if another writer is faster."""
        last, name = self.versions()[-1], uuid.uuid4().hex
        self.files(last.number).withColumn("added", F.lit(True)).write.parquet(self._at("lists", name))
        self._mark(Marker(last.number + 1, name, True, ""))

    # rows

    def _read(self, paths: list[str]) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        reader = self.spark.read.schema(self.schema).option("basePath", self._at("data"))
        return reader.parquet(*[self._at("data", p) for p in paths])

    def read(self, version: int | None = None, where: Mapping[str, tuple] | None = None) -> DataFrame:
        """The rows of a version; with ``where`` those between two values of each named range, bounds included.

        Only files whose ranges meet all of ``where`` are opened. A bound of
        None is open; rows with NULL are not between any values.
        """
        rows = self._read(self.chosen(version, where))
        for name, (low, high) in (where or {}).items():
            c = self.ranges[name]
            rows = rows.where(c.isNotNull())
            rows = rows if low is None else rows.where(c >= F.lit(low))
            rows = rows if high is None else rows.where(c <= F.lit(high))
        return rows.select(*self.schema.fieldNames())

    def chosen(self, version: int | None = None, where: Mapping[str, tuple] | None = None) -> list[str]:
        """The files that ``read`` opens."""
        files = self.files(version)
        for name, (low, high) in (where or {}).items():
            files = files.where(F.col(f"low_{name}").isNotNull())
            files = files if low is None else files.where(F.col(f"high_{name}") >= F.lit(low))
            files = files if high is None else files.where(F.col(f"low_{name}") <= F.lit(high))
        return sorted(r["file"] for r in files.select("file").collect())

    def _written(self, load: str) -> DataFrame:
        """The files of a load with their size, rows and ranges; reads the leaves of the ranges and no others."""
        rows = self._read([f"load={load}"])
        kept = [agg(c).alias(f"{side}_{n}") for n, c in self.ranges.items() for agg, side in ((F.min, "low"), (F.max, "high"))]
        # the names are cut out of the paths of files, not of rows
        found = rows.groupBy(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("bytes")).agg(
            F.count(F.lit(1)).alias("n_rows"), *kept
        )
        file = F.concat(F.lit(f"load={load}"), F.element_at(F.split("path", f"/data/load={load}", 2), 2))
        inside = F.regexp_replace(file, "/?[^/]*$", "")
        folder = F.regexp_replace(inside, "^load=[^/]*/?", "")
        return found.select(file.alias("file"), folder.alias("folder"), *[c for c in found.columns if c != "path"])

    def _store(self, rows: DataFrame) -> DataFrame:
        """Write a load and return its list."""
        load = uuid.uuid4().hex
        writer = rows.select(*self.schema.fieldNames()).write
        (writer.partitionBy(*self.by) if self.by else writer).parquet(self._at("data", f"load={load}"))
        return self._written(load)

    def append(self, rows: DataFrame, tag: str = "") -> int | None:
        """Add rows as a version. With a ``tag`` that a version already has, nothing happens."""
        if tag and any(m.tag == tag for m in self.versions()):
            return None
        return self._commit(self._store(rows), None, tag, 0) if not rows.isEmpty() else None

    # upkeep

    def plan(self, target: int = TARGET_BYTES, small: float = SMALL_SHARE, version: int | None = None) -> DataFrame:
        """(file, folder, bytes, bin): small files of a partition in bins of about ``target`` bytes.

        Made from the list alone. A bin has at least two files; a small file that
        would be alone in its bin is left as it is.
        """
        files = self.files(version).where(F.col("bytes") < small * target)
        in_order = Window.partitionBy("folder").orderBy("bytes", "file")
        before = F.sum("bytes").over(in_order) - F.col("bytes")
        dealt = files.select("file", "folder", "bytes", F.floor(before / target).alias("turn"))
        counted = dealt.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("folder", "turn")))
        return counted.where("n > 1").select("file", "folder", "bytes", "turn")

    def compact(self, target: int = TARGET_BYTES, small: float = SMALL_SHARE) -> int | None:
        """Write the small files of each bin as one; None if there are none. Other files are not read."""
        seen = self._last()
        plan = self.plan(target, small, seen)
        bins = plan.select("folder", "turn").distinct()
        numbers = {(r["folder"], r["turn"]): i for i, r in enumerate(bins.collect())}
        if not numbers:
            return None
        named = self.spark.createDataFrame([(*k, i) for k, i in numbers.items()], "folder string, turn long, bin int")
        dealt = plan.join(named, ["folder", "turn"]).select("file", "bin")
        files = sorted(r["file"] for r in dealt.select("file").collect())
        path = F.element_at(F.split(F.col("_metadata.file_path"), "/data/load=", 2), 2)
        rows = self._read(files).withColumn("_file", F.concat(F.lit("load="), path))
        joined = rows.join(dealt.withColumnRenamed("file", "_file"), "_file")
        # a bin is one task's work, so it becomes one file
        return self._commit(self._store(joined.repartitionById(len(numbers), "bin")), dealt.select("file"), "", seen)

    def cluster(self, columns: list[str], target: int = TARGET_BYTES, spread: Column | None = None) -> int | None:
        """Write all files anew, rows along a space-filling curve through the named ranges.

        Rows of a partition at the same place of the curve are dealt by
        ``spread``, a hash of the whole row unless it is given, so equal values
        of all columns do not go to one task.
        """
        seen = self._last()
        files = self.files(seen)
        total = files.agg(F.sum("bytes")).first()[0]
        if not total:
            return None
        rows = self.read(seen)
        placed = with_curve(rows, {c: self.ranges[c] for c in columns})
        placed = placed.withColumn("_spread", F.xxhash64(*rows.columns) if spread is None else spread)
        order = [*self.by, "_curve", "_spread"]
        dealt = placed.repartitionByRange(max(1, -(-total // target)), *order).sortWithinPartitions(*order)
        return self._commit(self._store(dealt), files.select("file"), "", seen)

    def _last(self) -> int:
        return max((m.number for m in self.versions()), default=0)

    def vacuum(self) -> list[str]:
        """Remove loads that no file of the latest version is in, and return them.

        For times without writers or readers of older versions: a load whose
        version has no marker yet looks like one that was left behind.
        """
        held = {r["load"] for r in self.files().select(F.substring_index("file", "/", 1).alias("load")).distinct().collect()}
        paths = child_paths(self.spark, self._at("data"))
        left = sorted(p for p in paths if p.rpartition("/")[2].startswith("load=") and p.rpartition("/")[2] not in held)
        for p in left:
            remove(self.spark, p)
        return [p.rpartition("/")[2] for p in left]


def start_append(
    stream: DataFrame, to: FileSet, checkpoint: str, name: str, once: bool = False,
    compact_after: int = 0, target: int = TARGET_BYTES, then: Callable[[int], object] | None = None,
) -> StreamingQuery:
    """Append each micro-batch to a file set, once however often it is repeated.

    ``name`` tells the streams that write to one set apart. After every
    ``compact_after`` batches the small files are compacted.
    """

    def batch(df: DataFrame, batch_id: int) -> None:
        to.append(df, f"{name}-{batch_id}")
        if compact_after and batch_id % compact_after == compact_after - 1:
            to.compact(target)
        if then is not None:
            then(batch_id)

    writer = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()

