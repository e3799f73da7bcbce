"""The shared folder for tables that a job writes and reads again."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_dirs: list[tempfile.TemporaryDirectory] = []


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if not _local_dirs:
        _local_dirs.append(tempfile.TemporaryDirectory(prefix="sessionlake-"))
    return _local_dirs[0].name


def scratch(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder; never handed out twice."""
    app = spark.sparkContext.applicationId
    return f"{shared_root(spark)}/sessionlake-{app}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage in a way that survives lost executors, and gives the
    planner the real size of the result.
    """
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _file_system(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    """True if a file or folder is there, on any file system Spark can reach."""
    fs, p = _file_system(spark, path)
    return fs.exists(p)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that the caller wrote; nothing happens if it is not there."""
    fs, p = _file_system(spark, path)
    fs.delete(p, True)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders right below ``path``; none if it is not there."""
    fs, p = _file_system(spark, path)
    if not fs.exists(p):
        return []
    return [f.getPath().getName() for f in fs.listStatus(p) if f.isDirectory()]


def child_paths(spark: SparkSession, path: str) -> list[str]:
    """Paths of the files and folders right below ``path``; none if it is not there."""
    fs, p = _file_system(spark, path)
    return [f.getPath().toString() for f in fs.listStatus(p)] if fs.exists(p) else []


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file whole, unless there is one: then nothing happens and False comes back.

    The content goes to a file of its own first, which then gets the name if no
    other has it. Needs a file system whose rename refuses a name that is taken.
    """
    fs, p = _file_system(spark, path)
    if fs.exists(p):
        return False
    own = p.suffix(f".{uuid.uuid4().hex}.tmp")
    out = fs.create(own, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    made = not fs.exists(p) and fs.rename(own, p)
    if not made:
        fs.delete(own, False)
    return made


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file in place of the one that may be there."""
    fs, p = _file_system(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    """The content of a small file."""
    fs, p = _file_system(spark, path)
    source = fs.open(p)
    try:
        return bytes(source.readAllBytes()).decode()
    finally:
        source.close()


def size_of(spark: SparkSession, path: str) -> int:
    """Bytes of a file or of all files below a folder; 0 if it is not there."""
    fs, p = _file_system(spark, path)
    return fs.getContentSummary(p).getLength() if fs.exists(p) else 0


def clear(spark: SparkSession) -> None:
    """Remove what this application wrote below the shared folder, and its databases.

    For the end of a job: frames that read such tables cannot be used after it.
    """
    root = f"{shared_root(spark)}/sessionlake-{spark.sparkContext.applicationId}"
    for database in spark.catalog.listDatabases():
        if f"/sessionlake-{spark.sparkContext.applicationId}/" in (database.locationUri or ""):
            spark.sql(f"DROP DATABASE `{database.name}` CASCADE")
    remove(spark, root)


def fingerprint(spark: SparkSession, path: str) -> str:
    """Size and time of a file or folder; changes when it is written anew."""
    fs, p = _file_system(spark, path)
    return f"{fs.getContentSummary(p).getLength()}-{fs.getFileStatus(p).getModificationTime()}"
