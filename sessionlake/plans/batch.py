"""The batch flow: one upload through the zones into the final table."""

from __future__ import annotations

import datetime as dt
import sys
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from sessionlake.contracts import DAY, GOLD, LINE, LINE_FIELD, MARKER, PART, RAW, SILVER_TYPES, UPLOAD, read_schema
from sessionlake.functions.dates import parse_date, with_ymd, ymd
from sessionlake.functions.paths import staging_name_of, upload_name, zone_path
from sessionlake.operators.audit import audited
from sessionlake.operators.cdc import split_valid
from sessionlake.operators.cluster import features, fit_clusters, prepare
from sessionlake.operators.conform import conform, silver
from sessionlake.session import cluster_session
from sessionlake.sources.files import CORRUPT, read_sessions
from sessionlake.sources.warehouse import create_table, publish, stage, unstage
from sessionlake.sources.zones import write_zone
from sessionlake.workspace import remove


@dataclass(frozen=True)
class Refined:
    """The zones of a customer's entity, the upload in them, its days, and the sessions seen at each step."""

    bronze: str
    silver: str
    gold: str
    upload: str
    rejected: str
    days: list[dt.date]
    counts: dict[str, int]

    def path(self, name: str) -> str:
        """The upload's partition of a zone."""
        return f"{getattr(self, name)}/{UPLOAD}={self.upload}"

    def zone(self, spark: SparkSession, name: str, schema: StructType | None = None) -> DataFrame:
        """The upload's rows of one zone."""
        reader = spark.read.schema(schema) if schema is not None else spark.read
        return reader.parquet(self.path(name))


def _sessions(df: DataFrame) -> Column:
    """Number of sessions; further parts of a session do not count."""
    return F.count_if(F.col(PART) == 0 if PART in df.columns else F.lit(True))


def refine(
    spark: SparkSession,
    source: str | list[str],
    lake: str,
    customer: str,
    entity: str,
    upload: str,
    schema: StructType = RAW,
) -> Refined:
    """Raw session files of one upload to the bronze, silver and gold zones.

    Each zone holds an upload as a partition of its own, by day below that. A
    run replaces all the upload has there from an earlier run and nothing else.
    Bronze and silver keep the line of a session beside its parsed columns, so
    no field of the source is lost. Lines that are no JSON or have no date go
    to the rejected set. The files are parsed once, and again only if there is
    something to reject; silver and gold read the days just written to bronze,
    and of those only the leaves of their contract, without a shuffle. Counts
    are of sessions, not of rows, and are observed while writing.
    """
    zones = {z: zone_path(lake, z, customer, entity) for z in ("bronze", "silver", "gold")}
    rejected = f"{lake.rstrip('/')}/rejected/{customer}/{entity}/{upload}"
    counts: dict[str, int] = {}
    result = Refined(**zones, upload=upload, rejected=rejected, days=[], counts=counts)
    day = parse_date(F.col("date"))
    raw, read = audited(read_sessions(spark, source, schema, line=LINE), "read")
    rules = {"json": F.col(CORRUPT).isNull(), "date": day.isNotNull()}
    valid, bad = split_valid(raw, rules)
    rows = valid.drop(CORRUPT).select("*", *ymd(day))
    seen = write_zone(
        rows, result.path("bronze"), whole=True,
        metrics={"days": F.collect_set(day.cast("string")), "sessions": _sessions(rows)},
    )
    counts |= {"bronze": seen["sessions"], "sessions": seen["sessions"], "rejected": 0}
    remove(spark, rejected)
    # the rows read are never counted too low, so nothing is missed here
    if read.get["rows"] > seen["rows"]:
        letters, refused = audited(bad, "rejected")
        letters.write.mode("overwrite").json(rejected)
        counts["rejected"] = refused.get["rows"]
    result.days.extend(sorted(dt.date.fromisoformat(d) for d in seen["days"]))
    if not result.days:
        remove(spark, result.path("silver"))
        remove(spark, result.path("gold"))
        return result

    kept = [f for f in schema.fields if f.name == PART]
    stored = StructType([*schema.fields, LINE_FIELD, *_ymd_fields()])
    full = result.zone(spark, "bronze", stored)
    made = with_ymd(silver(full.drop(*DAY), SILVER_TYPES))
    seen = write_zone(made, result.path("silver"), gather=False, whole=True, metrics={"sessions": _sessions(made)})
    counts["silver"] = seen["sessions"]

    needed = StructType([*read_schema(schema, GOLD).fields, *kept, *_ymd_fields()])
    made = conform(
        result.zone(spark, "bronze", needed), GOLD, keep=[f.name for f in kept] + DAY
    )
    hits = F.when(F.col("hits").isNull(), 0).otherwise(F.size("hits"))
    first = F.col(PART) == 0 if kept else F.lit(True)
    seen = write_zone(
        made, result.path("gold"), gather=False, whole=True,
        metrics={"hits": F.sum(hits), "with_hits": F.count_if((hits > 0) & first), "sessions": _sessions(made)},
    )
    counts |= {"gold": seen["sessions"], "hits": seen["hits"], "with_hits": seen["with_hits"]}
    return result


def _ymd_fields() -> list[StructField]:
    return [StructField(c, IntegerType()) for c in DAY]


def publish_upload(spark: SparkSession, refined: Refined, marker: str, database: str, table: str) -> int:
    """Stage the gold rows of an upload, publish them and drop the staging table.

    Runs only after the gold zone is written, and gives the number of staged
    rows. An upload without rows takes those of its earlier runs away.
    """
    name, final = f"`{database}`.`{staging_name_of(marker)}`", f"`{database}`.`{table}`"
    if not refined.days:
        publish(spark.createDataFrame([], spark.table(final).schema), final, upload_name(marker))
        return 0
    unstage(spark, name)
    staged = stage(refined.zone(spark, "gold").drop(*DAY), name)
    n = staged.count()
    publish(staged, final, upload_name(marker))
    unstage(spark, name)
    return n


def run_upload(
    spark: SparkSession, ingestion: str, lake: str, marker: str, database: str, table: str,
    schema: StructType = RAW,
) -> Refined:
    """All steps for one complete upload ``customer/entity/yyyy-MM-dd/end_file.txt``."""
    if not marker.endswith("/" + MARKER):
        raise ValueError(f"{marker} is not an end marker")
    customer, entity, upload = marker.split("/")[-4:-1]
    folder = f"{ingestion.rstrip('/')}/{marker.removesuffix(MARKER)}"
    refined = refine(spark, folder, lake, customer, entity, upload, schema)
    publish_upload(spark, refined, marker, database, table)
    return refined


def upload_handler(spark: SparkSession, ingestion: str, lake: str, database: str, table: str) -> Callable[[list[str]], None]:
    """What the upload streams call: runs the flow for each marker ``customer/entity/day/end_file.txt``."""

    def run(markers: list[str]) -> None:
        for marker in markers:
            run_upload(spark, ingestion, lake, marker, database, table)

    return run


def model_sessions(
    raw: DataFrame, target: str, start: dt.date | None = None, end: dt.date | None = None,
    k: int = 4, seed: int = 1, model_path: str | None = None, **options: int,
) -> PipelineModel:
    """Flatten the sessions of the given days, write the feature table and fit the clusters on it.

    ``target`` is a table, or a folder if it has a slash. The model is kept at
    ``model_path`` and read again by ``PipelineModel.load``. ``options`` are
    those of ``fit_clusters``.
    """
    writer = features(raw, start, end).write.mode("overwrite")
    if "/" in target:
        writer.parquet(target)
        rows = raw.sparkSession.read.parquet(target)
    else:
        writer.saveAsTable(target)
        rows = raw.sparkSession.table(target)
    model = fit_clusters(rows, k, seed, **options)
    if model_path is not None:
        model.write().overwrite().save(model_path)
    return model


def assign_clusters(model: PipelineModel, rows: DataFrame) -> DataFrame:
    return model.transform(prepare(rows)).select(*rows.columns, "cluster")


def main(argv: list[str]) -> None:
    """Job form of ``run_upload``; creates the final table on the first run."""
    ingestion, lake, marker, database, table = argv
    spark = cluster_session("session upload")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    create_table(spark, f"`{database}`.`{table}`", GOLD, "date", "Sessions by day")
    print(run_upload(spark, ingestion, lake, marker, database, table).counts)


if __name__ == "__main__":
    main(sys.argv[1:])
