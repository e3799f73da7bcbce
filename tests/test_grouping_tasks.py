from __future__ import annotations

from pyspark.sql import functions as F

from sessionlake.contracts import GOLD, MONTH, PART, SESSION_KEY
from sessionlake.operators import skew
from sessionlake.operators.conform import conform
from sessionlake.operators.nested import nest, rejoin, renest
from sessionlake.plans import adapt
from sessionlake.sources.filesets import FileSet
from sessionlake.workspace import exists

SF = "/root/testdata/sf0.001"


def most_in_a_task(nested, column):
    sizes = nested.select(F.size(column).alias("n")).rdd.mapPartitions(lambda rows: [sum(r["n"] for r in rows)])
    return max(sizes.collect())


def test_tasks_group_a_bounded_number_of_items(spark, monkeypatch):
    items = spark.range(20_000).select((F.col("id") % 2000).alias("k"), "id")
    monkeypatch.setattr(skew, "TASK_ITEMS", 400)
    made = renest(items, ["k"], F.col("id"), "ids", F.col("id"), ["id"])
    assert made.count() == 2000 and most_in_a_task(made, "ids") < 1000
    made = nest(spark.range(2000).withColumnRenamed("id", "k"), items, ["k"], F.col("id"), "ids", F.col("id"), ["id"])
    assert made.filter(F.size("ids") == 10).count() == 2000


def test_rejoined_sessions_are_found_without_sorting_them(spark):
    sessions = adapt.with_row_id(adapt.gold(spark, SF).select(*SESSION_KEY, "hits"))
    plan = rejoin(sessions, ["_row"])._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan


def test_a_gold_zone_needs_no_bronze_zone(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(adapt, "_lakes", {})
    monkeypatch.setattr(adapt, "scratch", lambda spark, name: str(tmp_path / name))
    gold = adapt.gold(spark, SF)
    assert not exists(spark, str(tmp_path / "lake" / "bronze"))
    # and has the rows that a bronze zone would give
    again = conform(adapt.bronze(spark, SF), GOLD, keep=[PART, *MONTH])
    assert gold.schema.simpleString() == again.schema.simpleString()
    assert gold.count() == again.count() and gold.exceptAll(again).count() == 0


def test_files_of_a_load_are_named_once_a_file(spark, tmp_path):
    rows = spark.range(100).withColumn("d", F.col("id") % 3)
    files = FileSet(spark, str(tmp_path / "set"), rows.schema, by=["d"], ranges={"id": F.col("id")})
    listed = files._store(rows.repartition(2))
    assert listed.agg(F.sum("n_rows")).first()[0] == 100
    assert {r["folder"] for r in listed.collect()} == {"d=0", "d=1", "d=2"}
    plan = listed._jdf.queryExecution().optimizedPlan().toString()
    naming = [line.strip(" +-") for line in plan.splitlines() if "regexp_replace" in line]
    assert naming and all(line.startswith("Aggregate") for line in naming)
