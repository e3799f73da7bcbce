from __future__ import annotations

from pyspark.sql import functions as F

from sessionlake.operators import cluster, masking
from sessionlake.plans.adapt import gold
from sessionlake.plans.catalog import files
from sessionlake.workspace import size_of

SF = "/root/testdata/sf0.001"


def test_ndjson_is_written_compressed(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(files, "scratch", lambda spark, name: str(tmp_path / name))
    rows = files.scan_ndjson(spark, SF)
    made = [p for p in (tmp_path / "ndjson").iterdir() if p.suffix in (".json", ".gz")]
    assert made and all(p.name.endswith(".json.gz") for p in made)
    lines = spark.read.text(str(tmp_path / "ndjson"))
    assert size_of(spark, str(tmp_path / "ndjson")) * 4 < lines.agg(F.sum(F.octet_length("value"))).first()[0]
    assert rows.count() == lines.count()


def test_a_fit_holds_few_rows_a_task(spark, monkeypatch):
    monkeypatch.setattr(cluster, "TASK_ROWS", 50)
    columns = [F.col("id").alias(c) for c in cluster.NUMERIC_FEATURES] + [(F.col("id") % 7).cast("string").alias("kind")]
    df = spark.range(400).coalesce(1).select(*columns)
    model = cluster.fit_clusters(df, hash_size=8)
    sizes = model.stages[-1].summary.predictions.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    assert sum(sizes) == 400 and max(sizes) < 150


def test_leaves_of_some_paths_read_no_other_column(spark):
    paths = ["geoNetwork.city", "hits.page.pageTitle"]
    some = masking.leaves(gold(spark, SF), paths)
    every = masking.leaves(gold(spark, SF)).where(F.col("path").isin(*paths))
    assert some.exceptAll(every).count() == 0 and every.count() == some.count() > 0
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "pageTitle" in plan and "pagePath" not in plan and "fullVisitorId" not in plan
