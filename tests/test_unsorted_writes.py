from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrameWriter

from sessionlake.plans.adapt import order_sessions
from sessionlake.session import unsorted_writes
from sessionlake.sources.zones import write_zone

KEY = "spark.sql.maxConcurrentOutputFileWriters"


def test_zones_are_written_without_a_sort(spark, tmp_path, monkeypatch):
    before, seen, parquet = spark.conf.get(KEY), [], DataFrameWriter.parquet

    def noted(self, path, *args, **options):
        seen.append(int(spark.conf.get(KEY)))
        return parquet(self, path, *args, **options)

    monkeypatch.setattr(DataFrameWriter, "parquet", noted)
    rows = spark.range(1000).selectExpr("id", "cast(id % 90 AS int) AS month", "2024 AS year")
    write_zone(rows.coalesce(1), str(tmp_path / "z"), by=["year", "month"], gather=False)
    assert seen[0] > 0 and spark.conf.get(KEY) == before
    # more partitions in a task than files may be open
    assert sorted(r["id"] for r in spark.read.parquet(str(tmp_path / "z")).collect()) == list(range(1000))


def test_no_sort_in_the_plan_of_a_partitioned_insert(spark, tmp_path):
    spark.sql(f"CREATE TABLE unsorted_t (id BIGINT, d DATE) USING parquet PARTITIONED BY (d) LOCATION '{tmp_path}/t'")
    spark.createDataFrame([(1, dt.date(2024, 1, 1))], "id long, d date").createOrReplaceTempView("unsorted_v")
    insert = "EXPLAIN INSERT OVERWRITE TABLE unsorted_t PARTITION (d) SELECT * FROM unsorted_v"
    try:
        assert "Sort [" in spark.sql(insert).first()[0]
        with unsorted_writes(spark):
            assert "Sort [" not in spark.sql(insert).first()[0]
    finally:
        spark.sql("DROP TABLE unsorted_t")


def test_sessions_gathered_by_month_are_the_same(spark):
    sf = "/root/testdata/sf0.001"
    plain, gathered = (order_sessions(spark, sf, by_month=by) for by in (False, True))
    assert plain.schema == gathered.schema
    assert plain.exceptAll(gathered).count() == 0 and plain.count() == gathered.count()
