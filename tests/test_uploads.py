from __future__ import annotations

import datetime as dt
import gzip
import json

import pytest
from pyspark.sql import functions as F

from sessionlake.contracts import GOLD, LINE
from sessionlake.plans import dashboard
from sessionlake.plans.batch import refine, run_upload, upload_handler
from sessionlake.sources.files import list_files, read_csv, read_text, union_shards
from sessionlake.sources.uploads import has_partition, next_date, next_day, pending_dates, ready_uploads
from sessionlake.sources.warehouse import create_database, create_table, load_parquet, publish, reset_table
from sessionlake.sources.zones import read_day, read_zone, write_zone
from sessionlake.streaming.uploads import (
    marker_stream, notification_stream, ready_stream, start_on_ready, start_ready_log,
)
from sessionlake.workspace import exists, materialize, scratch, shared_root

DAY_ONE = "customer01/sessions/2017-06-01"


def upload(root, folder, *records, marker=True, name="data_000000000000.json"):
    path = root / folder
    path.mkdir(parents=True, exist_ok=True)
    body = "\n".join(r if isinstance(r, str) else json.dumps(r) for r in records) + "\n"
    if name.endswith("gzip"):
        (path / name).write_bytes(gzip.compress(body.encode()))
    else:
        (path / name).write_text(body)
    if marker:
        (path / "end_file.txt").write_text("DONE\n")


@pytest.fixture
def table(spark, tmp_path):
    name = "t" + tmp_path.name.replace("-", "_")
    create_database(spark, name, str(tmp_path / "warehouse"))
    create_table(spark, f"{name}.sessions", GOLD, "date", "it's by day", ("team", "web"))
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def test_upload_to_published_table_and_tile(spark, tmp_path, record, table):
    root, lake = tmp_path / "in", str(tmp_path / "lake")
    second = record | {"visitId": "2", "hits": [record["hits"][0]] * 2}
    geo = record["geoNetwork"] | {"country": "United States", "city": "Austin"}
    upload(root, DAY_ONE, record, second, record | {"visitId": "3", "hits": [], "geoNetwork": geo})
    seen = []
    for _ in range(2):
        refined = run_upload(spark, str(root), lake, f"{DAY_ONE}/end_file.txt", table, "sessions")
        seen.append(refined.counts)
    assert seen[0] == seen[1] == {
        "bronze": 3, "sessions": 3, "rejected": 0, "silver": 3, "gold": 3, "hits": 3, "with_hits": 2,
    }
    final = spark.table(f"{table}.sessions")
    assert final.count() == 3
    tile = dashboard.top_cities("United States", "June").rows(final).collect()
    assert [tuple(r) for r in tile] == [("Austin", 1)]
    assert [t.name for t in spark.catalog.listTables(table)] == ["sessions"]
    assert read_day(spark, refined.gold, dt.date(2017, 6, 1)).count() == 3
    assert refined.zone(spark, "bronze").select("customDimensions").collect()[0][0][0]["index"] == "2"


def test_table_definition(spark, table):
    described = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {table}.sessions").collect()}
    assert described["Comment"] == "it's by day" and "team=web" in described["Table Properties"]
    partitions = [c.name for c in spark.catalog.listColumns(f"{table}.sessions") if c.isPartition]
    assert partitions == ["upload", "date"]


def test_files_can_be_kept_small(spark, tmp_path):
    df = spark.sql("SELECT id, 2017 AS year, 6 AS month, 1 AS day FROM range(0, 100, 1, 4)")
    write_zone(df, str(tmp_path / "z"), max_records_per_file=30)
    assert len(list((tmp_path / "z").rglob("*.parquet"))) == 4
    write_zone(df, str(tmp_path / "one"))
    assert len(list((tmp_path / "one").rglob("*.parquet"))) == 1


def test_second_day_leaves_the_first_alone(spark, tmp_path, record, table):
    root, lake = tmp_path / "in", str(tmp_path / "lake")
    upload(root, DAY_ONE, record)
    day_two = DAY_ONE.replace("06-01", "06-02")
    upload(root, day_two, record | {"visitId": "9", "date": "20170602"}, name="data_000000000000.json.gzip")
    for folder in (DAY_ONE, day_two, DAY_ONE):
        run_upload(spark, str(root), lake, f"{folder}/end_file.txt", table, "sessions")
    final = spark.table(f"{table}.sessions")
    assert sorted((str(r.date), r.visitId) for r in final.collect()) == [
        ("2017-06-01", 1496300123), ("2017-06-02", 9),
    ]
    reset_table(spark, f"{table}.sessions")
    assert spark.table(f"{table}.sessions").count() == 0


def test_customers_and_late_sessions_stand_side_by_side(spark, tmp_path, record, table):
    root, lake = tmp_path / "in", str(tmp_path / "lake")
    other, late = DAY_ONE.replace("customer01", "customer02"), DAY_ONE.replace("06-01", "06-02")
    upload(root, DAY_ONE, *[record | {"visitId": str(i)} for i in range(5)])
    upload(root, other, record | {"visitId": "50"})
    upload(root, late, record | {"visitId": "60"}, record | {"visitId": "61", "date": "20170602"})
    for folder in (DAY_ONE, other, late, other):
        refined = run_upload(spark, str(root), lake, f"{folder}/end_file.txt", table, "sessions")
    final = spark.table(f"{table}.sessions")
    assert sorted(r.visitId for r in final.filter("date = DATE'2017-06-01'").collect()) == [0, 1, 2, 3, 4, 50, 60]
    assert refined.gold.endswith("gold/customer02/sessions")
    for zone in ("bronze", "silver", "gold"):
        assert spark.read.parquet(f"{lake}/{zone}/customer01/sessions").count() == 7
    # run again without a day, and then without a valid row
    for path in (root / late).iterdir():
        path.write_text(json.dumps(record | {"visitId": "62", "date": "20170602"}) + "\n")
    run_upload(spark, str(root), lake, f"{late}/end_file.txt", table, "sessions")
    assert sorted(r.visitId for r in spark.table(f"{table}.sessions").collect()) == [0, 1, 2, 3, 4, 50, 62]
    upload(root, late, "{broken", marker=False)
    assert run_upload(spark, str(root), lake, f"{late}/end_file.txt", table, "sessions").counts["rejected"] == 1
    assert sorted(r.visitId for r in spark.table(f"{table}.sessions").collect()) == [0, 1, 2, 3, 4, 50]
    assert spark.read.parquet(f"{lake}/gold/customer01/sessions").count() == 5


def test_letters_of_an_earlier_run_go(spark, tmp_path, record):
    upload(tmp_path / "in", DAY_ONE, record, "{broken")
    args = (spark, str(tmp_path / "in" / DAY_ONE), str(tmp_path / "lake"), "c", "e", "2017-06-01")
    assert exists(spark, refine(*args).rejected)
    upload(tmp_path / "in", DAY_ONE, record)
    done = refine(*args)
    assert done.counts["rejected"] == 0 and not exists(spark, done.rejected)


def test_every_field_of_a_line_survives_to_silver(spark, tmp_path, record):
    full = record | {"unforeseen": {"deep": [{"a": 1}, {"b": "x"}]}, "device": record["device"] | {"language": "tr"}}
    full["hits"] = [record["hits"][0] | {"social": {"network": "n"}, "customDimensions": [{"index": "1", "value": "v"}]}]
    upload(tmp_path / "in", DAY_ONE, full)
    done = refine(spark, str(tmp_path / "in" / DAY_ONE), str(tmp_path / "lake"), "c", "e", "2017-06-01")
    for zone in ("bronze", "silver"):
        assert json.loads(done.zone(spark, zone).collect()[0][LINE]) == full
    assert LINE not in done.zone(spark, "gold").columns


def test_publishing_needs_the_part_of_a_session(spark, tmp_path, table):
    spark.sql(f"CREATE TABLE {table}.bare (visitId bigint, upload string, date date) USING parquet PARTITIONED BY (upload, date)")
    with pytest.raises(ValueError, match="part"):
        publish(spark.sql("SELECT 1L AS visitId, 0 AS part, DATE'2017-06-01' AS date"), f"{table}.bare", "u")


def test_loaded_files_of_one_day_add_up(spark, tmp_path, record, table):
    empty = spark.table(f"{table}.sessions")
    for n in (1, 2):
        row = spark.createDataFrame([(n, dt.date(2017, 6, 1))], "visitId long, date date")
        both = empty.drop("visitId", "date").unionByName(row, allowMissingColumns=True).withColumn("part", F.lit(0))
        both.write.parquet(str(tmp_path / f"f{n}"))
    for n in (1, 2, 2):
        load_parquet(spark, str(tmp_path / f"f{n}"), f"{table}.sessions")
    assert sorted(r.visitId for r in spark.table(f"{table}.sessions").collect()) == [1, 2]


def test_days_between_those_of_an_upload_are_left_alone(spark, tmp_path, record):
    lake = str(tmp_path / "lake")
    for folder, dates in (("a", ["20170602"]), ("b", ["20170601", "20170603"])):
        upload(tmp_path / "in", folder, *[record | {"date": d} for d in dates])
        refined = refine(spark, str(tmp_path / "in" / folder), lake, "c", "e", folder)
        assert {refined.counts[n] for n in ("bronze", "silver", "gold")} == {len(dates)}
    assert refined.days == [dt.date(2017, 6, 1), dt.date(2017, 6, 3)]
    assert refined.zone(spark, "gold").count() == 2
    assert spark.read.parquet(refined.gold).count() == 3


def test_rejected_rows_are_set_aside(spark, tmp_path, record):
    upload(tmp_path / "in", DAY_ONE, record, record | {"date": "bad"}, "{broken", record | {"date": None})
    refined = refine(spark, str(tmp_path / "in" / DAY_ONE), str(tmp_path / "lake"), "c", "e", "2017-06-01")
    assert refined.counts["bronze"] == 1 and refined.counts["rejected"] == 3
    bad = spark.read.json(refined.rejected)
    assert sorted(r._reasons for r in bad.collect()) == [["date"], ["date"], ["json", "date"]]


def test_upload_of_bad_rows_only(spark, tmp_path, record, table):
    upload(tmp_path / "in", DAY_ONE, "{broken", record | {"date": "bad"})
    refined = run_upload(
        spark, str(tmp_path / "in"), str(tmp_path / "lake"), f"{DAY_ONE}/end_file.txt", table, "sessions"
    )
    assert refined.days == [] and refined.counts == {"bronze": 0, "sessions": 0, "rejected": 2}
    assert spark.table(f"{table}.sessions").count() == 0


def test_marker_must_be_one(spark, tmp_path):
    with pytest.raises(ValueError):
        run_upload(spark, "in", "lake", "customer01/sessions/2017-06-01/data.json", "d", "t")


def test_only_complete_uploads_are_ready(spark, tmp_path, record):
    upload(tmp_path, DAY_ONE, record)
    upload(tmp_path, DAY_ONE.replace("06-01", "06-02"), record, marker=False)
    ready = ready_uploads(list_files(spark, str(tmp_path))).collect()
    assert [(r.customer, r.entity, r.upload_date, r.data_files) for r in ready] == [
        ("customer01", "sessions", dt.date(2017, 6, 1), 1)
    ]


def test_marker_stream_starts_the_flow_once_per_upload(spark, tmp_path, record):
    root = tmp_path / "in"
    upload(root, DAY_ONE, record)
    upload(root, DAY_ONE.replace("06-01", "06-02"), record, marker=False)
    calls = []

    def run():
        stream = marker_stream(spark, str(root), max_files=1)
        start_on_ready(stream, calls.extend, str(tmp_path / "check"), once=True).awaitTermination()

    run()
    upload(root, DAY_ONE.replace("06-01", "06-03"), record)
    run()
    assert calls == [f"{DAY_ONE}/end_file.txt", f"{DAY_ONE.replace('06-01', '06-03')}/end_file.txt"]


@pytest.mark.parametrize("kind", ["markers", "notifications"])
def test_from_marker_file_to_published_table(spark, tmp_path, record, table, kind):
    root = tmp_path / "in"
    for day in ("01", "02"):
        upload(root, DAY_ONE.replace("06-01", f"06-{day}"), record | {"visitId": day, "date": f"201706{day}"})
    if kind == "markers":
        stream = marker_stream(spark, str(root))
    else:
        (tmp_path / "n").mkdir()
        names = [f"{DAY_ONE}/data_0.json", f"{DAY_ONE}/end_file.txt", f"{DAY_ONE.replace('06-01', '06-02')}/end_file.txt"]
        (tmp_path / "n" / "a.json").write_text("\n".join(json.dumps({"bucket": "b", "name": n}) for n in names))
        stream = ready_stream(notification_stream(spark, str(tmp_path / "n")))
    run = upload_handler(spark, str(root), str(tmp_path / "lake"), table, "sessions")
    start_on_ready(stream, run, str(tmp_path / "check"), once=True).awaitTermination()
    assert sorted(r.visitId for r in spark.table(f"{table}.sessions").collect()) == [1, 2]


def test_notifications(spark, tmp_path):
    folder = tmp_path / "n"
    folder.mkdir()
    names = [f"{DAY_ONE}/data_0.json", f"{DAY_ONE}/end_file.txt"]
    (folder / "a.json").write_text("\n".join(json.dumps({"bucket": "b", "name": n}) for n in names))
    ready = ready_stream(notification_stream(spark, str(folder)))
    start_ready_log(ready, str(tmp_path / "out"), str(tmp_path / "check"), once=True).awaitTermination()
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    assert [(r.folder, r.upload_date) for r in rows] == [(DAY_ONE, dt.date(2017, 6, 1))]


def test_pending_and_next_date(spark):
    days = spark.sql("SELECT explode(sequence(DATE'2017-06-01', DATE'2017-06-03')) AS date")
    done = spark.sql("SELECT DATE'2017-06-01' AS date")
    assert sorted(r.date.day for r in pending_dates(days, done).collect()) == [2, 3]
    assert next_date(days, done).collect()[0][0] == dt.date(2017, 6, 2)
    assert next_date(days, days).collect()[0][0] is None
    assert has_partition(days, dt.date(2017, 6, 3)) and not has_partition(days, dt.date(2017, 6, 4))


def test_day_cursor():
    first = dt.date(2017, 6, 1)
    assert next_day(None, first) == first
    assert next_day(dt.date(2017, 6, 9), first) == dt.date(2017, 6, 10)
    assert next_day(dt.date(2017, 6, 30), first) == dt.date(2017, 7, 1)
    with pytest.raises(ValueError):
        next_day(dt.date(2017, 6, 30), first, dt.date(2017, 6, 30))


def test_rerun_replaces_only_its_days(spark, tmp_path):
    df = spark.sql("SELECT id, 2017 AS year, 6 AS month, CAST(1 + id % 3 AS int) AS day FROM range(9)")
    path = str(tmp_path / "z")
    write_zone(df, path)
    write_zone(df.filter("day = 2"), path)
    assert spark.read.parquet(path).count() == 9
    part = read_zone(spark, path, dt.date(2017, 6, 2), dt.date(2017, 6, 3))
    assert part.count() == 6
    scan = part._jdf.queryExecution().executedPlan().toString()
    assert "day" in scan.split("PartitionFilters")[1].split("]")[0]


def test_a_day_too_big_for_one_task_is_split(spark, tmp_path):
    """Nearly all rows fall on one day; adaptive execution writes it from several tasks."""
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "256k")
    try:
        df = spark.range(0, 400000, 1, 8).selectExpr(
            "uuid() AS v", "2017 AS year", "6 AS month", "CAST(IF(id % 100 = 0, 2, 1) AS int) AS day"
        )
        write_zone(df, str(tmp_path / "z"))
    finally:
        spark.conf.set(key, before)
    assert len(list((tmp_path / "z").glob("year=2017/month=6/day=1/*.parquet"))) > 3
    assert spark.read.parquet(str(tmp_path / "z")).count() == 400000


def test_shards_with_and_without_a_struct(spark):
    a = spark.sql("SELECT 1 AS id, named_struct('x', 1) AS t")
    b = spark.sql("SELECT 2 AS id")
    assert sorted((r.id, r.t) for r in union_shards([a, b]).collect())[1] == (2, None)


def test_csv_and_text(spark, tmp_path):
    (tmp_path / "c.csv").write_text("CustomerId,CustomerName\n1,Zeta\n2,Acme\n")
    rows = read_csv(spark, str(tmp_path / "c.csv"), "CustomerId int, CustomerName string").collect()
    assert [tuple(r) for r in rows] == [(1, "Zeta"), (2, "Acme")]
    assert read_text(spark, str(tmp_path / "c.csv")).count() == 3


def test_workspace(spark):
    one, two = scratch(spark, "x"), scratch(spark, "x")
    assert one != two and one.startswith(shared_root(spark))
    df = materialize(spark.range(3).select("id", F.lit(None).cast("string").alias("n")), "t")
    assert df.count() == 3 and df.dtypes == [("id", "bigint"), ("n", "string")]
    assert not exists(spark, one)
