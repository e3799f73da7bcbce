from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sessionlake.contracts import CHANGE_ENVELOPE, record
from sessionlake.operators.cdc import (
    apply_changes, high_watermark, latest, route, select_sources, since, split_valid, with_backfill,
)
from sessionlake.streaming.changes import Replica, change_stream, start_log, start_merge

SCHEMA = StructType([*CHANGE_ENVELOPE.fields, *record(id="long", name="string").fields])


def changes(spark, *rows):
    """Rows (op, ts second, seq, id, name) of the table ``emp``."""
    made = spark.createDataFrame(
        [("emp", op, f"2024-01-01 00:00:{t:02d}", seq, i, name) for op, t, seq, i, name in rows],
        "_metadata_table string, _op string, _ts string, _seq long, id long, name string",
    )
    return made.withColumn("_ts", F.col("_ts").cast("timestamp_ntz"))


def pairs(df):
    return sorted((r.id, r.name) for r in df.collect())


def test_latest_by_time_then_sequence(spark):
    df = changes(
        spark, ("INSERT", 1, 1, 1, "a"), ("UPDATE", 2, 3, 1, "c"), ("UPDATE", 2, 2, 1, "b"), ("INSERT", 1, 4, 2, "x")
    )
    assert pairs(latest(df, ["id"])) == [(1, "c"), (2, "x")]


def test_apply_inserts_updates_and_deletes(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id long, name string")
    df = changes(
        spark, ("UPDATE", 1, 1, 1, "A"), ("DELETE", 1, 2, 2, None), ("INSERT", 1, 3, 4, "d"),
        ("INSERT", 1, 4, 5, "e"), ("DELETE", 2, 5, 5, None), ("DELETE", 1, 6, 9, None),
    )
    assert pairs(apply_changes(base, df, ["id"])) == [(1, "A"), (3, "c"), (4, "d")]


def test_insert_after_delete_lives(spark):
    base = spark.createDataFrame([(1, "a")], "id long, name string")
    df = changes(spark, ("DELETE", 1, 1, 1, None), ("INSERT", 2, 2, 1, "again"))
    assert pairs(apply_changes(base, df, ["id"])) == [(1, "again")]


def test_small_change_files_are_broadcast_against_the_base(spark, tmp_path):
    base = spark.range(100000).selectExpr("id", "CAST(id AS string) AS name")
    changes(spark, ("UPDATE", 1, 1, 1, "A")).write.parquet(str(tmp_path / "c"))
    out = apply_changes(base, spark.read.parquet(str(tmp_path / "c")), ["id"])
    assert out.count() == 100000
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_backfill_comes_before_every_change(spark):
    snapshot = spark.createDataFrame([(1, "old"), (2, "only")], "id long, name string")
    both = with_backfill(snapshot, changes(spark, ("UPDATE", 0, 0, 1, "new")), "emp")
    assert pairs(latest(both, ["id"])) == [(1, "new"), (2, "only")]
    assert both.filter("_metadata_table = 'emp'").count() == 3


def test_split_valid_names_the_broken_rules(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (None, None)], "id long, name string")
    valid, bad = split_valid(df, {"key": F.col("id").isNotNull(), "name": F.col("name") != "zz"})
    assert pairs(valid) == [(1, "a")]
    assert sorted(r._reasons for r in bad.collect()) == [["key"], ["key", "name"]]


def test_route_select_since_watermark(spark):
    df = changes(spark, ("INSERT", 1, 1, 1, "a"), ("INSERT", 9, 2, 2, "b"))
    df = df.union(df.withColumn("_metadata_table", F.lit("dept")))
    assert {r._target for r in route(df, "x_{_metadata_table}_log").collect()} == {"x_emp_log", "x_dept_log"}
    assert select_sources(df, allow=["emp"]).count() == 2
    assert select_sources(df, reject=["emp"]).count() == 2
    assert select_sources(df).count() == 4
    assert since(df, "2024-01-01 00:00:05").count() == 2
    assert {(r[0], r[1]) for r in high_watermark(df, by="_metadata_table").collect()} == {("emp", 2), ("dept", 2)}
    assert high_watermark(df).collect()[0][0] == 2


def write_file(folder, name, *rows):
    folder.mkdir(exist_ok=True)
    lines = [
        json.dumps({
            "_metadata_table": "emp", "_op": op, "_ts": f"2024-01-01T00:00:{t:02d}", "_seq": seq, "id": i, "name": n,
        })
        for op, t, seq, i, n in rows
    ]
    (folder / name).write_text("\n".join(lines) + "\n")


def rules():
    return {"key": F.col("id").isNotNull(), "op": F.col("_op").isin("INSERT", "UPDATE", "DELETE")}


def run_merge(spark, tmp_path, replica):
    stream = change_stream(spark, str(tmp_path / "in"), SCHEMA, "json", max_files=1)
    start_merge(
        stream, replica, str(tmp_path / "dead"), str(tmp_path / "check"), rules(), once=True
    ).awaitTermination()


def test_stream_merge_equals_batch_and_restarts(spark, tmp_path):
    first = [("INSERT", 1, 1, 1, "a"), ("INSERT", 1, 2, 2, "b"), ("BAD", 1, 3, 3, "c"), ("INSERT", 1, 4, None, "d")]
    second = [("UPDATE", 2, 5, 1, "A"), ("DELETE", 3, 6, 2, None), ("INSERT", 3, 7, 4, "z")]
    late = [("UPDATE", 2, 8, 2, "late"), ("INSERT", 4, 9, 5, "y")]
    write_file(tmp_path / "in", "f1.json", *first)
    write_file(tmp_path / "in", "f2.json", *second)
    replica = Replica(spark, str(tmp_path / "replica"), SCHEMA, ["id"])
    run_merge(spark, tmp_path, replica)
    assert pairs(replica.rows()) == [(1, "A"), (4, "z")]

    write_file(tmp_path / "in", "f3.json", *late)
    again = Replica(spark, str(tmp_path / "replica"), SCHEMA, ["id"])
    run_merge(spark, tmp_path, again)
    # the late update of key 2 is older than its delete
    assert pairs(again.rows()) == [(1, "A"), (4, "z"), (5, "y")]

    valid, _ = split_valid(changes(spark, *first, *second, *late), rules())
    empty = spark.createDataFrame([], "id long, name string")
    assert pairs(apply_changes(empty, valid, ["id"])) == pairs(again.rows())
    dead = spark.read.option("recursiveFileLookup", True).json(str(tmp_path / "dead"))
    assert sorted(r._reasons for r in dead.collect()) == [["key"], ["op"]]


def test_repeated_batches_and_new_checkpoints_are_merged(spark, tmp_path):
    replica = Replica(spark, str(tmp_path / "r"), SCHEMA, ["id"])
    batch = changes(spark, ("INSERT", 1, 1, 1, "a"), ("INSERT", 1, 2, 2, "b"))
    replica.merge(batch)
    replica.merge(batch)
    assert pairs(replica.rows()) == [(1, "a"), (2, "b")]
    for check, name in (("one", "c"), ("two", "d")):  # both begin with batch 0
        write_file(tmp_path / check, "f.json", ("UPDATE", 2, 3 if check == "one" else 4, 1, name))
        stream = change_stream(spark, str(tmp_path / check), SCHEMA, "json")
        start_merge(stream, replica, str(tmp_path / "dead"), str(tmp_path / f"check_{check}"), rules(), once=True).awaitTermination()
    assert pairs(replica.rows()) == [(1, "d"), (2, "b")]


def test_a_merge_that_broke_off_changes_nothing(spark, tmp_path):
    replica = Replica(spark, str(tmp_path / "r"), SCHEMA, ["id"], fold_share=1e9)
    replica.merge(changes(spark, ("INSERT", 1, 1, 1, "a")))
    replica.merge(changes(spark, ("UPDATE", 2, 2, 1, "b")))
    (tmp_path / "r" / "load" / "000000000001" / "_SUCCESS").unlink()
    assert pairs(replica.rows()) == [(1, "a")]
    replica.merge(changes(spark, ("UPDATE", 2, 2, 1, "b")))
    replica.fold()
    assert pairs(replica.rows()) == [(1, "b")]


def test_a_merge_leaves_stored_files_alone(spark, tmp_path):
    replica = Replica(spark, str(tmp_path / "r"), SCHEMA, ["id"], fold_share=10)
    replica.merge(changes(spark, *[("INSERT", 1, i, i, "a") for i in range(50)]))
    replica.fold()
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "r").rglob("*.parquet")}
    replica.merge(changes(spark, ("UPDATE", 2, 99, 1, "b")))
    after = {p: p.stat().st_mtime_ns for p in (tmp_path / "r").rglob("*.parquet")}
    assert before.items() <= after.items() and replica.rows().count() == 50
    assert replica.rows().filter("name = 'b'").count() == 1


def test_loads_are_folded_once_they_are_large(spark, tmp_path):
    replica = Replica(spark, str(tmp_path / "r"), SCHEMA, ["id"], fold_share=1e9, fold_loads=3)
    for i in range(6):
        replica.merge(changes(spark, ("INSERT", i, i, i, "a"), ("DELETE", i, i, i - 2, None)))
    assert len(list((tmp_path / "r" / "base").iterdir())) == 1 and len(list((tmp_path / "r" / "load").iterdir())) == 2
    assert pairs(replica.rows()) == [(4, "a"), (5, "a")]


def test_tables_never_meet(spark, tmp_path):
    replica = Replica(spark, str(tmp_path / "r"), SCHEMA, ["id"], template="{_metadata_table}_replica")
    emp = changes(spark, ("INSERT", 1, 1, 1, "a"))
    replica.merge(emp.union(emp.withColumn("_metadata_table", F.lit("dept")).withColumn("name", F.lit("x"))))
    replica.merge(changes(spark, ("DELETE", 2, 2, 1, None)))
    assert pairs(replica.rows()) == [(1, "x")]
    assert pairs(replica.rows("dept_replica")) == [(1, "x")] and pairs(replica.rows("emp_replica")) == []


def test_ties_do_not_depend_on_the_order_of_rows(spark):
    rows = [("DELETE", 1, 1, 1, None), ("INSERT", 1, 1, 1, "a"), ("INSERT", 1, 1, 1, "b")]
    assert len({str(latest(changes(spark, *r), ["id"]).collect()) for r in (rows, rows[::-1], rows[1:] + rows[:1])}) == 1


def test_log_keeps_every_change(spark, tmp_path):
    write_file(tmp_path / "in", "f1.json", ("INSERT", 1, 1, 1, "a"))
    write_file(tmp_path / "in", "f2.json", ("UPDATE", 2, 2, 1, "b"), ("DELETE", 3, 3, 1, None))
    for _ in range(2):
        stream = change_stream(spark, str(tmp_path / "in"), SCHEMA, "json", max_files=1)
        start_log(stream, str(tmp_path / "log"), str(tmp_path / "check"), once=True).awaitTermination()
    log = spark.read.parquet(str(tmp_path / "log"))
    assert log.count() == 3 and {r._target for r in log.collect()} == {"emp_log"}


@pytest.mark.parametrize("hot", [2000])
def test_hot_key_in_a_batch(spark, tmp_path, hot):
    """Most changes of the batch are of one key."""
    replica = Replica(spark, str(tmp_path / "r"), SCHEMA, ["id"])
    df = spark.range(hot).selectExpr(
        "'emp' AS _metadata_table", "'UPDATE' AS _op", "TIMESTAMP_NTZ'2024-01-01 00:00:00' AS _ts",
        "id AS _seq", "CAST(7 AS long) AS id", "CAST(id AS string) AS name",
    )
    replica.merge(df)
    assert pairs(replica.rows()) == [(7, str(hot - 1))]


def test_backfill_then_stream(spark, tmp_path):
    replica = Replica(spark, str(tmp_path / "replica"), SCHEMA, ["id"])
    snapshot = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id long, name string")
    replica.backfill(snapshot, "emp")
    assert pairs(replica.rows()) == [(1, "a"), (2, "b"), (3, "c")]
    write_file(tmp_path / "in", "f1.json", ("UPDATE", 1, 1, 1, "A"), ("DELETE", 1, 2, 2, None))
    run_merge(spark, tmp_path, replica)
    assert pairs(replica.rows()) == [(1, "A"), (3, "c")]
    # a repeated load of the snapshot is older than the changes
    replica.backfill(snapshot, "emp")
    assert pairs(replica.rows()) == [(1, "A"), (3, "c")]
    # a second one takes the place of the first, but for what has changed since
    replica.backfill(spark.createDataFrame([(1, "q"), (3, "C"), (4, "d")], "id long, name string"), "emp")
    assert pairs(replica.rows()) == [(1, "A"), (3, "C"), (4, "d")]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_changes_against_a_replay_one_by_one(spark, seed):
    rng = random.Random(seed)
    base = {i: f"base{i}" for i in range(40)}
    rows = [
        (rng.choice(["INSERT", "UPDATE", "DELETE"]), rng.randrange(10), seq, rng.randrange(60), f"v{seq}")
        for seq in range(400)
    ]
    table = dict(base)
    for op, _, _, key, name in sorted(rows, key=lambda r: (r[1], r[2])):
        if op == "DELETE":
            table.pop(key, None)
        else:
            table[key] = name
    df = spark.createDataFrame(list(base.items()), "id long, name string")
    assert pairs(apply_changes(df, changes(spark, *rows), ["id"])) == sorted(table.items())


def test_batch_without_a_valid_change(spark, tmp_path):
    replica = Replica(spark, str(tmp_path / "r"), SCHEMA, ["id"])
    replica.merge(changes(spark, ("INSERT", 1, 1, 1, "a")))
    replica.merge(changes(spark, ("INSERT", 1, 1, 1, "a")).filter("id > 1"))
    assert pairs(replica.rows()) == [(1, "a")]
