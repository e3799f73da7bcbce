"""Map cells, policies, features as of a day, and the reset of a customer."""

from __future__ import annotations

import datetime as dt
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from sessionlake.contracts import GOLD
from sessionlake.operators import cells as c
from sessionlake.operators.asof import features_asof, with_features
from sessionlake.operators.policy import Policies
from sessionlake.plans import reset
from sessionlake.plans.batch import run_upload, upload_handler
from sessionlake.sources.warehouse import create_database, create_table
from sessionlake.streaming.uploads import marker_stream, start_on_ready
from tests.test_uploads import upload

# map cells


def test_cells_hold_few_and_every_row_is_in_one(spark):
    rng = random.Random(1)
    points = [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(300)]
    points += [(51.5 + rng.random() / 100, -0.1 + rng.random() / 100) for _ in range(300)] + [(10.0, 10.0)] * 60
    points += [(90.0, 180.0), (-90.0, -180.0)]
    rows = [(str(a), str(b)) for a, b in points] + [(None, "1"), ("x", "1"), ("91", "0"), ("0", "-181")]
    df = spark.createDataFrame(rows, "lat string, lon string")
    placed = c.with_place(df, F.col("lat"), F.col("lon"), 12)
    assert placed.where("x IS NULL").count() == 4
    drawn = c.cells(placed, 40, 12, ones=F.lit(1)).collect()
    assert sum(r["n"] for r in drawn) == len(points) and all(r["n"] == r["ones"] for r in drawn)
    assert all(r["n"] <= 40 or r["level"] == 12 for r in drawn) and max(r["n"] for r in drawn) >= 60
    fine = [(r["x"], r["y"]) for r in placed.where("x IS NOT NULL").collect()]
    inside = Counter()
    for x, y in fine:
        held = [(r["level"], r["x"], r["y"]) for r in drawn if (x >> 12 - r["level"], y >> 12 - r["level"]) == (r["x"], r["y"])]
        assert len(held) == 1
        inside[held[0]] += 1
    assert inside == {(r["level"], r["x"], r["y"]): r["n"] for r in drawn}
    # a cell is only split if it has too many
    for r in drawn:
        if r["level"]:
            up = sum((x >> 13 - r["level"], y >> 13 - r["level"]) == (r["x"] >> 1, r["y"] >> 1) for x, y in fine)
            assert up > 40


def test_few_rows_are_the_whole_map(spark):
    df = spark.createDataFrame([("1", "1")] * 3, "lat string, lon string")
    placed = c.with_place(df, F.col("lat"), F.col("lon"), 6)
    assert [tuple(r) for r in c.cells(placed, 3, 6).collect()] == [(0, 0, 0, 3)]
    assert c.cells(placed.where("false"), 3, 6).count() == 0
    edges = spark.createDataFrame([(1, 0, 1)], "level int, x long, y long").select(*[e.alias(n) for n, e in c.bounds(F.col("level"), F.col("x"), F.col("y")).items()])
    assert edges.first().asDict() == {"west": -180, "east": 0, "south": 0, "north": 90}


# policies

SESSIONS = "id long, year int, geo struct<country:string,city:string>, hits array<struct<page:string,buyer:struct<name:string,card:string>>>"


@pytest.fixture
def policies(spark):
    rows = spark.createDataFrame(
        [("ann", "geo.country", "NO"), ("ann", "geo.country", "SE"), ("ann", "year", "2017"), ("bob", "geo.country", "*"), ("bob", "year", "*"),
         ("cat", "geo.country", "NO"), ("dan", "year", "x"), ("dan", "geo.country", "*"), (None, None, None)],
        "principal string, path string, value string",
    )
    columns = spark.createDataFrame(
        [("ann", "id"), ("ann", "geo.country"), ("ann", "hits.page"), ("bob", "*"), ("cat", "*"), ("dan", "hits.buyer"), ("dan", "nothing")],
        "principal string, path string",
    )
    return Policies(rows, columns, ("year", "geo.country"))


@pytest.fixture
def sessions(spark):
    rng = random.Random(1)
    rows = [
        (i, rng.choice([2016, 2017, None]), None if i % 10 == 0 else (rng.choice(["NO", "SE", "DK", None]), "x"), [("p", ("n", "c"))] if i % 3 else None)
        for i in range(100)
    ]
    return spark.createDataFrame(rows, SESSIONS)


def test_rows_and_leaves_that_a_principal_sees(policies, sessions):
    ann = policies.view(sessions, "ann")
    want = {r["id"] for r in sessions.collect() if r["year"] == 2017 and r["geo"] and r["geo"]["country"] in ("NO", "SE")}
    assert {r["id"] for r in ann.collect()} == want and want
    assert ann.schema.simpleString() == "struct<id:bigint,geo:struct<country:string>,hits:array<struct<page:string>>>"
    bob = policies.view(sessions, "bob")
    assert bob.schema == sessions.schema and bob.count() == 100
    assert policies.view(sessions, "cat").count() == 0  # no grant for any year
    dan = policies.view(sessions, "dan")
    assert dan.schema.simpleString() == "struct<hits:array<struct<buyer:struct<name:string,card:string>>>>" and dan.count() == 0
    assert policies.view(sessions, "eve").columns == [] and policies.view(sessions, "eve").count() == 0


def test_many_values_become_a_join_with_the_same_rows(policies, sessions):
    few = Policies(policies.rows, policies.columns, policies.guarded, max_values=1)
    for who in ("ann", "bob", "cat", "dan"):
        assert sorted(map(repr, few.view(sessions, who).collect())) == sorted(map(repr, policies.view(sessions, who).collect()))


def test_partitions_and_leaves_are_pruned_for_each_principal(spark, policies, sessions, tmp_path):
    sessions.write.partitionBy("year").parquet(str(tmp_path / "s"))
    stored = spark.read.schema(sessions.schema).parquet(str(tmp_path / "s"))
    plan = policies.view(stored, "ann")._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters") :]
    assert "2017" in filters[: filters.index("PushedFilters")]
    assert "In(geo.country, [NO,SE])" in plan or "In(geo.country" in plan
    assert "city" not in plan[plan.index("ReadSchema") :] and "card" not in plan[plan.index("ReadSchema") :]
    assert "Join" not in plan and "Python" not in plan


# features


def test_features_as_by_a_loop_over_each_visitor(spark):
    rng = random.Random(4)
    start = dt.date(2024, 1, 1)
    rows = [(rng.choice(["a", "b", None]), start + dt.timedelta(days=rng.randrange(60)), rng.randint(-5, 50)) for _ in range(300)]
    rows += [("hot", start + dt.timedelta(days=i % 20), 1) for i in range(2000)] + [("a", None, 7), ("b", start, None)]
    df = spark.createDataFrame(rows, "who string, day date, v int")
    got = features_asof(df, ["who"], F.col("day"), {"v": F.col("v")}, {"w": 7, "all": None}).collect()
    by = defaultdict(list)
    for who, day, v in rows:
        if day is not None:
            by[who].append((day, v))
    want = set()
    for who, own in by.items():
        for day in {d for d, _ in own}:
            before = [(d, v) for d, v in own if d < day]
            week = [v for d, v in before if d >= day - dt.timedelta(days=7)]
            since = (day - max(d for d, _ in before)).days if before else None
            want.add((who, day, since, len(week), sum(v or 0 for v in week), len(before), sum(v or 0 for _, v in before)))
    assert {tuple(r) for r in got} == want and len(got) == len(want)
    joined = with_features(df, features_asof(df, ["who"], F.col("day"), {}, {"all": None}), ["who"], F.col("day"))
    assert joined.columns == [*df.columns, "days_since", "n_all"] and joined.count() == len(rows)
    assert joined.where("day IS NULL").first()["n_all"] is None and joined.where("who IS NULL AND n_all IS NULL").isEmpty()


# reset


@pytest.fixture
def table(spark, tmp_path):
    name = "r" + tmp_path.name.replace("-", "_")
    create_database(spark, name, str(tmp_path / "warehouse"))
    create_table(spark, f"{name}.sessions", GOLD)
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def test_a_customer_is_taken_out_and_old_uploads_stay_out(spark, tmp_path, record, table):
    root, lake = tmp_path / "in", str(tmp_path / "lake")
    for customer in ("customer01", "customer011", "customer02"):
        for day in ("2017-06-01", "2017-06-02"):
            upload(root, f"{customer}/sessions/{day}", record | {"date": day.replace("-", "")}, "{broken")
            run_upload(spark, str(root), lake, f"{customer}/sessions/{day}/end_file.txt", table, "sessions")
    (tmp_path / "replica").mkdir()
    assert reset.reset_customer(spark, lake, f"{table}.sessions", "customer01", also=[str(tmp_path / "replica"), str(tmp_path / "none")]) == 2
    assert not (tmp_path / "replica").exists()
    left = {r["upload"] for r in spark.table(f"{table}.sessions").select("upload").collect()}
    assert left == {f"{who}/sessions/{day}" for who in ("customer011", "customer02") for day in ("2017-06-01", "2017-06-02")}
    for zone in ("bronze", "silver", "gold", "rejected"):
        assert sorted(p.name for p in (tmp_path / "lake" / zone).iterdir()) == ["customer011", "customer02"]
    assert reset.reset_customer(spark, lake, f"{table}.sessions", "customer01", to=dt.datetime.now(dt.UTC)) == 0

    # a stream that starts anew finds the markers again, but takes later uploads only
    upload(root, "customer01/sessions/2017-06-03", record | {"date": "20170603"})
    handle = upload_handler(spark, str(root), lake, table, "sessions")
    taken = []
    markers = reset.after_cursors(marker_stream(spark, str(root)), reset.cursors(spark, lake))
    start_on_ready(markers, lambda paths: taken.extend(paths) or handle([p for p in paths if "customer01/" in p]), str(tmp_path / "c"), once=True).awaitTermination()
    assert sorted(p for p in taken if p.startswith("customer01/")) == ["customer01/sessions/2017-06-03/end_file.txt"]
    assert sum(p.startswith("customer02/") for p in taken) == 2
    found = {r["upload"] for r in spark.table(f"{table}.sessions").select("upload").collect()}
    assert {u for u in found if u.startswith("customer01/")} == {"customer01/sessions/2017-06-03"}
    with pytest.raises(ValueError):
        reset.reset_customer(spark, lake, f"{table}.sessions", "")
