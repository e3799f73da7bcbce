from __future__ import annotations

import copy
import datetime as dt
import json

from pyspark.sql import functions as F

from sessionlake.contracts import GOLD, RAW, SESSION_KEY, SILVER_TYPES, meets, read_schema, record as record_type
from sessionlake.operators.conform import cast_columns, conform, same_shape, silver
from sessionlake.operators.nested import (
    explode_hits, flatten, nest, pack, rejoin, renest, unpack, unwrap_list,
)
from sessionlake.operators.skew import hot_keys, with_part
from sessionlake.sources.files import CORRUPT, read_sessions


def write(tmp_path, *records, name="data_000.json"):
    lines = [r if isinstance(r, str) else json.dumps(r) for r in records]
    (tmp_path / name).write_text("\n".join(lines) + "\n")
    return str(tmp_path)


def test_golden_record(spark, tmp_path, record):
    df = conform(read_sessions(spark, write(tmp_path, record)), GOLD)
    assert meets(df.schema, GOLD)
    row = df.collect()[0]
    assert row.visitId == 1496300123
    assert row.date == dt.date(2017, 6, 1)
    assert row.totals.hits == 1 and row.totals.transactions is None
    assert row.trafficSource.isTrueDirect is None
    assert row.device.deviceCategory == "desktop"
    assert row.geoNetwork.city == "Bergen"
    assert row.channelGrouping == "Direct"
    assert len(row.hits) == 1 and row.hits[0].page.pagePath == "/home"
    leaves = df.select(F.explode("hits").alias("h")).select("h.transaction.*").collect()[0]
    assert len(leaves) == 6 and set(leaves) == {None}


def test_contract_has_44_leaves():
    def leaves(t):
        t = getattr(t, "elementType", t)
        return sum(leaves(f.dataType) for f in t.fields) if hasattr(t, "fields") else 1

    assert len(GOLD.fields) == 12
    assert leaves(GOLD) == 44


def test_transaction_fields_are_cast(spark, tmp_path, record):
    record["hits"][0]["transaction"] = {
        "affiliation": "a", "currencyCode": "EUR", "transactionId": "t1",
        "transactionRevenue": "2500000000", "transactionShipping": "5", "transactionTax": "x",
    }
    row = conform(read_sessions(spark, write(tmp_path, record)), GOLD).collect()[0]
    assert tuple(row.hits[0].transaction) == ("a", "EUR", "t1", 2500000000, 5, None)


def test_exit_and_interaction_are_not_mixed_up(spark, tmp_path, record):
    record["hits"][0] |= {"isExit": False, "isInteraction": True}
    hit = conform(read_sessions(spark, write(tmp_path, record)), GOLD).collect()[0].hits[0]
    assert (hit.isExit, hit.isInteraction) == (False, True)


def test_sessions_without_hits_or_key_are_kept(spark, tmp_path, record):
    empty, null, keyless = (copy.deepcopy(record) for _ in range(3))
    empty |= {"visitId": "2", "hits": []}
    null |= {"visitId": "3", "hits": None}
    keyless["visitId"] = None
    df = conform(read_sessions(spark, write(tmp_path, record, empty, null, keyless)), GOLD)
    sizes = {r.visitId: None if r.hits is None else len(r.hits) for r in df.collect()}
    assert sizes == {1496300123: 1, 2: 0, 3: None, None: 1}


def test_absent_struct_and_bad_values(spark, tmp_path, record):
    del record["totals"]
    record |= {"date": "bad", "visitNumber": "many"}
    df = read_sessions(spark, write(tmp_path, record))
    row = conform(df.drop("device"), GOLD).collect()[0]
    assert row.date is None and row.visitNumber is None
    assert set(row.totals.asDict().values()) == {None}
    assert set(row.device.asDict().values()) == {None}


def test_inferred_schema_conforms_too(spark, tmp_path, record):
    df = conform(spark.read.json(write(tmp_path, record)), GOLD)
    assert meets(df.schema, GOLD)
    assert df.collect()[0].hits[0].hitNumber == 1


def test_wrong_shape_becomes_null(spark):
    df = spark.sql("SELECT 'x' AS totals, 'y' AS hits, struct(1 AS a) AS visitId")
    row = conform(df, GOLD).collect()[0]
    assert row.hits is None and row.visitId is None and row.totals.hits is None


def test_no_shuffle_and_no_generate_in_the_default_path(spark, tmp_path, record):
    df = conform(read_sessions(spark, write(tmp_path, record)), GOLD)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Generate" not in plan


def test_read_schema_has_the_contract_shape():
    needed = read_schema(RAW, GOLD)
    assert needed.fieldNames() == GOLD.fieldNames()
    assert needed["trafficSource"].dataType.fieldNames() == GOLD["trafficSource"].dataType.fieldNames()
    assert same_shape(needed["hits"].dataType, GOLD["hits"].dataType)
    assert not same_shape(RAW["hits"].dataType, GOLD["hits"].dataType)


def test_cast_and_item_by_item_agree(spark, tmp_path, record):
    bad = copy.deepcopy(record) | {"visitId": "2"}
    bad["hits"][0] |= {"time": "soon", "transaction": {"transactionRevenue": "7"}, "page": None}
    path = write(tmp_path, record, bad, copy.deepcopy(record) | {"visitId": "3", "hits": None})
    shaped = conform(read_sessions(spark, path, read_schema(RAW, GOLD)), GOLD)
    general = conform(read_sessions(spark, path), GOLD)
    assert "transform" not in shaped._jdf.queryExecution().analyzed().toString()
    assert "transform" in general._jdf.queryExecution().analyzed().toString()
    assert shaped.exceptAll(general).isEmpty() and general.exceptAll(shaped).isEmpty()


def test_corrupt_lines_are_kept(spark, tmp_path, record):
    df = read_sessions(spark, write(tmp_path, record, "{not json"))
    assert df.filter(F.col(CORRUPT).isNotNull()).select(CORRUPT, "date").collect()[0][0] == "{not json"


def test_silver(spark, tmp_path, record):
    row = silver(read_sessions(spark, write(tmp_path, record)), SILVER_TYPES).collect()[0]
    assert (row.visitId, row.date) == (1496300123, dt.date(2017, 6, 1))
    assert row.totals.hits == "1" and row.customDimensions[0]["index"] == "2"


def test_cast_columns_keeps_the_rest(spark):
    df = cast_columns(spark.sql("SELECT '7' AS a, 'x' AS b, 'x' AS c"), {"a": "bigint", "b": "int", "z": "int"})
    assert df.dtypes == [("a", "bigint"), ("b", "int"), ("c", "string")]
    assert tuple(df.collect()[0]) == (7, None, "x")


def test_pack_unpack_flatten(spark):
    df = spark.sql("SELECT 1 AS a, 2 AS b, named_struct('x', 3, 'y', named_struct('z', 4)) AS s, array(1) AS l")
    packed = pack(df, "p", ["a", "b"])
    assert packed.columns == ["s", "l", "p"]
    assert unpack(packed, "p").columns == ["s", "l", "a", "b"]
    flat = flatten(df, "body_")
    assert flat.columns == ["body_a", "body_b", "body_s_x", "body_s_y_z", "body_l"]
    null = spark.sql("SELECT CAST(NULL AS struct<x: int>) AS s, 1 AS a")
    assert tuple(unpack(null, "s").collect()[0]) == (1, None)


def test_explode_inner_and_outer(spark):
    df = spark.createDataFrame([(1, ["a", "b"]), (2, []), (3, None)], "id int, hits array<string>")
    inner = sorted(map(tuple, explode_hits(df, outer=False).collect()))
    assert inner == [(1, "a"), (1, "b")]
    outer = {(r.id, r.hits) for r in explode_hits(df).collect()}
    assert outer == {(1, "a"), (1, "b"), (2, None), (3, None)}


def test_unwrap_list(spark):
    df = spark.sql("SELECT named_struct('list', array(named_struct('element', 1), named_struct('element', 2))) AS h")
    assert df.select(unwrap_list(F.col("h")).alias("h")).collect()[0].h == [1, 2]


def test_renest_sorts_by_number_then_item(spark):
    rows = [(1, 2, "b"), (1, 1, "z"), (1, 2, "a"), (2, 1, "c"), (None, 5, "n")]
    df = spark.createDataFrame(rows, "k int, n int, v string")
    out = renest(df, ["k"], F.struct("n", "v"), "hits", F.col("n"), ["n", "v"])
    got = {r.k: [h.v for h in r.hits] for r in out.collect()}
    assert got == {1: ["z", "a", "b"], 2: ["c"], None: ["n"]}
    assert {r.part for r in out.collect()} == {0}


def test_hot_key_spreads_over_parts(spark):
    """A third of all rows have one key, and half of those are copies of one item."""
    rows = [(0, i, "same" if i % 2 else f"v{i}") for i in range(5000)]
    rows += [(1 + i % 500, 5000 + i, "x") for i in range(10000)]
    df = spark.createDataFrame(rows, "k int, id int, v string")
    hot = hot_keys(df, ["k"], part_items=1000)
    assert [tuple(r) for r in hot.collect()] == [(0, 5000, 5)]
    out = renest(df, ["k"], F.col("v"), "vs", F.col("v"), ["id"], hot=hot).collect()
    parts = {r.part: len(r.vs) for r in out if r.k == 0}
    assert sorted(parts) == [0, 1, 2, 3, 4]
    assert sum(parts.values()) == 5000 and max(parts.values()) < 1300
    assert all(r.part == 0 and len(r.vs) == 20 for r in out if r.k != 0)
    assert sorted(v for r in out if r.k == 0 for v in r.vs) == sorted(v for k, _, v in rows if k == 0)


def test_parts_do_not_depend_on_row_order(spark):
    df = spark.range(4000).selectExpr("0 AS k", "id")
    hot = hot_keys(df, ["k"], part_items=1000)
    one = {r.id: r.part for r in with_part(df, hot, ["k"], ["id"]).collect()}
    two = {r.id: r.part for r in with_part(df.orderBy(F.desc("id")), hot, ["k"], ["id"]).collect()}
    assert one == two


def test_hot_null_key(spark):
    df = spark.range(3000).selectExpr("CAST(NULL AS int) AS k", "id")
    out = renest(df, ["k"], F.col("id"), "ids", F.col("id"), ["id"], part_items=1000).collect()
    assert sorted(r.part for r in out) == [0, 1, 2]
    assert sorted(i for r in out for i in r.ids) == list(range(3000))


def test_nest_keeps_roots_without_items_and_counts_all_parts(spark):
    roots = spark.createDataFrame([(0, "hot"), (1, "small"), (2, "none")], "k int, name string")
    items = spark.range(3001).selectExpr("CAST(IF(id < 3000, 0, 1) AS int) AS k", "id")
    out = nest(roots, items, ["k"], F.col("id"), "ids", F.col("id"), ["id"], part_items=1000).collect()
    assert sorted((r.k, r.part) for r in out) == [(0, 0), (0, 1), (0, 2), (1, 0), (2, 0)]
    assert {(r.name, r.n_items) for r in out} == {("hot", 3000), ("small", 1), ("none", 0)}
    assert sorted(i for r in out if r.k == 0 for i in r.ids) == list(range(3000))


def test_nest_matches_null_with_null(spark):
    roots = spark.createDataFrame([(None, "no one", None), (0, "zero", 1.5), (None, "x", 2.5)], "k int, name string, d double")
    items = spark.createDataFrame([(None, None, 7), (None, None, 8), (0, 1.5, 9), (None, 2.5, 10), (5, 5.5, 11)], "k int, d double, id int")
    out = nest(roots, items, ["k", "d"], F.col("id"), "ids", F.col("id"), ["id"], part_items=1000).collect()
    assert {(r.k, r.name, r.d, tuple(r.ids)) for r in out} == {(None, "no one", None, (7, 8)), (0, "zero", 1.5, (9,)), (None, "x", 2.5, (10,))}


def test_rejoin_keeps_the_rows_of_copies(spark):
    row = "1L AS visitNumber, 1L AS visitId, 1L AS visitStartTime, 'u' AS fullVisitorId"
    hit = "array(named_struct('hitNumber', {n})) AS hits"
    parts = [f"SELECT {row}, {v} AS revenue, {hit.format(n=v)}, {v} AS _row" for v in (5, 9)]
    out = rejoin(spark.sql(" UNION ALL ".join(parts)), ["_row"]).collect()
    assert sorted((r.revenue, len(r.hits)) for r in out) == [(5, 2), (9, 0)]


def test_rejoin_equals_the_default_path_for_unique_keys(spark, tmp_path, record):
    second = copy.deepcopy(record) | {"visitId": "2"}
    second["hits"] = [record["hits"][0] | {"hitNumber": n} for n in ("3", "1", "2")]
    nohits = copy.deepcopy(record) | {"visitId": "3", "hits": []}
    keyless = copy.deepcopy(record) | {"visitId": None}
    sessions = conform(read_sessions(spark, write(tmp_path, record, second, nohits, keyless)), GOLD)
    out = rejoin(sessions.withColumn("_row", F.xxhash64("visitId")), ["_row"])
    got = {r.visitId: [h.hitNumber for h in r.hits] for r in out.collect()}
    assert got == {1496300123: [1], 2: [1, 2, 3]}
    expected = sessions.filter("visitId IS NOT NULL AND size(hits) > 0").drop("hits")
    same = out.select(expected.columns)
    assert same.exceptAll(expected).isEmpty() and expected.exceptAll(same).isEmpty()


def test_rejoin_merges_the_hits_of_copies_once(spark, tmp_path, record):
    sessions = conform(read_sessions(spark, write(tmp_path, record, record)), GOLD)
    numbered = sessions.withColumn("_row", F.monotonically_increasing_id())
    out = rejoin(numbered, ["_row"]).collect()
    # every copy has its row, the first of them all hits
    assert sorted(len(r.hits) for r in out) == [0, 2] and {r.part for r in out} == {0}
    assert [out[0][k] for k in SESSION_KEY] == [1, 1496300123, 1496300123, record["fullVisitorId"]]


def test_record_builds_nested_types():
    assert record_type(a="long", b=record_type(c="bool")).simpleString() == "struct<a:bigint,b:struct<c:boolean>>"
