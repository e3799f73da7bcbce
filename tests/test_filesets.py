from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sessionlake.operators.curve import as_number, interleaved, with_curve
from sessionlake.sources import filesets as fs
from sessionlake.workspace import child_paths, create_once, read_text

SCHEMA = "id long, day string, x long, y double, name string, hits array<struct<p:string>>"


def rows(n, seed=1, days=("1", "2")):
    rng = random.Random(seed)
    return [(i, rng.choice(days), rng.randrange(1000), rng.random(), f"n{rng.randrange(100):02}" if rng.random() < 0.9 else None, [(f"p{i}",)]) for i in range(n)]


@pytest.fixture
def files(spark, tmp_path):
    schema = spark.createDataFrame([], SCHEMA).schema
    return fs.FileSet(spark, str(tmp_path / "set"), schema, ["day"], {"x": F.col("x"), "y": F.col("y"), "name": F.col("name")})


def add(files, made, **options):
    return files.append(files.spark.createDataFrame(made, files.schema).coalesce(1), **options)


def held(df):
    return Counter(map(repr, (r.asDict(True) for r in df.collect())))


def test_versions_of_appends(files):
    assert files.read().count() == 0 and files.versions() == [] and files.append(files.read()) is None
    a, b = rows(10), rows(5, 2)
    assert add(files, a) == 1 and add(files, b) == 2
    assert files.read().columns == files.schema.fieldNames()
    assert files.read(1).count() == 10 and files.read().count() == 15
    listed = {r["folder"]: r for r in files.files(1).collect()}
    want = Counter(r[1] for r in a)
    assert {f: r["n_rows"] for f, r in listed.items()} == {f"day={d}": n for d, n in want.items()}
    for d in want:
        assert listed[f"day={d}"]["low_x"] == min(r[2] for r in a if r[1] == d)
        assert listed[f"day={d}"]["high_name"] == max(r[4] for r in a if r[1] == d and r[4])


def test_a_tag_is_appended_once(files):
    assert add(files, rows(3), tag="s-0") == 1 and add(files, rows(3), tag="s-0") is None and add(files, rows(4), tag="s-1") == 2
    assert files.read().count() == 7


def test_compaction_keeps_rows_and_bounds_files(files):
    for k in range(6):
        add(files, rows(30, k))
    add(files, rows(20_000, 99))
    before, sizes = held(files.read()), [r["bytes"] for r in files.files().collect()]
    target = 3 * min(sizes)
    large = {r["file"] for r in files.files().where(F.col("bytes") >= target / 2).collect()}
    version = files.compact(target)
    assert version == 8 and held(files.read()) == before and held(files.read(7)) == before
    after = files.files().collect()
    assert large <= {r["file"] for r in after} and len(after) <= len(sizes) * 2 / 3
    assert all(r["bytes"] <= 1.5 * target for r in after if r["file"] not in large)
    # bins of one folder each, of two files or more
    plan = files.plan(target, version=7).collect()
    assert all(n > 1 for n in Counter((r["folder"], r["turn"]) for r in plan).values())
    while files.compact(target) is not None:
        pass
    assert held(files.read()) == before


def test_only_small_files_are_read(files, monkeypatch):
    for k in range(4):
        add(files, rows(10, k))
    add(files, rows(5000, 9))
    opened = []
    plain = fs.FileSet._read
    monkeypatch.setattr(fs.FileSet, "_read", lambda self, paths: opened.append(paths) or plain(self, paths))
    files.compact(8 * min(r["bytes"] for r in files.files().collect()))
    small = {r["file"] for r in files.files(5).orderBy("bytes").limit(8).collect()}
    assert set(opened[0]) == small


def test_a_run_that_breaks_off_changes_nothing(files, monkeypatch):
    for k in range(4):
        add(files, rows(10, k))
    before = held(files.read())
    with monkeypatch.context() as broken:
        broken.setattr(fs.FileSet, "_mark", lambda self, marker: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            files.compact(1 << 20)
    assert held(files.read()) == before and len(files.versions()) == 4
    assert files.compact(1 << 20) == 5 and held(files.read()) == before
    old = {m.files for m in files.versions()}
    gone = files.vacuum()
    assert len(gone) == 5 and held(files.read()) == before and {m.files for m in files.versions()} == old


def test_writers_side_by_side(files):
    for k in range(4):
        add(files, rows(10, k))
    other = fs.FileSet(files.spark, files.root, files.schema, files.by, files.ranges)
    plain = files._store

    def meanwhile(made, work):
        def store(rows_):
            listed = plain(rows_)
            files._store = plain
            work()
            return listed
        files._store = store
        return made()

    # an append while files are compacted: both are there
    assert meanwhile(lambda: files.compact(1 << 20), lambda: add(other, rows(7, 50))) == 6
    assert files.read().count() == 47
    add(files, rows(3, 60))
    with pytest.raises(fs.Conflict):
        meanwhile(lambda: files.compact(1 << 20), lambda: other.compact(1 << 20))
    assert files.read().count() == 50


def test_many_versions_are_listed_in_one(files, monkeypatch):
    monkeypatch.setattr(fs, "FULL_EVERY", 2)
    for k in range(4):
        add(files, rows(5, k))
    files.compact(1 << 20)
    marks = files.versions()
    assert [m.number for m in marks] == list(range(1, len(marks) + 1)) and sum(m.full for m in marks) >= 2
    assert files.read().count() == 20 and files.read(1).count() == 5


def test_marker_files(spark, tmp_path):
    path = str(tmp_path / "m" / "1")
    assert create_once(spark, path, "é one") and not create_once(spark, path, "two") and read_text(spark, path) == "é one"
    assert [p.rpartition("/")[2] for p in child_paths(spark, str(tmp_path / "m")) if not p.endswith(".crc")] == ["1"]
    assert child_paths(spark, str(tmp_path / "none")) == []


def test_the_curve_takes_the_bits_in_turn(spark):
    df = spark.range(64).selectExpr("cast(id % 8 as int) a", "cast(id div 8 as int) b")
    got = {(r["a"], r["b"]): r["z"] for r in df.withColumn("z", interleaved([F.col("a"), F.col("b")], 3)).collect()}
    want = {(a, b): sum((a >> k & 1) << (2 * k + 1) | (b >> k & 1) << 2 * k for k in range(3)) for a in range(8) for b in range(8)}
    assert got == want


def test_numbers_order_as_values_do(spark):
    df = spark.createDataFrame([(None,), ("",), ("a",), ("aé",), ("b",), ("é",), ("漢字",)], "t string")
    got = [r[0] for r in df.select(as_number(F.col("t"), df.schema["t"].dataType).alias("n")).collect()]
    assert got[0] is None and got[1:] == sorted(got[1:]) and len(set(got)) == 7


def test_clustered_files_prune_on_two_columns_at_once(files):
    made = rows(40_000, 3, days=("1",)) + [(i, "2", 7, 0.5, "hot", []) for i in range(20_000)]
    add(files, made)
    size = files.files().agg(F.sum("bytes")).first()[0]
    files.cluster(["x", "y"], target=size // 24)
    assert held(files.read()) == Counter(map(repr, (r.asDict(True) for r in files.spark.createDataFrame(made, files.schema).collect())))
    total = files.files().count()
    assert total >= 20
    for low, high, least, most in ((100, 200, 0.1, 0.2), (800, 900, 0.7, 0.9), (10, 999, 0.4, 0.6)):
        box = {"x": (low, high), "y": (least, most)}
        want = sum(low <= r[2] <= high and least <= r[3] <= most for r in made)
        assert files.read(where=box).count() == want
        assert len(files.chosen(where=box)) <= total * 0.6
    assert len(files.chosen(where={"x": (100, 200), "y": (0.1, 0.2)})) <= total / 4
    # rows that are equal in all clustered columns are in many files
    assert files.files().where("folder = 'day=2'").count() > 3
    assert files.chosen(where={"x": (5000, None)}) == [] and files.read(where={"name": ("zzz", None)}).count() == 0
    assert files.read(where={"name": (None, "n10")}).count() == sum(r[4] is not None and r[4] <= "n10" for r in made)


def test_curve_of_columns_of_one_value_or_none(spark):
    df = spark.createDataFrame([(1, None), (1, None)], "a int, b string")
    assert [r["_curve"] for r in with_curve(df, {"a": F.col("a"), "b": F.col("b")}).collect()]
    with pytest.raises(ValueError):
        with_curve(df, {str(k): F.col("a") for k in range(9)})


def test_a_stream_appends_each_batch_once(spark, tmp_path):
    schema = spark.createDataFrame([], SCHEMA).schema
    to = fs.FileSet(spark, str(tmp_path / "set"), schema, ["day"])
    for k in range(5):
        spark.createDataFrame(rows(20, k), schema).coalesce(1).write.parquet(str(tmp_path / "in" / f"{k}"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in" / "*"))
    for name in ("c1", "c2"):  # with a new checkpoint all batches come again
        fs.start_append(stream, to, str(tmp_path / name), "bronze", once=True, compact_after=2, target=1 << 20).awaitTermination()
        assert to.read().count() == 100
    # four batches are in one file a day, the last one is apart
    assert to.files().count() <= 4
