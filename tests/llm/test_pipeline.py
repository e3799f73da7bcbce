from __future__ import annotations

import __spark_entry__ as entry
import corpus_pipeline as p
from sessionlake.llm.queries import ORACLES, QUERIES
from tests.llm.conftest import words


def save(df, folder, name):
    df.write.parquet(f"{folder}/{name}.parquet")


def test_stages_take_effect(spark, tmp_path):
    item = " ".join(f"item{k}" for k in range(14))
    text = {i: words(i, 150, 100_000) for i in range(40)}
    text[50] = text[3]
    text[51] = text[4] + "\n" + item
    text[52] = " ".join(f"only{k} " * 40 for k in range(9))
    text[53] = text[5].replace(" ", "$$$ ")
    rows = [(i, t, "en", "s", len(t)) for i, t in text.items()] + [(60, None, "en", "s", None), (61, "", None, None, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    save(docs, tmp_path, "documents")
    labels = [(i, 1, 0) for i in range(40)] + [(53, 0, 0)]
    save(spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), tmp_path, "labels")
    save(spark.createDataFrame([(1, item)], "item_id long, text string"), tmp_path, "benchmark")
    table, left = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in p.STAGES:
        table = stage(spark, table, str(tmp_path))
        left[name] = {r["doc_id"]: r.asDict() for r in table.collect()}
        if name != "packing":
            assert table.columns == docs.columns and table.schema == docs.schema
    assert not {52, 53, 60, 61} & set(left["quality"]) and len(left["quality"]) == 42
    assert 50 not in left["lines"] and left["lines"][51]["text"] == item and left["lines"][51]["n_chars"] == len(item)
    assert 51 not in left["benchmark"] and set(left["benchmark"]) == set(range(40))
    assert set(left["packing"]) == set(range(40))
    want = {(r["doc_id"], r["start"], r["length"], r["ids_crc32"]) for r in table.collect()}
    assert {(r["doc_id"], r["start"], r["length"], r["ids_crc32"]) for r in p.run(spark, str(tmp_path)).collect()} == want


def test_registered(spark):
    names = entry.queries()
    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in QUERIES} and set(QUERIES) < set(names)
    assert names["pipeline"] is p.run and set(ORACLES) <= set(entry.oracle_sql()) and set(ORACLES) <= set(QUERIES)


def test_empty_tables(spark, tmp_path):
    save(spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long"), tmp_path, "documents")
    save(spark.createDataFrame([], "doc_id long, quality int, toxic int"), tmp_path, "labels")
    save(spark.createDataFrame([], "item_id long, text string"), tmp_path, "benchmark")
    save(spark.createDataFrame([], "page_id long, url string, html string"), tmp_path, "pages")
    for name, run in {**QUERIES, "pipeline": p.run}.items():
        assert run(spark, str(tmp_path)).count() == 0, name


def test_near_copies_by_fingerprints_and_by_shingles(spark):
    one, two = words(1, 120, 100_000).split(), words(2, 120, 100_000).split()
    # a passage said often weighs in the fingerprint, and its other shingles are few of many
    often = words(3, 41, 100_000).split() * 60
    texts = {1: " ".join(often + one[:60]), 2: " ".join(often + two[:60]), 3: " ".join(two), 4: " ".join([*two[:-3], "x", "y", "z"]), 5: words(6, 120, 100_000)}
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in texts.items()], "doc_id long, text string, lang string, source string, n_chars long")
    by_shingles = {r["doc_id"] for r in p.shingled.keep_first(docs).collect()}
    by_prints = {r["doc_id"] for r in p.simhash.keep_first(docs).collect()}
    assert by_shingles == {1, 2, 3, 5} and by_prints == {1, 3, 4, 5}
    assert {r["doc_id"] for r in p.near_copies(spark, docs, "").collect()} == {1, 3, 5}
