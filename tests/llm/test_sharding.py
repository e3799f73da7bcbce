from __future__ import annotations

import zlib
from collections import Counter

from sessionlake.llm import sharding
from tests.llm.conftest import SCHEMA, words


def check(rows, docs, shards):
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in docs)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == want
    for s in {r["shard"] for r in rows}:
        slots = sorted(r["slot"] for r in rows if r["shard"] == s)
        assert slots == list(range(len(slots)))
        assert 0 <= s < shards
    assert all(r["law"] == "bytes" and r["grown_shard"] is None for r in rows)


def test_near_equal_bytes_and_equal_texts_together(spark):
    docs = [(i, words(i // 2, 20 + i % 50), "en" if i % 3 else "de", "s", i % 50) for i in range(800)]
    for shards in (8, 5, 1):
        rows = sharding.shard(spark.createDataFrame(docs, SCHEMA), shards).collect()
        check(rows, docs, shards)
        sizes = Counter()
        for r in rows:
            sizes[r["shard"]] += r["size"]
        assert len(sizes) == shards
        assert max(sizes.values()) < 1.05 * sum(sizes.values()) / shards


def test_equal_texts_stay_together_whatever_their_metadata(spark, monkeypatch):
    monkeypatch.setattr(sharding, "TOLERANCE", 0.02)  # three copies are a larger share of so few rows
    langs = ["en", "de", "fr", None]
    docs = [(i, words(i % 900, 20 + i % 900 % 30), langs[i // 900], "s", None if i // 900 == 2 else i % 900 * (1 + i // 900)) for i in range(2700)]
    rows = sharding.shard(spark.createDataFrame(docs, SCHEMA), 8).collect()
    check(rows, docs, 8)
    where, sizes = {}, Counter()
    for r in rows:
        where.setdefault(r["text_crc32"], set()).add(r["shard"])
        sizes[r["shard"]] += r["size"]
    assert all(len(x) == 1 for x in where.values()) and max(sizes.values()) < 1.1 * sum(sizes.values()) / 8


def test_cuts_as_by_a_plain_tree(spark, monkeypatch):
    # without tolerance a cut is at the row that a sorted list gives
    monkeypatch.setattr(sharding, "TOLERANCE", 0)
    held = {}
    plain = sharding._cut_tree
    monkeypatch.setattr(sharding, "_cut_tree", lambda rows, leaves, spans: held.update(rows=rows.collect(), spans=spans) or plain(rows, leaves, spans))
    docs = [(i, words(i // 3, 5 + i // 3 % 60), "en" if i // 3 % 4 else "de", "s", i // 3 % 60 + 1) for i in range(600)]
    got = {r["doc_id"]: r["shard"] for r in sharding.shard(spark.createDataFrame(docs, SCHEMA), 7).collect()}
    spans, rows = held["spans"], held["rows"]

    def key(r, dim):
        low, width = spans[dim]
        top = (1 << sharding.PLACE_BITS) - 1
        place = min(top, int((r[f"d{dim}"] - low) / width * top)) if width > 0 else 0
        return place << sharding.TEXT_BITS + sharding.ROW_BITS | r["text_key"] << sharding.ROW_BITS | r["row_key"]

    want = {}

    def cut(own, first, leaves):
        if leaves == 1:
            want.update({r["doc_id"]: first for r in own})
            return
        wide = [(max(r[f"d{i}"] for r in own) - min(r[f"d{i}"] for r in own)) / spans[i][1] if spans[i][1] > 0 else 0.0 for i in range(len(spans))]
        dim = max(range(len(spans)), key=lambda i: wide[i])
        goal, below = sum(r["size"] for r in own) * (leaves // 2) / leaves, 0
        weights = Counter()
        for r in own:
            weights[key(r, dim)] += r["size"]
        for k in sorted(weights):
            if below + weights[k] >= goal:
                break
            below += weights[k]
        at = k if goal - below < below + weights[k] - goal else k + 1
        cut([r for r in own if key(r, dim) < at], first, leaves // 2)
        cut([r for r in own if key(r, dim) >= at], first + leaves // 2, leaves - leaves // 2)

    cut(rows, 0, 7)
    assert got == want


def test_a_text_of_a_third_of_all_rows_is_split(spark):
    docs = [(i, "the same text" if i % 3 else words(i, 3), None, None, None) for i in range(900)]
    rows = sharding.shard(spark.createDataFrame(docs, SCHEMA), 4).collect()
    check(rows, docs, 4)
    sizes = Counter()
    for r in rows:
        sizes[r["shard"]] += r["size"]
    assert max(sizes.values()) < 1.1 * min(sizes.values())


def test_leaves_reach_the_target(spark):
    docs = [(i, words(i, 30), "en", "s", 1) for i in range(300)]
    rows = sharding.shard(spark.createDataFrame(docs, SCHEMA), target_bytes=10_000).collect()
    total = sum(r["size"] for r in rows)
    assert len({r["shard"] for r in rows}) == -(-total // 10_000)


def test_edges(spark, edge, edge_rows, empty):
    check(sharding.shard(edge, 8).collect(), edge_rows, 8)
    check(sharding.shard(edge.drop("lang", "n_chars"), 2).collect(), edge_rows, 2)
    assert sharding.shard(empty, 8).count() == 0


def test_stays_in_the_jvm(spark):
    docs = spark.createDataFrame([(i, words(i, 5), "en", "s", 1) for i in range(50)], SCHEMA)
    plan = sharding.shard(docs, 4)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
