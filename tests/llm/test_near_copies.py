from __future__ import annotations

import random

import numpy as np
import pyarrow as pa

import corpus_pipeline
from sessionlake.llm import near_copies as nc
from sessionlake.llm import simhash
from sessionlake.llm.arrow import text_bytes
from tests.llm.conftest import SCHEMA, words
from tests.llm.test_simhash import roots


def shingles(text):
    w = (text or "").translate({k: k + 32 for k in range(65, 91)}).split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b)


def changed(rng, text, n):
    w = text.split()
    for p in rng.sample(range(len(w)), n):
        w[p] = f"new{rng.random()}"
    return " ".join(w)


def components_of(docs):
    alike = [(i, j) for i, a in docs.items() for j, b in docs.items() if i < j and jaccard(a, b) >= nc.SIMILARITY]
    return roots(alike, docs)


def test_sets_of_shingles():
    texts = ["a b c d e f", "A  b\tc d e\nf", "a b c d e a b c d e a b c d e", "a b", "b a", "", None, " \n", "é b c d e"]
    value, at = nc.shingles(*text_bytes(pa.array(texts)))
    got = [set(value[a:b].tolist()) for a, b in zip(at[:-1], at[1:], strict=True)]
    assert [len(x) for x in got] == [len(shingles(t)) for t in texts] == np.diff(at).tolist()
    for a, x in zip(texts, got, strict=True):
        for b, y in zip(texts, got, strict=True):
            assert len(x & y) == len(shingles(a) & shingles(b))


def test_components_as_by_all_pairs(spark):
    rng = random.Random(3)
    docs = {}
    for k in range(25):
        text = words(k, 160, 5000).replace("\n", " ")
        docs[10 * k] = text
        for j in range(1, 6):
            text = changed(rng, text if k % 2 else docs[10 * k], j % 4)
            docs[10 * k + j] = text
    rows = nc.near_duplicates(spark.createDataFrame([(i, t, "en", "s", 1) for i, t in docs.items()], SCHEMA)).collect()
    assert {r["doc_id"]: r["component_id"] for r in rows} == components_of(docs)


def test_the_stage_takes_copies_that_differ_in_many_bits(spark):
    rng = random.Random(4)
    base = {i: words(100 + i, 200, 5000).replace("\n", " ") for i in range(12)}
    docs = base | {100 + i: changed(rng, t, 3) for i, t in base.items()} | {200 + i: changed(rng, t, 20) for i, t in base.items()}
    assert all(0.8 <= jaccard(docs[i], docs[100 + i]) < 0.95 and jaccard(docs[i], docs[200 + i]) < 0.7 for i in base)
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in docs.items()], SCHEMA)
    left = {r["doc_id"] for r in corpus_pipeline.near_copies(spark, df, "").collect()}
    assert left == set(base) | {200 + i for i in base}
    assert simhash.keep_first(df).count() > len(left)  # op9's own bound leaves some


def test_groups_that_one_member_does_not_connect(spark):
    # one band of all: three components and single sets, compared member by member or with all pairs
    sets = {i: {1000 * (i // 10) + k for k in range(100)} - {1000 * (i // 10) + i % 10} for i in range(30)}
    sets |= {i: {1000 * i + k for k in range(100)} for i in range(30, 34)}
    members = spark.createDataFrame([(1, i) for i in sets], "band long, same long")
    table = spark.createDataFrame([(i, sorted(s)) for i, s in sets.items()], "same long, shingles array<long>")
    want = roots([(i, j) for i in range(30) for j in range(30) if i // 10 == j // 10], sets)
    pairs = [(r["u"], r["v"]) for r in nc.links(members, table).collect()]
    assert roots(pairs, sets) == want


def test_candidates_of_a_large_group_are_few(spark):
    # 2,000 members in 200 components, most shingles in common: copies of a component differ by one, components by a quarter
    sets = {}
    for c in range(200):
        own = set(range(75)) | {1000 + 25 * c + k for k in range(25)}
        sets |= {10 * c + i: (own - {1000 + 25 * c + i}, 10 * c) for i in range(10)}
    df = spark.createDataFrame([(i, r, sorted(s)) for i, (s, r) in sets.items()], "same long, root long, shingles array<long>")
    assert nc.candidates(df).count() <= len(sets)
    # without components: those of a component, and few others
    alone = df.withColumn("root", df["same"])
    pairs = {(r["u"], r["v"]) for r in nc.candidates(alone).collect()}
    assert {(a, b) for a in sets for b in sets if a < b and a // 10 == b // 10} <= pairs and len(pairs) <= 10 * len(sets)


def test_no_alike_pair_is_missing_among_candidates(spark):
    rng = random.Random(6)
    sets = {}
    for i in range(300):
        size, pool = rng.randint(1, 40), rng.choice([12, 45, 60])
        sets[i] = set(rng.sample(range(pool), min(size, pool)))
    df = spark.createDataFrame([(i, i % 7, sorted(s)) for i, s in sets.items()], "same long, root long, shingles array<long>")
    for similarity in (0.5, 0.8, 1.0):
        pairs = {(r["u"], r["v"]) for r in nc.candidates(df, similarity).collect()}
        alike = {(a, b) for a in sets for b in sets if a < b and a % 7 != b % 7 and len(sets[a] & sets[b]) >= similarity * len(sets[a] | sets[b])}
        assert alike <= pairs and all(a % 7 != b % 7 for a, b in pairs)


def test_a_family_around_one_text(spark):
    # copies of one text that lost up to 40 of 100 shingles to words of their own: only the nearer ones are alike
    rng = random.Random(9)
    base = words(77, 104, 5000).replace("\n", " ")
    docs = {0: base} | {i: changed(rng, base, rng.randint(0, 8)) for i in range(1, 250)}
    rows = nc.near_duplicates(spark.createDataFrame([(i, t, "en", "s", 1) for i, t in docs.items()], SCHEMA)).collect()
    assert {r["doc_id"]: r["component_id"] for r in rows} == components_of(docs)


def test_edges(spark, edge, edge_rows, empty):
    rows = nc.near_duplicates(edge).collect()
    assert len(rows) == len(edge_rows)
    group = {r["doc_id"]: r["component_id"] for r in rows if r["doc_id"] is not None}
    assert group == {1: 1, 2: 1, 3: 1, 4: 4, 5: 5, 6: 5, 7: 7, 8: 5, 9: 9, 10: 10}
    kept = nc.keep_first(edge)
    assert kept.columns == edge.columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 4, 5, 7, 9, 10]
    assert nc.near_duplicates(empty).count() == 0 and nc.keep_first(empty).count() == 0
    nameless = spark.createDataFrame([(None, words(1, 60), "en", "s", 1)] * 3, SCHEMA)
    assert nc.keep_first(nameless).count() == 1
