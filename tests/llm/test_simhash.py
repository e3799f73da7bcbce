from __future__ import annotations

import random
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from sessionlake.llm import components as c
from sessionlake.llm import simhash as s
from tests.llm.conftest import SCHEMA, words


def fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({k: k + 32 for k in range(65, 91)}))
    shingles = [" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))] if w else []
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def roots(pairs, nodes):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def linked(prints):
    prints = sorted(set(prints))
    return roots([(a, b) for i, a in enumerate(prints) for b in prints[i + 1 :] if (a ^ b).bit_count() <= 4], prints)


def test_fingerprints_as_by_plain_python(edge, edge_rows):
    got = sorted((str(r["doc_id"]), r["fingerprint"] % (1 << 64)) for r in s.fingerprints(edge).collect())
    assert got == sorted((str(i), fingerprint(t)) for i, t, *_ in edge_rows)
    few = [b"one", b"One two", b"a b c d", b"a b c d e", b"\x0b", "É é É é É".encode()]
    assert s.fingerprint_of(few).tolist() == [fingerprint(t.decode()) for t in few]


def test_every_close_pair_has_a_key_and_one_first_key():
    rng = random.Random(1)
    for _ in range(3000):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), rng.randint(1, 4)):
            b ^= 1 << bit
        shared = [k for k, (_, _, m) in enumerate(s.KEYS) if a & m == b & m]
        x = np.array([a ^ b], np.uint64)
        assert shared and int(s._first_key(x)[0]) in shared and s._chains(x).any()


def clusters(rng, n):
    out = []
    for _ in range(n):
        a = rng.getrandbits(64)
        for _ in range(rng.choice([1, 2, 3, 150])):
            out.append(a)
            for bit in rng.sample(range(64), rng.randint(0, 5)):
                a ^= 1 << bit
            a = rng.choice(out[-5:]) if rng.random() < 0.5 else a
    return sorted(set(out))


def check_links(spark, prints, **options):
    df = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "fingerprint long")
    pairs = [(r["u"] % (1 << 64), r["v"] % (1 << 64)) for r in s.links(df, **options).collect()]
    assert all((a ^ b).bit_count() <= 4 and a != b for a, b in pairs)
    assert roots(pairs, prints) == linked(prints)


def test_links_connect_what_all_pairs_connect(spark):
    rng = random.Random(5)
    prints = clusters(rng, 60)
    check_links(spark, prints)
    check_links(spark, prints, block=20)  # every key with more members is dealt out as pairs of blocks


def test_a_dense_group_gives_few_links(spark):
    center = 0x0123456789ABCDEF
    prints = sorted({center ^ (1 << a) ^ (1 << b) for a in range(64) for b in range(64)})
    df = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "fingerprint long")
    assert s.links(df).count() < len(s.KEYS) * len(prints)
    check_links(spark, prints)


def test_components_of_paths_stars_and_rings(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(300, 300 + i) for i in range(1, 200)] + [(1, 2), (2, 3), (3, 1), (1, 1), (2, 1), (-5, 160)]
    nodes = {n for e in edges for n in e}
    got = {r["node"]: r["root"] for r in c.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    want = roots(edges, nodes)
    assert got == {n: r for n, r in want.items() if n != r}
    assert c.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_edges(spark, edge, edge_rows, empty):
    rows = s.near_duplicates(edge).collect()
    assert len(rows) == len(edge_rows)
    same = linked([fingerprint(t) for _, t, *_ in edge_rows])
    least = {}
    for i, t, *_ in edge_rows:
        root = same[fingerprint(t)]
        least[root] = min([x for x in (i, least.get(root)) if x is not None], default=None)
    assert sorted((str(r["doc_id"]), r["component_id"]) for r in rows) == sorted((str(i), least[same[fingerprint(t)]]) for i, t, *_ in edge_rows)
    kept = s.keep_first(edge)
    assert kept.columns == edge.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(least.values())
    assert s.near_duplicates(empty).count() == 0 and s.keep_first(empty).count() == 0


def test_rows_without_any_id_leave_one(spark):
    rows = [(None, words(1, 60), "en", "s", 1)] * 3 + [(None, words(2, 60), "en", "s", 1)]
    assert s.keep_first(spark.createDataFrame(rows, SCHEMA)).count() == 2
    digits = spark.createDataFrame([(-1,), (10,)], "x long").select(s.hex_digits(F.col("x")))
    assert [r[0] for r in digits.collect()] == ["f" * 16, "0" * 15 + "a"]
