from __future__ import annotations

import hashlib
import random
from collections import Counter
from zlib import crc32

import pytest

from sessionlake.llm import piecewise as p
from tests.llm.conftest import SCHEMA, words

M = (1 << 32) - 1


def rolled(data, i):
    """The hash of the bytes up to place i."""
    h = 0
    for j in range(p.REACH):
        if i - j >= 0:
            h = (h + int(p._BYTE[data[i - j]]) * pow(int(p._STEP), j, 1 << 32)) & M
    h ^= h >> 15
    h = h * 0x85EBCA6B & M
    return h ^ h >> 13


def plain_fingerprint(text):
    data = (text or "").encode()
    hashes = [rolled(data, i) for i in range(len(data) - 1)]
    level = p.LOWEST

    def signs(k):
        out, start = "", 0
        for i, h in enumerate(hashes):
            if h % (1 << k) == 0:
                out += p.SIGNS[crc32(data[start : i + 1]) % 4096]
                start = i + 1
        return out + p.SIGNS[crc32(data[start:]) % 4096] if data else ""

    while len(signs(level)) > 2 * p.PIECES:
        level += 1
    return f"{level}:{signs(level)}:{signs(level + 1)}"


def plain_likeness(x, y):
    if x == y:
        return 1.0

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, s in enumerate(a):
            last, row = row, [i + 1]
            for j, t in enumerate(b):
                row.append(last[j] if s == t else 1 + min(last[j + 1], row[j]))
        return row[-1]

    def at(f):
        k, a, b = f.split(":")
        return {int(k) + i: [s[j : j + 2] for j in range(0, len(s), 2)] for i, s in enumerate((a, b))}

    a, b = at(x), at(y)
    shared = [(a[k], b[k]) for k in a if k in b and a[k] and b[k]]
    return max((1 - distance(s, t) / (len(s) + len(t)) for s, t in shared), default=0.0)


def by_hand(rows):
    order = sorted(((i, t or "") for i, t, *_ in rows), key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode()))
    out = Counter()
    for (i, text), (_, other) in zip(order, order[1:] + order[:1], strict=True):
        quarter = len(text) // 4
        edited = text[: len(text) - quarter] + other[:quarter]
        own, changed = plain_fingerprint(text), plain_fingerprint(edited)
        near = [round(plain_likeness(own, f), 9) for f in (changed, plain_fingerprint(other))]
        out[(i, len(text), hashlib.sha256(edited.encode()).hexdigest(), own, changed, *near)] += 1
    return out


def got(df):
    return Counter((*tuple(r)[:5], round(r["near_edited"], 9), round(r["near_next"], 9)) for r in p.against_next(df).collect())


@pytest.mark.parametrize("text", ["", "a", "abcdefgh" * 3, words(1, 30), words(2, 900), "as " * 500, "é漢😀" * 40, "\x00" * 300])
def test_fingerprint_as_byte_by_byte(text):
    assert p.fingerprint(text.encode()) == plain_fingerprint(text)


def test_blocks_of_long_texts_meet(monkeypatch):
    text = words(4, 400).encode()
    want = p.fingerprint(text)
    for block in (1, 5, 7, 100, 1001):
        monkeypatch.setattr(p, "BLOCK", block)
        assert p.fingerprint(text) == want


def test_likeness_as_by_tables_of_distances():
    rng = random.Random(2)
    texts = [words(rng.randint(1, 6), rng.randint(1, 300)) for _ in range(25)]
    texts += [t[: len(t) // 2] + words(9, 20) + t[len(t) // 2 :] for t in texts] + ["", "a", "b"]
    prints = [p.fingerprint(t.encode()) for t in texts]
    for x in prints:
        for y in prints:
            assert abs(p.likeness(x, y) - plain_likeness(x, y)) < 1e-12
    assert p.likeness(prints[-3], prints[-3]) == 1.0 and p.likeness(prints[-3], prints[0]) == 0.0


def test_a_changed_quarter_leaves_most_pieces():
    for seed in range(20):
        text, other = words(seed, 150 + 40 * seed, 5000), words(100 + seed, 400, 5000)
        own = p.fingerprint(text.encode())
        assert p.likeness(own, p.fingerprint(p._edited(text, other).encode())) > 0.6
        assert p.likeness(own, p.fingerprint(other.encode())) < 0.2


def test_next_documents_over_many_ranges(spark):
    rng = random.Random(7)
    rows = [(i, words(rng.randint(0, 9), rng.randint(0, 90)), None, None, None) for i in rng.sample(range(-50, 1000), 120)]
    rows += [(1001, f"tie {k}" * 9, None, None, None) for k in range(3)] + [(1001, "tie 1" * 9, None, None, None)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    for n in (1, 13, 200):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        try:
            assert got(spark.createDataFrame(rows, SCHEMA).repartition(5)) == by_hand(rows)
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)


def test_edges(spark, edge, edge_rows, empty):
    assert got(edge) == by_hand(edge_rows)
    assert p.against_next(empty).count() == 0
    assert got(spark.createDataFrame(edge_rows[4:5], SCHEMA)) == by_hand(edge_rows[4:5])
    named = p.with_fingerprint(edge)
    assert named.columns == edge.columns
    assert Counter((r["doc_id"], r["fingerprint"]) for r in named.collect()) == Counter((i, plain_fingerprint(t)) for i, t, *_ in edge_rows)
