from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter
from zlib import crc32

import pytest

from sessionlake.llm import resampling as r
from tests.llm.conftest import SCHEMA, words


def split(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({k: k + 32 for k in range(65, 91)}))


def by_hand(rows, target, low=1, high=1, buckets=10_000, percent=10, min_words=20):
    def features(text):
        w = split(text)
        return [crc32(" ".join(w[i : i + n]).encode()) % buckets for n in range(low, high + 1) for i in range(len(w) - n + 1)]

    own = [(i, len(split(t)), features(t)) for i, t, *_ in rows]
    s, t = Counter(b for _, _, f in own for b in f), Counter(b for x in target for b in features(x))
    s_all, t_all = sum(s.values()) + buckets, sum(t.values()) + buckets
    gain = [math.floor(1000 * math.log((t[b] + 1) * s_all / ((s[b] + 1) * t_all))) for b in range(buckets)]
    scored = []
    for i, n, f in own:
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = None if i is None else int(hashlib.sha256(f"2024:{i}".encode()).hexdigest()[:8], 16)
        scored.append((i, n, len(f), weight, None if i is None else weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    can = sorted((x for x in scored if x[1] >= min_words and x[4] is not None), key=lambda x: (-x[4], x[0]))
    ranked = [(*x, k + 1) for k, x in enumerate(can[: percent * len(can) // 100])]
    left = Counter(scored) - Counter(x[:-1] for x in ranked)
    return Counter(ranked) + Counter({(*x, None): n for x, n in left.items()})


def got(df, target, *options, **more):
    return Counter(tuple(x) for x in r.resample(df, target, *options, **more).collect())


@pytest.mark.parametrize("low,high,buckets", [(1, 1, 10_000), (1, 3, 97), (2, 2, 1 << 20)])
def test_as_by_plain_python(spark, low, high, buckets):
    rng = random.Random(1)
    rows = [(i, words(rng.randint(0, 40), rng.randint(0, 60), rng.choice([20, 200])), "en", "s", 1) for i in range(300)]
    target = [words(5, 80), None, "É é E"]
    made = got(
        spark.createDataFrame(rows, SCHEMA), spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string"),
        r.Features(low, high, buckets), percent=30,
    )
    assert made == by_hand(rows, target, low, high, buckets, percent=30)
    assert sum(x[-1] is not None for x in made) > 20


def test_windows_go_on_over_parts_of_a_long_text(monkeypatch):
    text = " ".join(f"w{i % 50}" for i in range(5000)) + "x" * 300 + "  end"
    whole, plain = r.Bucketer(r.Features(1, 3)).of(text), r.parts
    monkeypatch.setattr(r, "parts", lambda t: plain(t, 10))
    cut = r.Bucketer(r.Features(1, 3)).of(text)
    assert whole[0] == cut[0] == 5001 and Counter(whole[1]) == Counter(cut[1])


def test_parts_cut_after_blanks():
    text = "ab cd " * 100 + "e" * 500 + " f"
    made = list(r.parts(text, 50))
    assert "".join(made) == text and all(p.endswith(" ") for p in made[:-1]) and len(made) > 5
    assert list(r.parts("", 5)) == []


def test_the_memory_of_a_task_is_bounded(monkeypatch):
    monkeypatch.setattr(r, "REMEMBERED", 10)
    b = r.Bucketer(r.Features())
    text = " ".join(f"w{i}" for i in range(100))
    assert b.of(text)[1] == [crc32(f"w{i}".encode()) % 10_000 for i in range(100)] and len(b.known) <= 10


def test_ties_go_to_the_smaller_doc_id(spark):
    rows = spark.createDataFrame([(i, 30, i % 3) for i in range(60)], "doc_id long, n_words long, score long")
    made = {x["doc_id"]: x["rank"] for x in r.with_rank(rows, percent=50).collect()}
    order = sorted(range(60), key=lambda i: (-(i % 3), i))
    assert made == {i: k + 1 if k < 30 else None for k, i in enumerate(order)}


def test_edges(spark, edge, edge_rows, empty):
    target = spark.createDataFrame([("x", "own end", 1)], "item_id string, text string, score int")
    assert got(edge, target, percent=50) == by_hand(edge_rows, ["own end"], percent=50)
    assert r.resample(empty, target).count() == 0
    nothing = target.where("false")
    assert got(edge, nothing) == by_hand(edge_rows, [])
    kept = r.drawn(edge, target, percent=50)
    assert kept.columns == edge.columns
    assert {x["doc_id"] for x in kept.collect()} == {x[0] for x in by_hand(edge_rows, ["own end"], percent=50) if x[-1]}
