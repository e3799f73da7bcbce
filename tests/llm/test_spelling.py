from __future__ import annotations

import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest

from sessionlake.llm import spelling as s
from tests.llm.conftest import SCHEMA


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def counted(rows, every=31):
    out = Counter()
    for i, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate({k: k + 32 for k in range(65, 91)})
            h = crc32(f"{'' if i is None else i}:{run}".encode())
            if every and h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= 7 and n >= 2}


def by_hand(rows, every=31):
    words = counted(rows, every)
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    best = {w: min(vs, key=lambda v: (-words[v], v)) for w, vs in near.items() if vs}
    form = {w: v for w, v in best.items() if words[v] >= 10 * words[w]}

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {(w, n, len(near[w]), form.get(w), words.get(form.get(w)), root(w)) for w, n in words.items()}


def got(df, change):
    rows = s.group_variants(df, change).select("word", "n", "n_near", "form", "form_n", "root").collect()
    assert len({r["word"] for r in rows}) == len(rows)
    return {tuple(r) for r in rows}


def changed(rng, word, letters):
    i = rng.randrange(len(word))
    return rng.choice([word[:i] + word[i + 1 :], word[:i] + rng.choice(letters) + word[i + 1 :], word[:i] + rng.choice(letters) + word[i:]])


@pytest.mark.parametrize("letters", ["ab", "abcdefghé", "abcdefghijklmnopqrstuvwxyzÀÿ×"])
def test_as_by_all_pairs(spark, letters):
    rng = random.Random(len(letters))
    texts = []
    for _ in range(12):
        base = "".join(rng.choice(letters) for _ in range(rng.randint(6, 14)))
        chain = [base] * 1500 + [changed(rng, base, letters) for _ in range(3)] * 110
        for w in list(set(chain)):
            chain += [v for v in (changed(rng, w, letters) for _ in range(6)) for _ in range(rng.randint(2, 11))]
        texts.append(chain)
    rows = [(i, " ".join(c[k::4]), None, None, None) for i, c in enumerate(texts) for k in range(4)]
    df = spark.createDataFrame(rows, SCHEMA)
    want = by_hand(rows)
    assert got(df, s.with_deletions()) == want
    assert got(df, s.as_it_is) == by_hand(rows, 0)
    if len(letters) > 2:
        assert any(form and form != root for _, _, _, form, _, root in want)


def test_words_around_the_length_where_halves_begin(spark):
    rng = random.Random(5)
    words = set()
    for size in (s.LONG - 2, s.LONG - 1, s.LONG, s.LONG + 1, s.LONG + 2, 300):
        for _ in range(4):
            base = "".join(rng.choice("abcd") for _ in range(size))
            words |= {base} | {changed(rng, base, "abcd") for _ in range(8)}
    words = sorted(words)
    pairs = {tuple(r) for r in s.near_pairs(spark.createDataFrame([(w, len(w)) for w in words], "word string, n long")).collect()}
    assert {(a, b) for a, b, _ in pairs} == {(a, b) for a in words for b in words if one_edit(a, b)}
    assert all(n == len(b) for _, b, n in pairs)


def test_neighbourhoods_are_full():
    rng = random.Random(8)
    for size in (1, 2, 7, 12):
        word = "".join(rng.choice("abcdefghé") for _ in range(size))
        keys = set(s.neighbour_keys([word])[0].tolist())
        symbols = s._reduced([word])[0].tolist()
        strings = {tuple(symbols)} | {tuple(symbols[:i] + symbols[i + 1 :]) for i in range(size)}
        for c in range(1, s.SYMBOLS + 1):
            strings |= {tuple(symbols[:i] + [c] + symbols[i + 1 :]) for i in range(size)}
            strings |= {tuple(symbols[:i] + [c] + symbols[i:]) for i in range(size + 1)}

        def key(string):
            powers = s._powers(max(1, len(string)))[: len(string)]
            return int(s.mixed((np.array(string, np.uint64) * powers).sum(keepdims=True))[0])

        assert keys == {key(x) for x in strings}


def test_counts_are_sent_on_in_between(spark, monkeypatch):
    rows = [(i, "quadrant Quadrants quarrels " * 3, None, None, None) for i in range(4)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert {tuple(r) for r in s.vocabulary(df).collect()} == set(counted(rows, 0).items())


def test_edges(spark, edge, edge_rows, empty):
    assert got(edge, s.with_deletions()) == by_hand(edge_rows)
    assert s.group_variants(empty).count() == 0
    lone = spark.createDataFrame([(None, "alphabet alphabet alphabét", "x", None, None)] * 2, SCHEMA)
    assert got(lone, s.as_it_is) == {("alphabet", 4, 1, None, None, "alphabet"), ("alphabét", 2, 1, None, None, "alphabét")}
