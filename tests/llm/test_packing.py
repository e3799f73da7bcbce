from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from sessionlake.llm import packing
from sessionlake.llm.arrow import text_bytes

tokenizers = pytest.importorskip("public_tokenizers")
PATH = tokenizers.path("word_bpe_49k.json")


def test_pieces_are_binary_and_add_up():
    counts = np.array([1, 2, 3, 2047, 2048, 2049, 5000, 4096])
    row, size = packing.cut(counts)
    assert (np.bincount(row, size) == counts).all() and (size & (size - 1) == 0).all() and size.max() == 2048
    for i in range(len(counts)):
        own = size[row == i].tolist()
        assert own == sorted(own, reverse=True) and len({s for s in own if s < 2048}) == sum(s < 2048 for s in own)


def test_pieces_join_to_the_tokenizers_own_ids(spark, edge, edge_rows):
    whole = Tokenizer.from_file(PATH)
    rows = packing.pack(edge, PATH).collect()
    assert len({r["sequence_id"] for r in rows}) == len(rows)
    made = defaultdict(list)
    for r in rows:
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        assert len(ids) == r["length"] == r["bucket"] and r["offset"] == 0
        made[r["doc_id"]].append((r["start"], ids, r["doc_tokens"]))
    want = defaultdict(list)
    for i, text, *_ in edge_rows:
        want[i].append(whole.encode(text or "", add_special_tokens=False).ids + [1])
    for i, documents in want.items():
        got = sorted(made[i])
        assert sum(len(ids) for _, ids, _ in got) == sum(map(len, documents))
        if len(documents) == 1:
            assert [t for _, ids, _ in got for t in ids] == documents[0]
            assert [s for s, _, _ in got] == list(np.cumsum([0] + [len(ids) for _, ids, _ in got])[:-1])
            assert {n for _, _, n in got} == {len(documents[0])}


def test_a_word_forgotten_is_learned_again(spark, edge, monkeypatch):
    want = {(r["doc_id"], r["start"], bytes(r["ids"])) for r in packing.pack(edge, PATH).collect()}
    monkeypatch.setattr(packing, "WORDS_KEPT", 3)
    assert {(r["doc_id"], r["start"], bytes(r["ids"])) for r in packing.pack(edge, PATH).collect()} == want


def test_words_as_the_tokenizer_has_them():
    whole, known, rng = Tokenizer.from_file(PATH), packing.WordIds(PATH), random.Random(3)
    letters = list("abKSé.,;:!?'0½²_-<|>İΣςßÅ—😀ñ漢") + ["<|endoftext|>", "<|ENDOFTEXT|>", "\u0307", "\u030a", "W\u030a", "I\u0307", "\u0958", "'ll", "\xa0", "\x1c"]
    words = {"".join(rng.choice(letters) for _ in range(rng.randint(1, 7))).encode() for _ in range(20_000)}
    words = {w for w in words if len(w.split()) == 1}
    for texts in (words, sorted(words)[:3000], [w.replace(b"<|", b"") for w in words if w != b"<|"]):
        texts = [t for t in texts if len(t.split()) == 1]
        for part in range(0, len(texts), 700):
            own = texts[part : part + 700]
            ids, counts = packing.tokens(*text_bytes(pa.array([w.decode() for w in own])), known, 1)
            for w, got in zip(own, np.split(ids, np.cumsum(counts)[:-1]), strict=True):
                assert got.tolist() == [*whole.encode(w.decode(), add_special_tokens=False).ids, 1], w


def test_empty_table(empty):
    assert packing.pack(empty, PATH).count() == 0
