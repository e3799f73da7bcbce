"""Packing by powers of two: each document falls into pieces of binary length, one piece a sequence.

A document of n tokens gives n // limit pieces of ``limit`` tokens and one
piece for each bit of the rest. Pieces of equal length share a bucket, from
which batches of one length are drawn. So nothing is padded and no sequence
crosses documents.
"""

from __future__ import annotations

import os
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionlake.llm.arrow import LOWER, NOT_BLANK, RangeHash, byte_table, slices, small_batches, text_bytes, words

#: Longest sequence.
LIMIT = 2048

#: Words whose ids a task remembers; it starts anew when they are more.
WORDS_KEPT = 1 << 20

#: Splits of the table that one task reads, so that most words it meets are known to it.
SPLITS = 4

#: Marks that may end a word.
MARKS = b".,;:!?"
IS_MARK = byte_table(lambda b: b in MARKS)
ASCII_LETTER = byte_table(lambda b: 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A)

#: A number of one digit, which is a token of its own.
BETWEEN = "0"

PIECE = "doc_id long, start long, length long, doc_tokens long, bucket int, ids binary"


class WordIds:
    """Ids of words without blanks, each encoded once, in arrays: a word is known by its 64-bit hash.

    New words are encoded as one text. Those of letters end with a token that
    ends a word. Between others stands a number that none of them has, which
    the tokenizer sets apart from any word. A mark after a letter is a token of
    its own, so such words are made of known ones.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        (self.between,) = self._ids(BETWEEN)
        names = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(names.values()) + 1, bool)
        self.ends[[i for name, i in names.items() if name.endswith("</w>")]] = True
        self.mark = np.zeros(256, "<u4")
        self.mark[list(MARKS)] = [self._ids(chr(m))[0] for m in MARKS]
        self.forget()

    def forget(self) -> None:
        self.hashes, self.begin, self.size = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pool = np.zeros(0, "<u4")

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where in the pool the ids of words begin, how many they are, and whether a word is known."""
        if not len(self.hashes):
            none = np.zeros(len(hashes), np.int64)
            return none, none, np.zeros(len(hashes), bool)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return self.begin[at], self.size[at], self.hashes[at] == hashes

    def _add(self, hashes: np.ndarray, size: np.ndarray, ids: np.ndarray) -> None:
        begin, order = len(self.pool) + np.cumsum(size) - size, np.argsort(hashes)
        self.pool = np.concatenate([self.pool, ids])
        at = np.searchsorted(self.hashes, hashes[order])
        self.hashes = np.insert(self.hashes, at, hashes[order])
        self.begin, self.size = np.insert(self.begin, at, begin[order]), np.insert(self.size, at, size[order])

    def _encode(self, hashes: np.ndarray, new: list[bytes]) -> None:
        """Add words and their ids."""
        mark = BETWEEN.encode()
        kind = np.array([0 if _is_letters(w) else 1 if mark not in w else 2 for w in new])
        letters = [w for w, k in zip(new, kind, strict=True) if k == 0]
        if letters:
            ids = np.array(self._ids(b" ".join(letters).decode()), "<u4")
            cuts = np.flatnonzero(self.ends[ids])
            if len(cuts) == len(letters):
                self._add(hashes[kind == 0], np.diff(cuts, prepend=-1), ids)
            else:
                kind[kind == 0] = 1
        others = [w for w, k in zip(new, kind, strict=True) if k == 1]
        if others:
            ids = np.array(self._ids(f" {BETWEEN} ".encode().join(others).decode()), "<u4")
            cuts = np.flatnonzero(ids == self.between)
            self._add(hashes[kind == 1], np.diff(np.concatenate([[-1], cuts, [len(ids)]])) - 1, ids[ids != self.between])
        if (kind == 2).any():
            each = [np.array(self._ids(w.decode()), "<u4") for w, k in zip(new, kind, strict=True) if k == 2]
            self._add(hashes[kind == 2], np.array([len(e) for e in each], np.int64), np.concatenate(each))

    def learn(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, hashes: RangeHash) -> None:
        """Make words known that are not."""
        marked = IS_MARK[data[end - 1]] & ASCII_LETTER[data[np.maximum(end - 2, start)]] & (end - start > 1)
        core, first, number = np.unique(hashes.of(start, end - marked), return_index=True, return_inverse=True)
        missing = np.flatnonzero(~self.find(core)[2])
        if len(missing):
            raw, spans = data.tobytes(), zip(start[first[missing]].tolist(), (end - marked)[first[missing]].tolist(), strict=True)
            self._encode(core[missing], [raw[a:b] for a, b in spans])
        own, at = np.unique(hashes.of(start[marked], end[marked]), return_index=True)
        begin, size, _ = self.find(core[number[marked][at]])
        ids = np.repeat(self.mark[data[end[marked][at] - 1]], size + 1)
        place = np.cumsum(size + 1) - (size + 1)
        ids[runs(place, size)] = self.pool[runs(begin, size)]
        self._add(own, size + 1, ids)


def _is_letters(word: bytes) -> bool:
    """Whether the tokenizer reads a word as one run of letters; some letters are a letter and a mark to it."""
    return word.isalpha() or (not word.isascii() and unicodedata.normalize("NFC", word.decode()).lower().isalpha())


def runs(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers from each ``begin`` on, ``size`` of them, one run after the other."""
    return np.arange(size.sum()) - np.repeat(np.cumsum(size) - size - begin, size)


def _lowered(data: np.ndarray) -> np.ndarray:
    """Bytes with A-Z in lower case, as the tokenizer reads words; as they are where that could change a word.

    That is where marks may combine with a letter (U+0300 to U+037F), and
    where a name of a special token may stand.
    """
    if ((data == 0xCC) | (data == 0xCD)).any() or b"<|" in data.tobytes():
        return data
    return LOWER[data]


def tokens(data: np.ndarray, at: np.ndarray, known: WordIds, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts one after the other, each with its end id, and how many each text has."""
    data = _lowered(data)
    starts, ends, text = words(data, at, NOT_BLANK)
    hashes = RangeHash(data)
    each, first, number = np.unique(hashes.of(starts, ends), return_index=True, return_inverse=True)
    if len(known.hashes) > WORDS_KEPT:
        known.forget()
    new = first[~known.find(each)[2]]
    if len(new):
        known.learn(data, starts[new], ends[new], hashes)
    begin, size, _ = known.find(each)
    length = size[number]
    counts = np.bincount(text, length, len(at) - 1).astype(np.int64) + 1
    out = np.full(counts.sum(), end_id, "<u4")
    # every word's ids go behind those before it and the end ids of earlier texts
    out[runs(np.cumsum(length) - length + text, length)] = known.pool[runs(begin[number], length)]
    return out, counts


def cut(counts: np.ndarray, limit: int = LIMIT) -> tuple[np.ndarray, np.ndarray]:
    """Text number and length of the pieces of texts with ``counts`` ids, in order, the longest first."""
    row, size = [np.repeat(np.arange(len(counts)), counts // limit)], [np.full((counts // limit).sum(), limit)]
    for bit in range(limit.bit_length() - 2, -1, -1):
        have = np.flatnonzero(counts % limit >> bit & 1)
        row.append(have)
        size.append(np.full(len(have), 1 << bit))
    rows = np.concatenate(row)
    order = np.argsort(rows, kind="stable")
    return rows[order], np.concatenate(size)[order]


def pack(docs: DataFrame, tokenizer_path: str, end_id: int = 1, limit: int = LIMIT) -> DataFrame:
    """The pieces of all documents, each a sequence of its own.

    Columns: doc_id, start (ids of the document before it), length, doc_tokens
    (with the end id), bucket (the length), ids (little-endian unsigned 32-bit),
    sequence_id (unique), offset (0). A NULL or empty text is the end id alone.
    Rows that repeat are packed each for itself; other columns are not read.

    The tokenizer of ``tokenizer_path`` must treat words between ASCII blanks
    apart from each other and drop the blanks, lower-case ASCII letters, and
    give each digit, and each mark after a letter, a token of its own. So each
    word is encoded once a task. ``limit`` is a power of two.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        known = WordIds(tokenizer_path)
        for batch in batches:
            for part in slices(batch, "text"):
                data, at = text_bytes(part.column("text"))
                ids, counts = tokens(data, at, known, end_id)
                yield _pieces(part.column("doc_id"), ids, counts)

    def _pieces(doc_ids: pa.Array, ids: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        row, size = cut(counts, limit)
        ends = np.cumsum(size)
        start = ends - size - (np.cumsum(counts) - counts)[row]
        offsets = np.concatenate([[0], 4 * ends]).astype(np.int32)
        data = pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(ids.tobytes())])
        columns = [doc_ids.take(pa.array(row)), *map(pa.array, (start, size, counts[row], size.astype(np.int32))), data]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "length", "doc_tokens", "bucket", "ids"])

    named = small_batches(docs).select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    splits, spark = named.rdd.getNumPartitions(), docs.sparkSession
    tasks = max(2 * spark.sparkContext.defaultParallelism, -(-splits // SPLITS))
    gathered = named.coalesce(tasks) if tasks < splits else named
    return gathered.mapInArrow(run, PIECE).select(
        "*", F.monotonically_increasing_id().alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
