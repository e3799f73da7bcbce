"""Quality by nearest-neighbour voting in a latent-semantic space.

A text's terms are its byte trigrams, its words' shapes and how its words
repeat, in ``TERMS`` counts. Their shares, weighted by rarity, are brought to
``RANK`` dimensions by the singular vectors of labelled rows. Every text is
compared with all labelled vectors by exact cosine products, in blocks, and its
nearest neighbours vote with their similarity.

The labelled rows are at most ``ROWS_PER_LABEL`` of each label, so what is sent
out is bounded: 2 * ROWS_PER_LABEL * RANK numbers and TERMS * RANK numbers.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, IntegerType, StructField

from sessionlake.llm.arrow import NOT_BLANK, ODD, RangeHash, add_columns, byte_table, mixed, text_bytes, words

ROWS_PER_LABEL = 3072
RANK = 48

# Terms of each kind: hashed trigrams, word shapes, kinds of repetition.
GRAMS, SHAPES, REPEATS = 1916, 128, 4
KINDS = (0, GRAMS, GRAMS + SHAPES, GRAMS + SHAPES + REPEATS)
TERMS = KINDS[-1]
NEIGHBOURS = 15

#: Texts whose products with all labelled vectors are held at a time.
BLOCK = 512

UPPER = byte_table(lambda b: 0x41 <= b <= 0x5A)
DIGIT = byte_table(lambda b: 0x30 <= b <= 0x39)
MARK = byte_table(lambda b: 0x21 <= b <= 0x2F or 0x3A <= b <= 0x40 or 0x5B <= b <= 0x60 or 0x7B <= b <= 0x7E)


def _counts_between(flags: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(flags)])
    return sums[ends] - sums[starts]


def term_counts(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How often each hashed term occurs in each text (text, term)."""
    n = len(at) - 1
    out = np.zeros((n, TERMS), np.float32)
    if not len(data):
        return out
    starts, ends, text = words(data, at, NOT_BLANK)
    # trigrams of bytes inside one text
    wide = data.astype(np.uint64)
    gram = mixed((wide[:-2] << np.uint64(16)) + (wide[1:-1] << np.uint64(8)) + wide[2:] + ODD) if len(data) > 2 else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(n), np.diff(at))
    inside = owner[:-2] == owner[2:] if len(data) > 2 else np.zeros(0, bool)
    # the shape of each word: its upper-case letters, digits and marks, up to three of each, and whether it ends with a mark
    shape = [np.minimum(_counts_between(t[data], starts, ends), 3) for t in (UPPER, DIGIT, MARK)]
    shape_key = shape[0] * 16 + shape[1] * 4 + shape[2] + 64 * MARK[data[ends - 1]] if len(starts) else np.zeros(0, np.int64)
    # words that have come before: right before, or anywhere in the text
    key = mixed(RangeHash(data).of(starts, ends) + (text.astype(np.uint64) + np.uint64(1)) * ODD)
    order = np.argsort(key, kind="stable")
    again = np.zeros(len(key), np.int64)
    again[order[1:]] = key[order[1:]] == key[order[:-1]]
    again[1:] += 2 * (key[1:] == key[:-1])
    number = [
        (owner[:-2][inside], (gram[inside] % np.uint64(GRAMS)).astype(np.int64)),
        (text, GRAMS + shape_key),
        (text, GRAMS + SHAPES + again),
    ]
    for of, term in number:
        out += np.bincount(of * TERMS + term, minlength=n * TERMS).reshape(n, TERMS)
    return out


def _weighted(counts: np.ndarray, rarity: np.ndarray) -> np.ndarray:
    """Square roots of the terms' shares of their kind, weighted, of length 1: each kind counts alike, long texts as short ones."""
    x = np.empty_like(counts)
    for a, b in zip(KINDS, KINDS[1:], strict=False):
        own = counts[:, a:b]
        x[:, a:b] = np.sqrt(own / np.maximum(own.sum(1, keepdims=True), 1))
    x *= rarity
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


@dataclass
class Voters:
    """Labelled vectors of length 1, their labels, and the way from counts to vectors."""

    rarity: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray

    def place(self, counts: np.ndarray) -> np.ndarray:
        x = (_weighted(counts, self.rarity) @ self.axes).astype(np.float32)
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)

    def scores(self, counts: np.ndarray) -> np.ndarray:
        """Share of label 1 among the neighbours' similarities."""
        out = np.zeros(len(counts))
        k = min(NEIGHBOURS, len(self.vectors))
        for a in range(0, len(counts), BLOCK):
            near = self.place(counts[a : a + BLOCK]) @ self.vectors.T
            least = np.partition(near, -k, axis=1)[:, -k, None]
            # of equally near ones those that come first: of the smallest doc_id
            equal = near == least
            spare = k - (near > least).sum(1, keepdims=True)
            best = np.nonzero((near > least) | (equal & (np.cumsum(equal, axis=1, dtype=np.int16) <= spare)))[1].reshape(-1, k)
            weight = np.maximum(np.take_along_axis(near, best, 1), 1e-6).astype(float)
            out[a : a + BLOCK] = (weight * self.labels[best]).sum(1) / weight.sum(1)
        return np.clip(out, 0.0, 1.0)


def fit(counts: np.ndarray, labels: np.ndarray) -> Voters | None:
    """Axes from the labelled rows' own counts; None without rows."""
    if not len(counts):
        return None
    seen = (counts > 0).sum(0)
    rarity = (np.log((1 + len(counts)) / (1 + seen)) + 1).astype(np.float32)
    x = _weighted(counts, rarity)
    _, vectors = np.linalg.eigh(x.T @ x)  # singular vectors of x, the largest last
    made = Voters(rarity, np.ascontiguousarray(vectors[:, ::-1][:, :RANK]).astype(np.float32), x, labels)
    made.vectors = made.place(counts)
    return made


def _packed(counts: np.ndarray) -> pa.Array:
    press = zstandard.ZstdCompressor(1)
    return pa.array([press.compress(c.astype("<f4").tobytes()) for c in counts], pa.binary())


def fit_on_labels(docs: DataFrame, labels: DataFrame, may_learn: Column) -> Voters | None:
    """Voters from labelled rows of which ``may_learn`` (over doc_id) holds, by the smallest hashes of doc_id."""
    order = F.xxhash64(F.col("doc_id"), F.lit("voters"))
    known = (
        labels.where("doc_id IS NOT NULL AND quality IN (0, 1)")
        .select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
        .where(may_learn)
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
    )
    parts = [known.where(F.col("quality") == q).orderBy(order, "doc_id").limit(ROWS_PER_LABEL) for q in (0, 1)]
    chosen = parts[0].unionByName(parts[1])
    named = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    sample = named.join(F.broadcast(chosen), "doc_id")  # at most 2 * ROWS_PER_LABEL rows
    counted = add_columns(
        sample, "text", [StructField("counts", BinaryType())],
        lambda part: {"counts": _packed(term_counts(*text_bytes(part.column("text"))))}, drop=("text",),
    )
    rows = counted.orderBy(order, "doc_id", F.xxhash64("counts")).limit(2 * ROWS_PER_LABEL).collect()
    rows = sorted(rows, key=lambda r: (r["doc_id"], bytes(r["counts"])))
    unpress = zstandard.ZstdDecompressor()
    counts = np.stack([np.frombuffer(unpress.decompress(r["counts"]), "<f4") for r in rows]) if rows else np.zeros((0, TERMS), np.float32)
    return fit(counts, np.array([r["quality"] for r in rows], float))


def vote(docs: DataFrame, voters: Voters | None, drop: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher for label 1) and ``predicted``.

    Of neighbours that are equally near those of smaller doc_id vote. NULL and
    empty texts have no terms: their vector is zero, all are equally near, and
    the score is that of the first by doc_id. Without voters all
    scores are 0.5. Columns of the input with these names give way.
    """

    def compute(part: pa.RecordBatch) -> dict[str, pa.Array]:
        data, at = text_bytes(part.column("text"))
        score = voters.scores(term_counts(data, at)) if voters else np.full(len(at) - 1, 0.5)
        return {"score": pa.array(score), "predicted": pa.array((score >= 0.5).astype(np.int32))}

    return add_columns(docs, "text", [StructField("score", DoubleType()), StructField("predicted", IntegerType())], compute, drop)
