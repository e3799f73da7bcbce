"""Importance resampling towards a target: bucket histograms of words, log ratios as gains, a Gumbel draw.

An untrained Regex Split of the tokenizers library takes the words of a text
whose A-Z are in lower case, and their offsets. Words are joined by one space,
and a feature is what lies between the first offset of one word and the last of
another, for runs of ``low`` to ``high`` words. A feature's bucket is the crc32
of its UTF-8 bytes, modulo ``buckets``.

Each text is read once: its buckets are written as a list. Both histograms come
from per-task sums, so what is shuffled and what the driver gets has at most
``buckets`` rows a task, whatever the texts are. A row's rank among the drawn is
the number of rows with a higher score, from a table of rows per score, and its
place among those of its own score; scores are whole numbers between bounds
that do not grow with the input, so that table does not either.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField

from sessionlake.llm.arrow import STEP_BYTES, add_columns, small_batches
from sessionlake.llm.steps import step

#: A word: no ASCII characters but letters a-z and digits.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Windows whose bucket a task remembers; then it starts anew.
REMEMBERED = 1 << 17


@dataclass(frozen=True)
class Features:
    """Runs of ``low`` to ``high`` words, dealt into ``buckets`` (at most 2 ** 31)."""

    low: int = 1
    high: int = 1
    buckets: int = 10_000


def parts(text: str, limit: int = STEP_BYTES) -> Iterator[str]:
    """The text in parts of about ``limit`` characters that end after a blank, so no word is cut."""
    start = 0
    while start < len(text):
        cut = text.find(" ", start + limit) + 1 or len(text)
        yield text[start:cut]
        start = cut


class Bucketer:
    """Buckets of the features of texts, by the tokenizer's split."""

    def __init__(self, features: Features) -> None:
        from tokenizers import Regex, pre_tokenizers

        self.features, self.known = features, {}
        self.split = pre_tokenizers.Split(Regex(WORD), "removed", invert=True)

    def words(self, text: str) -> Iterator[list[str]]:
        """Words, a list for each part of the text."""
        for part in parts(text.encode().lower().decode()):
            yield [part[a:b] for _, (a, b) in self.split.pre_tokenize_str(part)]

    def _bucket(self, window: str) -> int:
        if (got := self.known.get(window)) is None:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            got = self.known[window] = crc32(window.encode()) % self.features.buckets
        return got

    def of(self, text: str) -> tuple[int, list[int]]:
        """Number of words, and the bucket of every feature."""
        n_words, out, tail = 0, [], []
        low, high = self.features.low, self.features.high
        for new in self.words(text):
            # the last words of a part are in windows of the next one too
            row, before = [*tail, *new], len(tail)
            joined = " ".join(row)
            ends = list(accumulate((len(w) + 1 for w in row), initial=0))
            for size in range(low, high + 1):
                first = max(0, before - size + 1)
                out += [self._bucket(joined[a : b - 1]) for a, b in zip(ends[first:], ends[first + size :], strict=False)]
            n_words += len(new)
            tail = row[len(row) - high + 1 :] if high > 1 else []
        return n_words, out


def with_buckets(docs: DataFrame, features: Features = Features(), drop: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` with ``n_words`` and ``feature_buckets``; a NULL text has no words."""
    held: list[Bucketer] = []

    def compute(part: pa.RecordBatch) -> dict[str, pa.Array]:
        if not held:
            held.append(Bucketer(features))
        got = [held[0].of(t or "") for t in part.column("text").to_pylist()]
        return {
            "n_words": pa.array([n for n, _ in got], pa.int64()),
            "feature_buckets": pa.array([b for _, b in got], pa.list_(pa.int32())),
        }

    fields = [StructField("n_words", LongType()), StructField("feature_buckets", ArrayType(IntegerType()))]
    texts = docs.withColumn("text", F.col("text").cast("string"))
    return add_columns(texts, "text", fields, compute, drop)


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of all lists in a row, and the n + 1 offsets."""
    at = column.offsets.to_numpy()
    return column.values.to_numpy(zero_copy_only=False)[at[0] : at[-1]] if len(column) else np.zeros(0, np.int32), at - at[0]


def histogram(rows: DataFrame, buckets: int) -> DataFrame:
    """(bucket, n) over ``feature_buckets``; a task sends each of its buckets once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(buckets, np.int64)
        for batch in batches:
            values, _ = _flat(batch.column(0))
            sums += np.bincount(values, minlength=buckets)
        held = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(sums[held])], ["bucket", "n"])

    sent = rows.select("feature_buckets").mapInArrow(run, "bucket long, n long")
    return sent.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, buckets: int) -> np.ndarray:
    """The gain of each bucket, in thousandths: log of its share in the target by its share in ``docs``, each count one higher."""
    sides = []
    for rows in (docs, target):
        counts = np.zeros(buckets, np.int64)
        for r in histogram(rows, buckets).collect():  # at most ``buckets`` rows
            counts[r["bucket"]] = r["n"]
        sides.append(counts.tolist())
    s_all, t_all = (float(sum(side) + buckets) for side in sides)
    return np.array([math.floor(1000 * math.log((t + 1) * s_all / ((s + 1) * t_all))) for s, t in zip(*sides, strict=True)], np.int64)


def with_weight(rows: DataFrame, gain: np.ndarray) -> DataFrame:
    """``rows`` with ``n_features`` and ``weight``, the floored mean gain of their features (none: 0), without the lists."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, at = _flat(batch.column("feature_buckets"))
            n = np.diff(at).astype(np.int64)
            sums = np.concatenate([[0], np.cumsum(gain[values])])
            weight = (sums[at[1:]] - sums[at[:-1]]) // np.maximum(n, 1)
            kept = [batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(n), pa.array(weight)], [*names, "n_features", "weight"])

    names = [f.name for f in rows.schema.fields if f.name != "feature_buckets"]
    schema = rows.drop("feature_buckets").schema.add("n_features", LongType()).add("weight", LongType())
    return rows.mapInArrow(compute, schema)


def with_score(rows: DataFrame, seed: int = 2024) -> DataFrame:
    """``rows`` with ``score``: the weight plus Gumbel noise that the doc_id alone decides, in thousandths."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("doc_id").cast("string")).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))
    return rows.withColumn("score", F.col("weight") + noise)


def with_rank(rows: DataFrame, percent: int = 10, min_words: int = 20) -> DataFrame:
    """``rows`` with ``rank``, 1 for the highest score; ``percent`` of the rows of ``min_words`` words or more have one.

    Reads ``rows`` twice. Rows of one score are ranked in one task, by doc_id.
    """
    can = (F.col("n_words") >= min_words) & F.col("score").isNotNull()
    over = Window.orderBy(F.col("score").desc())
    per_score = rows.where(can).groupBy("score").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(over.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    total = F.sum("n").over(Window.partitionBy())
    # rows per score: their number is that of the scores, not of the documents
    counted = per_score.select("score", before.alias("_before"), F.floor(percent * total / 100).alias("_drawn"))
    held = rows.join(counted.where("_before < _drawn"), "score", "left")
    inside = can & F.col("_before").isNotNull()
    place = F.col("_before") + F.row_number().over(Window.partitionBy("score").orderBy("doc_id"))
    ranked = held.where(inside).withColumn("rank", place).withColumn("rank", F.when(F.col("rank") <= F.col("_drawn"), F.col("rank")))
    rest = held.where(~inside).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(rest).select(*rows.columns, "rank")


def resample(
    docs: DataFrame, target: DataFrame, features: Features = Features(), percent: int = 10, min_words: int = 20, seed: int = 2024
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_features, weight, score and rank.

    ``rank`` is 1, 2, 3 ... by falling score, ties by smaller doc_id, for
    ``percent`` of the documents with ``min_words`` words or more, rounded down;
    NULL for all others. NULL and empty texts have no features and weight 0. A
    row without doc_id has no score and is not drawn. Repeated rows have equal
    scores and ranks of their own. Other columns are not read. An empty table
    gives no rows; an empty target gives gains all the same.
    """
    own = small_batches(docs.select(F.col("doc_id").cast("long"), "text"))
    rows = step(with_buckets(own, features, ("text",)), "features")
    wanted = step(with_buckets(target.select("text"), features, ("text",)), "target")
    weighed = with_score(with_weight(small_batches(rows), gains(rows, wanted, features.buckets)), seed)
    return with_rank(step(weighed, "scores"), percent, min_words)


def drawn(docs: DataFrame, target: DataFrame, **options: object) -> DataFrame:
    """The rows of ``docs`` that ``resample`` draws, by doc_id: one row of a repeated doc_id is enough for all of them."""
    ids = resample(docs, target, **options).where("rank IS NOT NULL").select("doc_id").distinct()
    return docs.join(ids.withColumnRenamed("doc_id", "_drawn_id"), docs["doc_id"] == F.col("_drawn_id"), "left_semi")
