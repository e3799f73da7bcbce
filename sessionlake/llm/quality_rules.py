"""Quality rules: statistics of whole texts, hard limits, and an isolation forest over the statistics.

The forest is grown from half of the rows labelled as good, each statistic as the
rareness of its value among them; a row whose path from the roots is short is
unlike them. The limit for the score comes from all labelled rows that the forest
has not seen. Every labelled row is counted, in the tasks: what the driver gets are
counts by step of each statistic and by leaf of each tree, which do not grow with
the rows, and the forest it sends out has a fixed size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType, StructField

from sessionlake.llm.arrow import NOT_BLANK, ODD, RangeHash, add_columns, byte_table, mixed, per_text, text_bytes, words
from sessionlake.llm.steps import step

TREES = 100

#: Levels of splits of a tree.
HEIGHT = 8

#: Steps of a doubling of a statistic, and the reciprocal of the least value that is told from 0.
STEPS = 1024
FINEST = 4096

#: Share of good rows that the limit may reject.
GOOD_LOSS = 0.002

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
LEVELS = tuple(f"{c}_level" for c in COUNTS[1:])
SYMBOL = byte_table(lambda b: chr(b) in "#*$%&|<>")
CHAR_START = byte_table(lambda b: b & 0xC0 != 0x80)


def statistics(data: np.ndarray, at: np.ndarray) -> dict[str, np.ndarray]:
    """The five counts of each text; a text without words has zeros but for its symbols."""
    n = len(at) - 1
    starts, ends, text = words(data, at, NOT_BLANK)
    hashes = RangeHash(data)
    inside = np.zeros(len(data) + 1, np.int64)
    np.cumsum(NOT_BLANK[data] & CHAR_START[data], out=inside[1:])
    symbols = np.zeros(len(data) + 1, np.int64)
    np.cumsum(SYMBOL[data], out=symbols[1:])
    return {
        "n_words": per_text(text, n),
        "word_chars": inside[at[1:]] - inside[at[:-1]],
        "n_symbols": symbols[at[1:]] - symbols[at[:-1]],
        "n_dup_lines": _dup_lines(data, at, starts, hashes),
        "n_repeat_words": _repeat_words(hashes.of(starts, ends), text, n),
    }


def _keys(hashes: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Hashes that are equal within one text only."""
    return mixed(hashes + (text.astype(np.uint64) + np.uint64(1)) * ODD)


def _dup_lines(data: np.ndarray, at: np.ndarray, word_starts: np.ndarray, hashes: RangeHash) -> np.ndarray:
    n = len(at) - 1
    cuts = np.flatnonzero(data == 0x0A)
    starts = np.sort(np.concatenate([at[:-1], cuts + 1]))
    ends = np.sort(np.concatenate([at[1:], cuts]))
    filled = np.searchsorted(word_starts, ends) > np.searchsorted(word_starts, starts)
    starts, ends = starts[filled], ends[filled]
    text = np.searchsorted(at, starts, "right") - 1
    keys = _keys(hashes.of(starts, ends), text)
    order = np.argsort(keys, kind="stable")
    again = np.zeros(len(keys), bool)
    again[order[1:]] = keys[order[1:]] == keys[order[:-1]]
    return per_text(text[again], n)


def _repeat_words(hashes: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
    if len(hashes) < 3:
        return np.zeros(n, np.int64)
    window = mixed(mixed(hashes[:-2] + ODD) + mixed(hashes[1:-1]) * np.uint64(3) + hashes[2:] * np.uint64(5))
    whole = np.flatnonzero(text[:-2] == text[2:])
    keys = _keys(window[whole], text[whole])
    order = np.argsort(keys)
    same = keys[order[1:]] == keys[order[:-1]]
    twice = np.zeros(len(keys), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    found, covered = whole[twice], np.zeros(len(hashes), bool)
    for k in range(3):
        covered[found + k] = True
    return per_text(text[covered], n)


def levels(counts: dict[str, np.ndarray]) -> np.ndarray:
    """Statistics per word, which do not grow with the text, as steps of ``STEPS`` to the octave.

    There are as many steps as doublings allow, however many rows there are, so
    all rows can be counted by step.
    """
    n = np.maximum(1, counts["n_words"]).astype(float)
    each = np.column_stack([counts[c] / n for c in COUNTS[1:]])
    return np.floor(STEPS * np.log2(1 + each * FINEST)).astype(np.int64)


def _mean_depth(n: np.ndarray) -> np.ndarray:
    """Mean path length of an unsuccessful search among ``n`` rows."""
    n = np.asarray(n, float)
    many = 2 * (np.log(np.maximum(n - 1, 1)) + np.euler_gamma) - 2 * (n - 1) / np.maximum(n, 1)
    return np.where(n > 2, many, np.where(n == 2, 1.0, 0.0))


@dataclass
class Forest:
    """Isolation trees in arrays (tree, node), node k above 2k + 1 and 2k + 2; ``limit`` is the largest score that passes."""

    steps: list[np.ndarray]  # of each statistic, those that good rows have
    rows_to: list[np.ndarray]  # how many good rows have that step or a lower one
    rows: int
    feature: np.ndarray
    cut: np.ndarray
    depth: np.ndarray | None = None  # path length of each leaf
    limit: float = np.inf

    def rareness(self, x: np.ndarray) -> np.ndarray:
        """How far out among the good rows each value lies: -log10 of its tail, negative for the lower one."""
        out = np.zeros(x.shape)
        for f, (step_, to) in enumerate(zip(self.steps, self.rows_to, strict=True)):
            to = np.append(0, to)
            above = self.rows - to[np.searchsorted(step_, x[:, f], "left")]
            below = to[np.searchsorted(step_, x[:, f], "right")]
            tail = -np.log10((np.minimum(above, below) + 1) / (self.rows + 1))
            out[:, f] = np.where(above < below, tail, -tail)
        return out

    def leaves(self, x: np.ndarray) -> Iterator[np.ndarray]:
        """The leaf that each row comes to, tree by tree."""
        x, at = self.rareness(x), np.arange(len(x))
        for feature, cut in zip(self.feature, self.cut, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(HEIGHT):
                node = 2 * node + 1 + (x[at, feature[node]] >= cut[node])
            yield node - len(feature)

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Between 0 and 1; near 1 for rows that few splits set apart."""
        total = np.zeros(len(x))
        for depth, leaf in zip(self.depth, self.leaves(x), strict=True):
            total += depth[leaf]
        return 2.0 ** -(total / len(self.depth) / max(1.0, float(_mean_depth(self.rows))))


def plant(steps: list[np.ndarray], rows_to: list[np.ndarray], trees: int = TREES, seed: int = 7) -> Forest:
    """Trees of ``HEIGHT`` levels that split at random values of random statistics, their leaves not yet counted.

    A value is drawn from the whole range that is left of a statistic, not only
    from where rows are. So one that no good row varies in still sets apart
    those that do, and no row is needed to draw the splits.
    """
    rows = int(rows_to[0][-1])
    rng, most_rare, inner = np.random.default_rng(seed), np.log10(rows + 1), (1 << HEIGHT) - 1
    feature, cut = rng.integers(len(steps), size=(trees, inner)), np.zeros((trees, inner))
    for t in range(trees):
        ranges = {0: (np.full(len(steps), -most_rare), np.full(len(steps), most_rare))}
        for node in range(inner):
            low, high = ranges.pop(node)
            f = feature[t, node]
            at = cut[t, node] = rng.uniform(low[f], high[f])
            up, down = low.copy(), high.copy()
            up[f], down[f] = at, at
            ranges[2 * node + 1], ranges[2 * node + 2] = (low, down), (up, high)
    return Forest(steps, rows_to, rows, feature, cut)


def path_lengths(counts: np.ndarray) -> np.ndarray:
    """Path length of each leaf from the rows in it: a path ends where fewer than two rows are left, or at a leaf."""
    trees, leaves = counts.shape
    out, ended = np.zeros((trees, leaves)), np.zeros((trees, leaves), bool)
    for level in range(HEIGHT + 1):
        inside = np.repeat(counts.reshape(trees, 1 << level, -1).sum(axis=2), leaves >> level, axis=1)
        here = ~ended & ((inside < 2) | (level == HEIGHT))
        out[here] = level + _mean_depth(inside[here])
        ended |= here
    return out


def _base_failed(counts: dict[str, np.ndarray]) -> np.ndarray:
    n = counts["n_words"]
    return (n < MIN_WORDS) | (100 * counts["n_repeat_words"] > MAX_REPEAT_PERCENT * n)


def _stat_arrays(counts: dict[str, np.ndarray]) -> dict[str, pa.Array]:
    return {c: pa.array(counts[c], pa.int64()) for c in COUNTS}


def _levels_of(part: pa.RecordBatch) -> np.ndarray:
    return np.column_stack([part.column(c).to_numpy() for c in LEVELS])


def _leaf_counts(rows: DataFrame, forest: Forest) -> np.ndarray:
    """How many of ``rows`` come to each leaf (tree, leaf); a task counts its own and sends one row a leaf."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(forest.feature), 1 << HEIGHT), np.int64)
        for batch in batches:
            for t, leaf in enumerate(forest.leaves(_levels_of(batch))):
                counts[t] += np.bincount(leaf, minlength=1 << HEIGHT)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts.reshape(-1)[at])], ["leaf", "n"])

    held = rows.mapInArrow(run, "leaf long, n long").groupBy("leaf").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(len(forest.feature) << HEIGHT, np.int64)
    counts[held["leaf"].to_numpy()] = held["n"].to_numpy()
    return counts.reshape(len(forest.feature), -1)


def fit_on_labels(docs: DataFrame, labels: DataFrame) -> Forest | None:
    """A forest of half of the good documents; its limit parts the other half from the bad ones.

    All labelled documents that the base rules pass take part; a hash of the
    doc_id tells the halves. The limit rejects at most ``GOOD_LOSS`` of the
    other half, and catches as many bad ones as it then can; where several
    limits do equally well, it lies in the middle of them. With fewer than two
    good documents there is no forest and all pass; where a half would be
    empty, both are all of them.
    """
    fields = [StructField(c, LongType()) for c in LEVELS] + [StructField("base_failed", BooleanType())]

    def compute(part: pa.RecordBatch) -> dict[str, pa.Array]:
        counts = statistics(*text_bytes(part.column("text")))
        made = dict(zip(LEVELS, (pa.array(x) for x in levels(counts).T), strict=True))
        return made | {"base_failed": pa.array(_base_failed(counts))}

    quality = (
        labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg((F.min(F.col("quality").cast("int")) == 1).alias("good"))
    )
    # counted before the join, so that no text is moved
    named = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    counted = add_columns(named, "text", fields, compute, drop=("text",)).where("NOT base_failed")
    half = F.pmod(F.xxhash64("doc_id", F.lit("forest")), F.lit(2)).cast("int")
    rows = step(counted.join(quality, "doc_id").select("good", half.alias("half"), *LEVELS), "labelled")
    sizes = {r["half"]: r["n"] for r in rows.where("good").groupBy("half").agg(F.count(F.lit(1)).alias("n")).collect()}
    if sum(sizes.values()) < 2:
        return None
    both = len(sizes) == 2
    grown = rows.where("good").where("half = 0" if both else "true")
    each = grown.unpivot([], list(LEVELS), "feature", "step").groupBy("feature", "step").agg(F.count(F.lit(1)).alias("n"))
    held = each.toPandas().sort_values("step")  # a row for each step that there is
    columns = [held[held["feature"] == c] for c in LEVELS]
    forest = plant([c["step"].to_numpy() for c in columns], [c["n"].cumsum().to_numpy() for c in columns])
    forest.depth = path_lengths(_leaf_counts(grown, forest))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("good"), pa.array(forest.scores(_levels_of(batch)))], ["good", "score"])

    judged = rows.where("NOT good OR half = 1" if both else "true").select("good", *LEVELS)
    scored = step(judged.mapInArrow(score, "good boolean, score double"), "scored")
    passing = sizes[1] if both else sum(sizes.values())
    rejected = passing - 1 - int(np.ceil((1 - GOOD_LOSS) * (passing - 1)))
    floor = scored.where("good").orderBy(F.desc("score")).offset(rejected).limit(1).first()["score"]
    above = scored.where(~F.col("good") & (F.col("score") > floor)).agg(F.min("score")).first()[0]
    forest.limit = floor if above is None else (floor + above) / 2
    return forest


def rate(docs: DataFrame, forest: Forest | None, drop: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` with the counts, ``base_failed``, ``anomaly`` and ``kept``.

    A NULL or empty text has no words and fails. ``anomaly`` is NULL where
    there is no forest; then only the base rules count. Every row is kept in
    the table; columns of the input with these names give way.
    """
    fields = [StructField(c, LongType()) for c in COUNTS]
    fields += [StructField("base_failed", BooleanType()), StructField("anomaly", DoubleType()), StructField("kept", BooleanType())]

    def compute(part: pa.RecordBatch) -> dict[str, pa.Array]:
        counts = statistics(*text_bytes(part.column("text")))
        failed = _base_failed(counts)
        score = forest.scores(levels(counts)) if forest else np.full(len(failed), np.nan)
        kept = ~failed & (score <= forest.limit) if forest else ~failed
        return _stat_arrays(counts) | {
            "base_failed": pa.array(failed), "anomaly": pa.array(score, from_pandas=True), "kept": pa.array(kept)
        }

    return add_columns(docs, "text", fields, compute, drop)


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that pass the rules and the forest, with their own columns."""
    rated = rate(docs, fit_on_labels(docs, labels))
    return rated.where("kept").select(*[F.col(f"`{c}`") for c in docs.columns if c not in _added()])


def _added() -> set[str]:
    return {*COUNTS, "base_failed", "anomaly", "kept"}
