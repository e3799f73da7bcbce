"""Language identification with a linear-chain conditional random field over words.

Every word of a line gets a score for each language from its letters: hashed
byte trigrams with the word's edges, affixes of two to four bytes, and whether
it stands in the lexicon of frequent training words. Learned transitions join
the words of a line. Forward-backward gives each word's chances, so words of a
code-switched text can differ; the text's language is that with most words.

The model is fitted on at most ``FIT_LINES`` lines of ``FIT_DOCS`` labelled
documents. What is sent out has ``TABLE + LEXICON`` rows of one number for
each language.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField

from sessionlake.llm.arrow import LOWER, ODD, RangeHash, add_columns, byte_table, mixed, salt, text_bytes

FIT_DOCS = 3000
FIT_LINES = 12_000

#: Longest line in bytes that the model is fitted on; longer ones are cut at blanks into several.
FIT_BYTES = 2000

TABLE = 1 << 16
LEXICON = 1 << 14
AFFIXES = (2, 3, 4)
EPOCHS = 4
BATCH = 200

#: Text bytes worked on at a time; longer chains of words are fewer steps if many lines go together.
PART_BYTES = 4 << 20

NO_LANGUAGE = "und"

#: Bytes of words, after A-Z is in lower case: a-z and all but ASCII.
LETTER = byte_table(lambda b: 0x61 <= b <= 0x7A or b >= 0x80)
ASCII_LETTER = byte_table(lambda b: 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A)


@dataclass
class Words:
    """Words of several texts with their features; lines are chains."""

    text: np.ndarray  # text number of each word
    line: np.ndarray  # words of each line with words
    gram: np.ndarray  # table row of each letter's trigram
    first_gram: np.ndarray  # where each word's trigrams begin
    affix: np.ndarray  # (word, affix) table rows; -1 where the word is too short
    whole: np.ndarray  # hash of each word


def read_words(data: np.ndarray, at: np.ndarray) -> Words:
    n = len(at) - 1
    owner = np.repeat(np.arange(n), np.diff(at))
    # a blank before each text, and one at the end, so that words have edges
    padded = np.full(len(data) + n + 1, 0x0A, np.uint8)
    padded[np.arange(len(data)) + owner + 1] = LOWER[data]
    letter = LETTER[padded]
    edge = np.flatnonzero(letter[1:] != letter[:-1]) + 1
    starts, ends = edge[::2], edge[1::2]
    text = np.searchsorted(at + np.arange(n + 1), starts, "right") - 1
    newline = np.cumsum(padded == 0x0A)
    line = np.unique(newline[starts], return_counts=True)[1] if len(starts) else np.zeros(0, np.int64)
    shown = np.where(letter, padded, 0x20).astype(np.uint64)
    place = np.flatnonzero(letter)
    gram = mixed((shown[place - 1] << np.uint64(16)) + (shown[place] << np.uint64(8)) + shown[place + 1] + ODD) % np.uint64(TABLE)
    hashes, size = RangeHash(padded), ends - starts
    affix = np.full((len(starts), 2 * len(AFFIXES)), -1, np.int64)
    for k, length in enumerate(AFFIXES):
        fit = np.flatnonzero(size >= length)
        for side, begin in ((0, starts[fit]), (1, ends[fit] - length)):
            key = mixed(hashes.of(begin, begin + length) + salt(2 * k + side + 1))
            affix[fit, 2 * k + side] = (key % np.uint64(TABLE)).astype(np.int64)
    return Words(text, line, gram.astype(np.int64), np.cumsum(size) - size, affix, hashes.of(starts, ends))


def marginals(scores: np.ndarray, line: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward-backward over all lines at once: each word's chances, and the expected moves between labels."""
    n, k = scores.shape
    forward, backward = np.empty((n, k)), np.ones((n, k))
    emit = np.exp(scores - scores.max(1, keepdims=True))
    step = np.exp(moves)
    order = np.argsort(-line, kind="stable")
    start = (np.cumsum(line) - line)[order]
    # lines that have a word at each place: the first ``alive`` in this order
    alive = np.searchsorted(-line[order], -np.arange(1, (line.max() if len(line) else 0) + 1), "right")
    now = emit[start]
    for t, m in enumerate(alive.tolist()):
        if t:
            now = (now[:m] @ step) * emit[start[:m] + t]
        now = now / now.sum(1, keepdims=True)
        forward[start[:m] + t] = now
    later = np.ones((len(line), k))
    for t in range(len(alive) - 2, -1, -1):
        m = alive[t + 1]
        at = start[:m] + t + 1
        back = (later[:m] * emit[at]) @ step.T
        later[:m] = back / back.sum(1, keepdims=True)
        backward[at - 1] = later[:m]
    chances = forward * backward
    chances /= chances.sum(1, keepdims=True)
    inner = np.ones(n, bool)
    inner[np.cumsum(line) - line] = False
    at = np.flatnonzero(inner)
    left, right = forward[at - 1], emit[at] * backward[at]
    norm = ((left @ step) * right).sum(1, keepdims=True)
    return chances, (left / np.maximum(norm, 1e-300)).T @ right * step


@dataclass
class Model:
    labels: list[str]
    table: np.ndarray
    lexicon: np.ndarray  # sorted word hashes
    lexical: np.ndarray
    moves: np.ndarray

    def entries(self, w: Words) -> np.ndarray:
        """Lexicon row of each word; -1 if it is not there."""
        if not len(self.lexicon):
            return np.full(len(w.whole), -1)
        at = np.minimum(np.searchsorted(self.lexicon, w.whole), len(self.lexicon) - 1)
        return np.where(self.lexicon[at] == w.whole, at, -1)

    def scores(self, w: Words) -> np.ndarray:
        if not len(w.whole):
            return np.zeros((0, len(self.labels)))
        out = np.add.reduceat(self.table[w.gram], w.first_gram, axis=0)
        for column in w.affix.T:
            out += np.where((column >= 0)[:, None], self.table[column], 0)
        entry = self.entries(w)
        return out + np.where((entry >= 0)[:, None], self.lexical[entry], 0) if len(self.lexicon) else out

    def label(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, Words]:
        """Each text's best label and its share of the words' chances, and the words' own chances."""
        w = read_words(data, at)
        chances, _ = marginals(self.scores(w).astype(float), w.line, self.moves)
        n = len(at) - 1
        total = np.column_stack([np.bincount(w.text, chances[:, k], n) for k in range(len(self.labels))])
        share = total / np.maximum(total.sum(1, keepdims=True), 1e-9)
        return share.argmax(1), np.clip(share.max(1), 0, 1), chances


def fit(lines: list[tuple[str, str]], epochs: int = EPOCHS, seed: int = 5) -> Model | None:
    """Gradient steps on the likelihood of labelled lines (text, language).

    Lines are joined in random pairs, so that transitions are learned between
    languages too. Steps shrink with the gradients that a weight has seen.
    """
    labels = sorted({lang for _, lang in lines})
    if not labels:
        return None
    k, rng = len(labels), np.random.default_rng(seed)
    texts, own = [t.replace("\n", " ") for t, _ in lines], np.array([labels.index(lang) for _, lang in lines])
    everything = read_words(*text_bytes(pa.array(texts, pa.string())))
    found, seen = np.unique(everything.whole, return_counts=True)
    frequent = np.sort(found[np.argsort(-seen, kind="stable")[:LEXICON]])
    model = Model(labels, np.zeros((TABLE, k)), frequent, np.zeros((len(frequent), k)), np.zeros((k, k)))
    held = {name: np.full_like(getattr(model, name), 1e-6) for name in ("table", "lexical", "moves")}

    def follow(name: str, gradient: np.ndarray, rate: float) -> None:
        weights = getattr(model, name)
        gradient = gradient + 1e-4 * weights
        held[name] += gradient**2
        weights -= rate * gradient / np.sqrt(held[name])

    for _ in range(epochs):
        order = rng.permutation(len(texts))
        for a in range(0, len(order), 2 * BATCH):
            chosen = order[a : a + 2 * BATCH]
            w = read_words(*text_bytes(pa.array([texts[i] for i in chosen], pa.string())))
            if not len(w.whole):
                continue
            truth, pair = own[chosen][w.text], w.text // 2
            w.line = np.unique(pair, return_counts=True)[1]  # a chain is two texts
            chances, moves = marginals(model.scores(w), w.line, model.moves)
            wrong = chances.copy()
            wrong[np.arange(len(truth)), truth] -= 1
            wrong /= len(truth)
            inner = np.flatnonzero(pair[1:] == pair[:-1])
            np.add.at(moves, (truth[inner], truth[inner + 1]), -1)
            of_gram = np.repeat(np.arange(len(w.whole)), np.diff(np.append(w.first_gram, len(w.gram))))
            rows = np.concatenate([w.gram, *[c[c >= 0] for c in w.affix.T]])
            of = np.concatenate([of_gram, *[np.flatnonzero(c >= 0) for c in w.affix.T]])
            entry = model.entries(w)
            known = np.flatnonzero(entry >= 0)
            follow("table", np.column_stack([np.bincount(rows, wrong[of, x], TABLE) for x in range(k)]), 0.2)
            if len(frequent):
                follow("lexical", np.column_stack([np.bincount(entry[known], wrong[known, x], len(frequent)) for x in range(k)]), 0.2)
            follow("moves", moves / len(truth), 0.1)
    model.table, model.lexical = model.table.astype(np.float32), model.lexical.astype(np.float32)
    return model


def _lines(text: Column) -> Column:
    """The lines of a text; one of over ``FIT_BYTES`` bytes in pieces, cut at blanks where it has any.

    A character has at most four bytes, so pieces are counted in characters.
    """
    size = FIT_BYTES // 4
    piece = rf"(?s)\S.{{0,{size - 2}}}(?!\S)|\S{{1,{size}}}"
    cut = lambda line: F.when(F.octet_length(line) <= FIT_BYTES, F.array(line)).otherwise(
        F.regexp_extract_all(line, F.lit(piece), F.lit(0))
    )
    return F.flatten(F.transform(F.split(text, "\n"), cut))


def fit_on_documents(docs: DataFrame, may_learn: Column) -> Model | None:
    """A model from documents with text and language of which ``may_learn`` (over doc_id) holds.

    Documents are chosen by a hash of doc_id, weighted so that each language
    gives about as many; their lines by a hash too, weighted so that each
    document gives about as many, or all it has.
    """
    known = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & may_learn)
    ids = known.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"))
    sizes = ids.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    chance = F.shiftrightunsigned(F.xxhash64("doc_id", F.lit("crf")), 12)
    chosen = (
        ids.join(sizes, "lang").orderBy(chance.cast("double") * F.col("n"), "doc_id", "lang").limit(FIT_DOCS).select("doc_id", "lang")
    )
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string"))
    lines = text.join(F.broadcast(chosen.distinct()), ["doc_id", "lang"])  # at most FIT_DOCS rows
    lines = lines.select("doc_id", "lang", F.filter(_lines(F.col("text")), lambda x: F.octet_length(x) > 0).alias("lines"))
    lines = lines.select("doc_id", "lang", F.size("lines").alias("n"), F.explode("lines").alias("line"))
    drawn = F.shiftrightunsigned(F.xxhash64("line", "doc_id"), 12).cast("double") * F.col("n")
    rows = lines.orderBy(drawn, "line", "lang").limit(FIT_LINES).collect()
    return fit([(r["line"], r["lang"]) for r in rows])


def identify(docs: DataFrame, model: Model | None, drop: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (the predicted language's share of the words' chances).

    A text that is NULL or has no letter is ``und`` with score 0, and so is
    every text where there is no model. Equal chances give the first language
    by name. Columns of the input with these names give way.
    """

    def compute(part: pa.RecordBatch) -> dict[str, pa.Array]:
        column = part.column("text")
        data, at = text_bytes(column)
        n = len(at) - 1
        letters = np.zeros(len(data) + 1, np.int64)
        np.cumsum(ASCII_LETTER[data], out=letters[1:])
        has = letters[at[1:]] > letters[at[:-1]]
        for i in np.flatnonzero(~has & (at[1:] > at[:-1])):
            has[i] = any(c.isalpha() for c in column[int(i)].as_py())
        if model is None or not n:
            best, share, names = np.zeros(n, int), np.zeros(n), [NO_LANGUAGE]
            has[:] = False
        else:
            best, share, _ = model.label(data, at)
            names = model.labels
        return {
            "lang_pred": pa.array([names[b] if h else NO_LANGUAGE for b, h in zip(best, has, strict=True)], pa.string()),
            "score": pa.array(np.where(has, share, 0.0)),
        }

    return add_columns(docs, "text", [StructField("lang_pred", StringType()), StructField("score", DoubleType())], compute, drop, PART_BYTES)
