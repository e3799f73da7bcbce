"""Spelling variants: vocabulary words one edit apart, found in a reduced alphabet.

Letters are hashed to ``SYMBOLS`` symbols, by code point modulo their number. If two words are one insertion,
deletion or replacement apart, so are their reduced words, or these are equal.
So each word sends its reduced word once, and the full neighbourhood of its
reduced word within one edit as 64-bit keys; equal keys join, and pairs are
verified on the words themselves, in the join. A key that two strings share by
chance only makes a candidate more. Keys are dealt into ``PASSES`` by their
value, and a pass ends with its pairs written, so that the neighbourhoods of the
whole vocabulary are never on disk at once.

The neighbourhood grows with the word's length. Words of ``LONG`` code points or
more are found by halves instead: one edit leaves the first or the last half of
both as it was. Words of that length itself go both ways, so no pair of
neighbouring lengths is missed.

Words are counted in tasks before they are shuffled, so a word that is a third
of all occurrences costs one row a flush. A word has no more near words than its
length and the alphabet allow, so no group after the verification is large.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from sessionlake.llm.arrow import mixed, slices, small_batches
from sessionlake.llm.steps import step

#: Symbols of the reduced alphabet.
SYMBOLS = 6

#: Shares of the keys that are joined one after the other.
PASSES = 8

#: Code points from which on words are found by halves.
LONG = 48

#: Words a task counts before it sends them on.
COUNTED = 1 << 18

#: Keys made in one step: words times keys of a word.
STEP_KEYS = 1 << 20

RUN = re.compile("[A-Za-zÀ-ÿ]+")

_BASE = np.uint64(0x9E6C63D0876A9A47)


def as_it_is(doc_id: object, run: str) -> str:
    """The run unchanged."""
    return run


def with_deletions(every: int = 31) -> Callable[[object, str], str]:
    """Runs that lose one code point where ``every`` divides the crc32 of ``doc_id:run``; a NULL doc_id is empty text."""

    def changed(doc_id: object, run: str) -> str:
        h = crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
        return run if h % every else run[: h % len(run)] + run[h % len(run) + 1 :]

    return changed


def vocabulary(docs: DataFrame, change: Callable[[object, str], str] = as_it_is, min_length: int = 7, min_count: int = 2) -> DataFrame:
    """(word, n): runs of letters, A-Z in lower case, passed through ``change``, with their occurrences in all texts."""

    def sent(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for part in slices(batch, "text"):
                for doc_id, text in zip(*(part.column(c).to_pylist() for c in ("doc_id", "text")), strict=True):
                    own = Counter(RUN.findall((text or "").encode().lower().decode()))
                    for word, n in own.items():
                        # a run loses one code point at most
                        if len(word) >= min_length and len(word := change(doc_id, word)) >= min_length:
                            counts[word] += n
                    if len(counts) >= COUNTED:
                        yield sent(counts)
                        counts.clear()
        yield sent(counts)

    own = docs.select(F.col("doc_id").cast("string"), F.col("text").cast("string"))
    found = small_batches(own).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return found.where(F.col("n") >= min_count)


def _reduced(words: list[str]) -> np.ndarray:
    """Symbols of words of one length (word, place), from 1."""
    points = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.uint64).reshape(len(words), -1)
    return points % np.uint64(SYMBOLS) + np.uint64(1)


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE, np.uint64)
    out[:1] = 1
    return np.cumprod(out, out=out)


def own_keys(words: list[str]) -> np.ndarray:
    """The key of each reduced word; all have one length."""
    symbols = _reduced(words)
    return mixed((symbols * _powers(symbols.shape[1])).sum(axis=1))


def neighbour_keys(words: list[str]) -> np.ndarray:
    """Keys of the reduced words and of all strings one edit from them (word, key), with repeats; all words have one length."""
    symbols = _reduced(words)
    n, size = symbols.shape
    powers = _powers(size + 1)
    weighed = symbols * powers[:size]
    until = np.concatenate([np.zeros((n, 1), np.uint64), np.cumsum(weighed, axis=1)], axis=1)
    whole = until[:, -1:]
    rest = whole - until  # from each place on, at the powers they have
    every = np.arange(1, SYMBOLS + 1, dtype=np.uint64)
    # without the symbol at i, what follows moves one place down
    after = np.concatenate([np.cumsum((symbols[:, 1:] * powers[: size - 1])[:, ::-1], axis=1)[:, ::-1], np.zeros((n, 1), np.uint64)], axis=1)
    deleted = until[:, :-1] + after
    replaced = whole[:, :, None] + (every - symbols[:, :, None]) * powers[:size, None]
    inserted = (until + rest * _BASE)[:, :, None] + every * powers[:, None]
    return mixed(np.concatenate([whole, deleted, replaced.reshape(n, -1), inserted.reshape(n, -1)], axis=1))


def _by_length(words: list[str]) -> Iterator[list[str]]:
    groups: dict[int, list[str]] = {}
    for w in words:
        groups.setdefault(len(w), []).append(w)
    for size, group in groups.items():
        many = max(1, STEP_KEYS // (2 * SYMBOLS * (size + 1)))
        for i in range(0, len(group), many):
            yield group[i : i + many]


def _keyed(words: DataFrame, make: Callable[[list[str]], np.ndarray], turn: int) -> DataFrame:
    """(key, *columns of words) for the keys of one pass, each key of a word once."""
    names = words.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = {w: i for i, w in enumerate(batch.column("word").to_pylist())}
            for group in _by_length(list(rows)):
                keys = np.sort(make(group).reshape(len(group), -1), axis=1)
                held = keys % np.uint64(PASSES) == turn
                held[:, 1:] &= keys[:, 1:] != keys[:, :-1]
                own = np.repeat([rows[w] for w in group], held.sum(axis=1))
                part = batch.take(pa.array(own, pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(keys[held].view(np.int64)), *part.columns], ["key", *names])

    schema = StructType([StructField("key", LongType()), *words.schema.fields])
    return small_batches(words).mapInArrow(run, schema)


def _halves(words: DataFrame) -> DataFrame:
    """(key, *columns of words): for lengths that differ by one at most, equal halves have equal keys."""
    n = F.length("word")

    def half(side: int, size: Column) -> Column:
        part = F.substr("word", F.lit(1), size) if side == 0 else F.substr("word", n - size + 1, size)
        return F.xxhash64(F.lit(side), part)

    first = [half(0, F.floor(n / 2).cast("int")), half(0, F.floor((n - 1) / 2).cast("int"))]
    last = [half(1, F.floor((n + 1) / 2).cast("int")), half(1, F.floor(n / 2).cast("int"))]
    return words.select(F.explode(F.array_distinct(F.array(*first, *last))).alias("key"), *words.columns)


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, near, near_n): all ordered pairs of ``words`` (word, n) one inserted, deleted or replaced code point apart."""
    size = F.length("word")
    short, long = words.where(size <= LONG), words.where(size >= LONG)

    def as_near(keyed: DataFrame) -> DataFrame:
        return keyed.select("key", F.col("word").alias("near"), F.col("n").alias("near_n"))

    apart = F.abs(F.length("word") - F.length("near")) <= 1
    one_edit = apart & (F.col("word") != F.col("near")) & (F.levenshtein("word", "near", 1) == 1)
    halves = _halves(long)
    # pairs of two words of LONG are among those of the neighbourhoods
    longer = F.greatest(F.length("word"), F.length("near")) > LONG
    found = halves.drop("n").join(as_near(halves), "key").where(one_edit & longer).select("word", "near", "near_n").distinct()
    found = step(found, "long_pairs")
    for turn in range(PASSES):
        asked = _keyed(short.select("word"), neighbour_keys, turn).join(as_near(_keyed(short, own_keys, turn)), "key")
        found = found.unionByName(step(asked.where(one_edit).select("word", "near", "near_n"), "pairs"))
    return found


def with_roots(forms: DataFrame) -> DataFrame:
    """``forms`` (word, form, ...) with ``root``: from the word, forms followed to the last.

    A form is more frequent than its word, so there are no circles. Each round
    doubles the steps of a word that are behind it.
    """
    steps = step(forms.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = step(steps.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("on")), "roots")
        steps = moved.select("word", "root")
        if moved.where("on").isEmpty():
            break
    return forms.join(steps, "word", "left").withColumn("root", F.coalesce("root", "word"))


def group_variants(docs: DataFrame, change: Callable[[object, str], str] = as_it_is, min_length: int = 7, min_count: int = 2, times: int = 10) -> DataFrame:
    """One row per word: word, n, n_near (near words), form, form_n and root.

    Words are the maximal runs of letters (a-z, A-Z and the code points from
    U+00C0 to U+00FF) of all texts, with A-Z in lower case, after ``change``; of
    at least ``min_length`` code points and ``min_count`` occurrences. Words
    are near if they are one inserted, deleted or replaced code point apart. A
    word's form is its near word with the most occurrences, ties by code points,
    if it has ``times`` the word's own or more; else NULL, as is form_n. The root
    is the last form of forms, or the word itself. NULL and empty texts have no
    words, repeated rows count again, other columns are not read, and an empty
    table gives no rows.
    """
    words = step(vocabulary(docs, change, min_length, min_count), "words")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near"))
    near = near_pairs(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    held = words.join(near, "word", "left")
    fits = -F.col("best.less") >= times * F.col("n")
    forms = held.select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(fits, F.col("best.near")).alias("form"), F.when(fits, -F.col("best.less")).alias("form_n"),
    )
    return with_roots(step(forms, "forms"))
