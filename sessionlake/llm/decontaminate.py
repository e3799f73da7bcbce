"""Benchmark decontamination by a generalised suffix automaton over the words of test items.

The automaton holds every run of words that some item contains. A document's
words stream through it, and the length of the longest run that ends at each
word tells whether a window of an item ends there. Words that no item has, and
neighbours that no item has side by side, end every run; numpy finds these
first, so that only runs of known pairs go through the automaton.

Items are taken in blocks of at most ``BLOCK_WORDS`` words, one automaton and
one pass over the documents for each block. An automaton has at most two
states a word, which bounds what is sent out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from sessionlake.llm.arrow import LOWER, RangeHash, add_columns, byte_table, text_bytes, words
from sessionlake.workspace import materialize

#: Words of a window; an item of fewer is one window.
WINDOW = 10

#: Share of hit words above which a document goes as a whole.
MAX_COVERAGE = 0.5

#: Item words in one automaton.
BLOCK_WORDS = 1_000_000

#: Bytes of words, after A-Z is in lower case: digits, a-z and all but ASCII.
WORD = byte_table(lambda b: not (b <= 0x2F or 0x3A <= b <= 0x60 or 0x7B <= b <= 0x7F))


def _words(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start, end and text number of each word, and the text offsets."""
    data, at = text_bytes(column)
    data = LOWER[data]
    starts, ends, text = words(data, at, WORD)
    return RangeHash(data).of(starts, ends), starts, ends, text, at


@dataclass
class Automaton:
    """States over item words: next states, suffix links, longest lengths, and what ends in them."""

    vocabulary: np.ndarray  # sorted word hashes; a word's number is its place
    pairs: np.ndarray  # sorted numbers of neighbours, first * words + second
    shortest: int  # words of the shortest window
    step: list[dict[int, int]] = field(default_factory=lambda: [{}])
    link: list[int] = field(default_factory=lambda: [-1])
    length: list[int] = field(default_factory=lambda: [0])
    window: dict[int, frozenset] = field(default_factory=dict)  # state of a whole window: items that have it
    short: dict[int, list] = field(default_factory=dict)  # state: (words, items) of short items ending there

    def _state(self, length: int, step: dict, link: int) -> int:
        self.step.append(step)
        self.length.append(length)
        self.link.append(link)
        return len(self.step) - 1

    def extend(self, last: int, word: int) -> int:
        """Add a word after state ``last`` of the item that is being added."""
        step, link, length = self.step, self.link, self.length
        there = step[last].get(word)
        if there is not None and length[there] == length[last] + 1:
            return there
        made = None if there is not None else self._state(length[last] + 1, {}, -1)
        p = last
        while made is not None and p >= 0 and word not in step[p]:
            step[p][word] = made
            p = link[p]
        if made is not None and p < 0:
            link[made] = 0
            return made
        q = step[p][word]
        if length[q] != length[p] + 1:
            copy = self._state(length[p] + 1, dict(step[q]), link[q])
            link[q] = copy
            while p >= 0 and step[p].get(word) == q:
                step[p][word] = copy
                p = link[p]
            q = copy
        if made is None:
            return q
        link[made] = q
        return made

    def walk(self, run: list[int], state: int = 0, matched: int = 0) -> Iterator[tuple[int, int]]:
        """State and length of the longest item run ending at each word."""
        step, link, length = self.step, self.link, self.length
        for w in run:
            while state and w not in step[state]:
                state = link[state]
                matched = length[state]
            if w in step[state]:
                state = step[state][w]
                matched += 1
            yield state, matched

    def at_most(self, state: int, size: int) -> int:
        """The state of the last ``size`` words of a state's run."""
        while self.length[self.link[state]] >= size:
            state = self.link[state]
        return state

    def windows_at(self, state: int, matched: int) -> Iterator[tuple[int, frozenset]]:
        """Length and items of each window that ends with a run of ``matched`` words."""
        if matched >= WINDOW:
            yield WINDOW, self.window[self.at_most(state, WINDOW)]
        while state > 0 and self.short:
            for size, items in self.short.get(state, ()):
                if size <= matched:
                    yield size, items
            state = self.link[state]


def build(items: list[tuple[int | None, np.ndarray]]) -> Automaton | None:
    """The automaton of items (id, word hashes); None if no item has a word."""
    items = [(i, w) for i, w in items if len(w)]
    if not items:
        return None
    vocabulary = np.unique(np.concatenate([w for _, w in items]))
    runs = [(i, np.searchsorted(vocabulary, w)) for i, w in items]
    pairs = np.unique(np.concatenate([r[:-1] * len(vocabulary) + r[1:] for _, r in runs]))
    made = Automaton(vocabulary, pairs, min(min(len(r), WINDOW) for _, r in runs))
    for _, run in runs:
        last = 0
        for w in run.tolist():
            last = made.extend(last, w)
    for item, run in runs:
        own = frozenset() if item is None else frozenset([item])
        if len(run) < WINDOW:
            *_, (state, _) = made.walk(run.tolist())
            state = made.at_most(state, len(run))
            made.short.setdefault(state, []).append((len(run), own))
            continue
        for state, matched in made.walk(run.tolist()):
            if matched >= WINDOW:
                state = made.at_most(state, WINDOW)
                made.window[state] = made.window.get(state, frozenset()) | own
    return made


def find(column: pa.Array, block: Automaton) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[set], tuple]:
    """Words per text, hit marks and text of each word, items found per text, and the words' places."""
    hashes, starts, ends, text, at = _words(column)
    n, hit, found = len(at) - 1, np.zeros(len(hashes), bool), [set() for _ in range(len(at) - 1)]
    if len(hashes):
        number = np.searchsorted(block.vocabulary, hashes)
        known = block.vocabulary[np.minimum(number, len(block.vocabulary) - 1)] == hashes
        joined = known[:-1] & known[1:] & (text[:-1] == text[1:])
        if len(block.pairs):
            both = np.flatnonzero(joined)
            pair = number[both] * len(block.vocabulary) + number[both + 1]
            place = np.minimum(np.searchsorted(block.pairs, pair), len(block.pairs) - 1)
            joined[both] = block.pairs[place] == pair
        else:
            joined[:] = False
        # maximal runs of known words whose neighbours are known pairs
        first = np.flatnonzero(known & ~np.concatenate([[False], joined]))
        last = np.flatnonzero(known & ~np.concatenate([joined, [False]]))
        long = last - first + 1 >= block.shortest
        for a, b in zip(first[long].tolist(), last[long].tolist(), strict=True):
            for i, (state, matched) in enumerate(block.walk(number[a : b + 1].tolist()), a):
                if matched >= block.shortest:
                    for size, items in block.windows_at(state, matched):
                        hit[i - size + 1 : i + 1] = True
                        found[text[i]].update(items)
    return np.bincount(text, minlength=n), hit, text, found, (starts, ends, at)


def _runs(hit: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last word of each maximal run of hit words of one text."""
    if not len(hit):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    apart = text[1:] != text[:-1]
    first = hit & np.concatenate([[True], apart | ~hit[:-1]])
    last = hit & np.concatenate([apart | ~hit[1:], [True]])
    return np.flatnonzero(first), np.flatnonzero(last)


SPAN = StructType([StructField("first", LongType()), StructField("last", LongType()), StructField("start", LongType()), StructField("end", LongType())])
FIELDS = [
    StructField("n_words", LongType()),
    StructField("spans", ArrayType(SPAN)),
    StructField("items", ArrayType(LongType())),
]


def _cut(column: pa.Array, spans: list[list[dict]]) -> pa.Array:
    """Texts without the bytes of their spans; a text without spans as it is."""
    texts = []
    for text, own in zip(column.to_pylist(), spans, strict=True):
        if own:
            raw, at, kept = text.encode(), 0, []
            for s in own:
                kept.append(raw[at : s["start"]])
                at = s["end"]
            text = b"".join([*kept, raw[at:]]).decode()
        texts.append(text)
    return pa.array(texts, pa.string())


def _search(block: Automaton | None, earlier: bool, cut: bool = False):
    """Word count, hit spans (words and bytes, ends included and not) and items of a run of texts; the texts without them."""

    def compute(part: pa.RecordBatch) -> dict[str, pa.Array]:
        if block is None:
            _, starts, ends, text, at = _words(part.column("text"))
            counts, hit, found = np.bincount(text, minlength=len(at) - 1), np.zeros(len(text), bool), [set() for _ in at[1:]]
        else:
            counts, hit, text, found, (starts, ends, at) = find(part.column("text"), block)
        first_word = np.searchsorted(text, np.arange(len(counts)))
        if earlier:  # marks of the blocks before
            for i, (spans, items) in enumerate(zip(part.column("spans").to_pylist(), part.column("items").to_pylist(), strict=True)):
                found[i].update(items)
                for s in spans:
                    hit[first_word[i] + s["first"] : first_word[i] + s["last"] + 1] = True
        first, last = _runs(hit, text)
        spans: list[list] = [[] for _ in counts]
        for a, b in zip(first.tolist(), last.tolist(), strict=True):
            t = text[a]
            spans[t].append({"first": a - first_word[t], "last": b - first_word[t], "start": starts[a] - at[t], "end": ends[b] - at[t]})
        span = pa.struct([(f.name, pa.int64()) for f in SPAN])
        out = {
            "n_words": pa.array(counts, pa.int64()),
            "spans": pa.array(spans, pa.list_(span)),
            "items": pa.array([sorted(f) for f in found], pa.list_(pa.int64())),
        }
        return out | {"text": _cut(part.column("text"), spans)} if cut else out

    return compute


def item_blocks(benchmark: DataFrame) -> Iterator[Automaton | None]:
    """Automata of all items; the driver holds the words of one block at a time."""
    held, size, any_made = [], 0, False
    for row in benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).toLocalIterator():
        run = _words(pa.array([row[1]], pa.string()))[0]
        if held and size + len(run) > BLOCK_WORDS:
            yield build(held)
            held, size, any_made = [], 0, True
        held.append((row[0], run))
        size += len(run)
    if held or not any_made:
        yield build(held)


def search(docs: DataFrame, benchmark: DataFrame, drop: tuple[str, ...] = (), cut: bool = False) -> DataFrame:
    """``docs`` with n_words, spans and items; with ``cut`` without the spans in ``text``.

    ``spans`` are the maximal runs of hit words: first and last word, and byte
    range in the UTF-8 text. ``items`` are the ids of items with an occurring
    window; an item without id hits words and is not listed. NULL and empty
    texts have no words; items without words match nothing; repeated items and
    rows change nothing for others. Columns of the input with these names give
    way.
    """
    blocks, out, earlier = item_blocks(benchmark), docs, False
    block = next(blocks)
    while True:
        after = next(blocks, ())
        final = after == ()
        fields = [*FIELDS, StructField("text", StringType())] if final and cut else FIELDS
        out = add_columns(out, "text", fields, _search(block, earlier, final and cut), drop if final else ())
        if final:
            return out
        out, block, earlier = materialize(out, "hits"), after, True


def clean(docs: DataFrame, benchmark: DataFrame, max_coverage: float = MAX_COVERAGE) -> DataFrame:
    """``docs`` without benchmark passages: hit spans are cut out of the text.

    A document goes as a whole if more than ``max_coverage`` of its words are
    hit. Texts without hits stay as they are, byte for byte, and NULL stays NULL.
    """

    def hits() -> Column:
        return F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"] + 1)

    found = search(docs, benchmark, cut=True).where(hits() <= F.col("n_words") * max_coverage)
    return found.select(*[F.col(f"`{c}`") for c in docs.columns if c not in ("n_words", "spans", "items")])
