"""Context-triggered piecewise hashing: pieces end where a rolling hash says so, a fingerprint has a sign for each.

The rolling hash covers the last ``REACH`` bytes. A place has the level k if the
lowest k bits of the hash are zero, and places of level k or more cut the text
into pieces at block size 2 ** k. A text's block size is the least, from
``2 ** LOWEST``, that gives at most ``PIECES`` pieces, so the whole text counts
whatever its length. The fingerprint is the level and the signs of the pieces at
that block size and at twice it, two letters a piece, from the piece's crc32.

Two fingerprints are compared where they have a block size in common, by the
edit distance of insertions and deletions of pieces: the likeness is one minus
the distance by the number of pieces of both.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField

from sessionlake.llm.arrow import ODD, add_columns, mixed, slices, small_batches
from sessionlake.llm.steps import step

#: Bytes that decide whether a piece ends.
REACH = 7

#: Pieces of a fingerprint at its block size, at most.
PIECES = 64

#: Least level: pieces of four bytes on average.
LOWEST = 2

#: Bytes that the rolling hash is worked out for at a time.
BLOCK = 1 << 20

LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+-"
SIGNS = [a + b for a in LETTERS for b in LETTERS]

_BYTE = (mixed(np.arange(1, 257, dtype=np.uint64) * ODD) >> np.uint64(32)).astype(np.uint32)
_STEP = np.uint32(0x2C9277B5)


def ends(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Places after which a piece may end, and their levels, ``LOWEST`` or more."""
    places, levels = [], []
    raw = np.frombuffer(data, np.uint8)
    for start in range(0, len(raw), BLOCK):
        before = min(start, REACH - 1)
        value = _BYTE[raw[start - before : start + BLOCK]]
        rolled = value.copy()
        for _ in range(REACH - 1):
            value = value[:-1] * _STEP
            rolled[len(rolled) - len(value) :] += value
        rolled = rolled[before:]
        rolled ^= rolled >> np.uint32(15)
        rolled *= np.uint32(0x85EBCA6B)
        rolled ^= rolled >> np.uint32(13)
        at = np.flatnonzero(rolled & np.uint32((1 << LOWEST) - 1) == 0)
        low = rolled[at]
        level = np.bitwise_count((low & (~low + np.uint32(1))) - np.uint32(1))
        places.append(at + start + 1)
        levels.append(level)
    none = np.zeros(0, np.int64)
    at, level = np.concatenate(places or [none]), np.concatenate(levels or [none])
    inside = at < len(raw)  # the text's own end ends a piece anyway
    return at[inside], level[inside]


def _signs(data: bytes, cuts: list[int]) -> str:
    view = memoryview(data)
    return "".join(SIGNS[crc32(view[a:b]) & 0xFFF] for a, b in zip([0, *cuts], [*cuts, len(data)], strict=True))


def fingerprint(data: bytes) -> str:
    """Level and both signatures, parted by colons; no bytes give no pieces."""
    if not data:
        return f"{LOWEST}::"
    at, level = ends(data)
    over = np.cumsum(np.bincount(level, minlength=LOWEST + 1)[::-1])[::-1]  # cuts of a level or more
    own = LOWEST
    while own < len(over) and over[own] >= PIECES:
        own += 1
    cuts = [at[level >= k].tolist() for k in (own, own + 1)]
    return f"{own}:{_signs(data, cuts[0])}:{_signs(data, cuts[1])}"


def _pieces(signs: str) -> list[str]:
    return [signs[i : i + 2] for i in range(0, len(signs), 2)]


def common(a: list[str], b: list[str]) -> int:
    """Length of the longest common subsequence, a row of it as the bits of one number."""
    where: dict[str, int] = {}
    for i, sign in enumerate(a):
        where[sign] = where.get(sign, 0) | 1 << i
    row = all_ = (1 << len(a)) - 1
    for sign in b:
        both = row & where.get(sign, 0)
        row = (row + both) | (row - both)
    return len(a) - (row & all_).bit_count()


def likeness(x: str, y: str) -> float:
    """1 for equal fingerprints, 0 for those without a block size in common; the better of two block sizes."""
    if x == y:
        return 1.0
    (i, *xs), (j, *ys) = x.split(":"), y.split(":")
    best = 0.0
    for p, a in enumerate(xs):
        for q, b in enumerate(ys):
            if int(i) + p == int(j) + q and a and b:
                a_, b_ = _pieces(a), _pieces(b)
                best = max(best, 2 * common(a_, b_) / (len(a_) + len(b_)))
    return best


def with_fingerprint(docs: DataFrame, text: str = "text", name: str = "fingerprint", drop: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` with the fingerprint of a text column; a NULL text is empty. Equal texts have equal fingerprints."""

    def compute(part: pa.RecordBatch) -> dict[str, pa.Array]:
        return {name: pa.array([fingerprint((t or "").encode()) for t in part.column(text).to_pylist()], pa.string())}

    return add_columns(docs, text, [StructField(name, StringType())], compute, drop)


FIELDS = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _edited(own: str, following: str) -> str:
    """``own`` with its last quarter replaced by as many characters from the start of ``following``, or all it has."""
    quarter = len(own) // 4
    return own[: len(own) - quarter] + following[:quarter]


def _compared(doc_id: int | None, text: str, own: str, following: str, other: str) -> tuple:
    """A row of ``FIELDS`` from a text and the following one, with their fingerprints."""
    edited = _edited(text, following).encode()
    changed = fingerprint(edited)
    return doc_id, len(text), sha256(edited).hexdigest(), own, changed, likeness(own, changed), likeness(own, other)


def _in_order(batches: Iterator[pa.RecordBatch], names: list[str], types: list[pa.DataType]) -> Iterator[pa.RecordBatch]:
    """Each row of a sorted partition against the next one; the partition's edges go out with their texts."""
    from pyspark import TaskContext

    part, held = TaskContext.get().partitionId(), None
    nothing = [None] * 7

    def table(rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    for batch in batches:
        for piece in slices(batch, "text"):
            rows = []
            for doc_id, text in zip(*(piece.column(c).to_pylist() for c in ("doc_id", "text")), strict=True):
                text = text or ""
                own = fingerprint(text.encode())
                if held is None:
                    rows.append((*nothing, part, "first", text, own, doc_id))
                else:
                    rows.append((*_compared(*held, text, own), part, None, None, None, None))
                held = doc_id, text, own
            yield table(rows)
    if held is not None:
        doc_id, text, own = held
        yield table([(*nothing, part, "last", text, own, doc_id)])


def against_next(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``, compared with its edited text and with the next document.

    The next document is the one that follows by ascending doc_id (NULL first;
    rows of one doc_id by their text), and the first after the last, so a single
    document follows itself. The edited text has the last quarter of the
    characters, rounded down, replaced by the start of the next text. Columns:
    doc_id, n_chars, edited_sha256 of the edited text, both fingerprints, and the
    likeness of the text's fingerprint to the edited one's and to that of the
    next document. A NULL text is empty; two empty texts are alike. Other
    columns are not read. An empty table gives no rows.

    Texts are dealt into ranges of doc_id and read in order, one text at a time
    beside the one before. The edges of the ranges, two rows each, are joined.
    """
    own = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = small_batches(own).repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")
    schema = f"{FIELDS}, part int, edge string, text string, own string, edge_id long"
    names = [f.split()[0] for f in schema.split(", ")]
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "double": pa.float64()}
    types = [kinds[f.split()[1]] for f in schema.split(", ")]
    rows = step(dealt.mapInArrow(lambda batches: _in_order(batches, names, types), schema), "ranges")

    edges = rows.where("edge IS NOT NULL").select("part", "edge", "text", "own", "edge_id")
    # numbers of the ranges that have rows: as many as tasks, so one task orders them
    numbers = edges.where("edge = 'first'").select("part")
    over = Window.orderBy("part")
    following = numbers.select("part", F.lead("part").over(over).alias("after")).join(numbers.agg(F.min("part").alias("least")))
    last = edges.where("edge = 'last'").select("part", F.col("edge_id").alias("doc_id"), "text", "own")
    first = edges.where("edge = 'first'").select(F.col("part").alias("after"), F.col("text").alias("next_text"), F.col("own").alias("next_own"))
    met = last.join(following.select("part", F.coalesce("after", "least").alias("after")), "part").join(first, "after")

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_compared(*row.values()) for row in batch.to_pylist()]
            if found:
                columns = zip(zip(*found, strict=True), types[:7], strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in columns], names[:7])

    closed = met.select("doc_id", "text", "own", "next_text", "next_own").mapInArrow(close, FIELDS)
    return rows.where("edge IS NULL").select(*names[:7]).unionByName(closed)
