"""Whole texts of Arrow batches as byte arrays, worked on by numpy inside Spark tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import StructField, StructType

#: Text bytes that one step works on at a time. A longer text is a step of its own.
STEP_BYTES = 1 << 20

ODD = np.uint64(0x9E3779B97F4A7C15)


#: Rows of the batches that tasks hand to Python and back. Spark's own number would make batches of whole texts large.
BATCH_ROWS = "1000"


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, in a session that moves batches of ``BATCH_ROWS`` rows, unless it sets another number itself."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if conf.get(key) == "10000":
        conf.set(key, BATCH_ROWS)
    return df


def slices(batch: pa.RecordBatch, column: str, limit: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose texts have about ``limit`` bytes together."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes.astype(np.int64)) if len(sizes) else sizes
    start, done = 0, 0
    while start < batch.num_rows:
        stop = max(start + 1, int(np.searchsorted(ends, done + limit, "right")))
        yield batch.slice(start, stop - start)
        start, done = stop, int(ends[stop - 1])


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts in a row, and the n + 1 offsets; NULL is empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def byte_table(is_in: Callable[[int], bool]) -> np.ndarray:
    """Which of the 256 bytes belong to a class."""
    return np.array([is_in(b) for b in range(256)])


#: Bytes of words split at blanks: all but space and 0x09 to 0x0D.
NOT_BLANK = byte_table(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)

#: Bytes as they are, with A-Z in lower case.
LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], np.uint8)


def words(data: np.ndarray, at: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of each maximal run of bytes in ``table``; none crosses texts."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = table[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    full = np.flatnonzero(np.diff(at))
    begin, end = at[full], at[full + 1] - 1
    first[begin] = inside[begin]
    last[end] = inside[end]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    counts = np.diff(np.searchsorted(starts, at))
    return starts, ends, np.repeat(np.arange(len(at) - 1), counts)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def salt(number: int) -> np.uint64:
    """A number to add before ``mixed``, so that equal values of different kinds differ."""
    return np.uint64(number * int(ODD) % (1 << 64))


class RangeHash:
    """64-bit hashes of byte ranges of one array: eight bytes after the other, each mixed into what came before.

    Ranges of more than ``LONG`` bytes are hashed one by one with XXH3.
    """

    LONG = 512
    #: The bytes of eight that count when 0 to 8 are left.
    MASK = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)

    def __init__(self, data: np.ndarray) -> None:
        self.data, self.padded = data, np.append(data, np.zeros(8, np.uint8))
        # the eight bytes from every place on
        self.eight = np.ndarray(len(data) + 1, "<u8", self.padded, strides=(1,))

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of the bytes from ``start`` to before ``end``; the length counts too."""
        length = end - start
        out = mixed(length.astype(np.uint64) * ODD + ODD)
        short = length <= self.LONG
        on = np.flatnonzero(short & (length > 0))
        done = 0
        while len(on):
            left = np.minimum(length[on] - done, 8)
            more = self.eight[start[on] + done] & self.MASK[left]
            out[on] = mixed((out[on] ^ mixed(more + ODD)) * ODD + salt(done + 1))
            done += 8
            on = on[length[on] > done]
        rest = np.flatnonzero(~short)
        if len(rest):
            out[rest] = self._long(start[rest].tolist(), end[rest].tolist())
        return out

    def _long(self, start: list[int], end: list[int]) -> list[int]:
        from xxhash import xxh3_64_intdigest

        view = memoryview(np.ascontiguousarray(self.data))
        return [xxh3_64_intdigest(view[a:b], 42) for a, b in zip(start, end, strict=True)]


def per_text(numbers: np.ndarray, count: int, weights: np.ndarray | None = None) -> np.ndarray:
    """How many entries, or what sum of ``weights``, each text has."""
    return np.bincount(numbers, weights, count).astype(np.int64)


def add_columns(
    df: DataFrame,
    text: str,
    fields: list[StructField],
    compute: Callable[[pa.RecordBatch], dict[str, pa.Array]],
    drop: tuple[str, ...] = (),
    limit: int = STEP_BYTES,
) -> DataFrame:
    """Every row of ``df`` with the columns that ``compute`` makes of a run of rows.

    A column of the input whose name is that of a new one, in any case, gives
    way to it, in its place. Columns in ``drop`` are read but not returned.
    """
    new = {f.name.lower(): f for f in fields}
    there = [f for f in df.schema.fields if f.name not in drop]
    held = {f.name.lower() for f in there}
    out = [new.get(f.name.lower(), f) for f in there] + [f for f in fields if f.name.lower() not in held]
    names, made = [f.name for f in out], {f.name for f in fields}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text, limit):
                got = compute(part)
                yield pa.RecordBatch.from_arrays([got[n] if n in made else part.column(n) for n in names], names)

    return small_batches(df).mapInArrow(run, StructType(out))
