"""Removal of byte strings that repeat: suffix buckets with a difference cover.

Two suffixes at any places i and j have an offset d below ``V`` at which i + d
and j + d are both in the cover sample, the places whose remainder by ``V`` is
in ``COVER``. So if the ``WINDOW`` bytes at i and j agree, their samples
there agree in the ``DEPTH`` bytes that follow. The work goes in rounds, each
dealt into suffix buckets which tasks sort one at a time:

1. All samples, by their ``DEPTH`` bytes. A sample that nobody shares rules out
   every suffix that depends on it. The others get the rank of their bytes.
2. The shared samples, by their rank and the bytes around what they share:
   members with the same rank and the same bytes before and after settle all
   their suffixes at once. Ranks that many units share are dealt by the bytes
   around too, so that no bucket has to hold all members of one.
3. Suffixes that hang on samples of equal rank in different surroundings, by
   their ``WINDOW`` bytes.

Only equality counts here, so buckets and orders are of hashes of the bytes
(64 bits), not of the bytes: of the shared bytes in the first round, of those
around within one rank in the second, of the window in the third. Texts are
packed into compressed units, a table in the shared folder that is bucketed by
unit and so is not shuffled again; a round sends, for each unit and bucket, one
sorted block of numbers, with no number more than twice. So a passage that every
document has costs each unit two numbers in the first round.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionlake.llm.arrow import ODD, RangeHash, mixed, slices, small_batches, text_bytes
from sessionlake.llm.steps import bucketed, step

#: Bytes of a string that counts.
WINDOW = 200

#: A difference cover: every remainder by V is a difference of two of its numbers.
V = 133
COVER = (0, 1, 3, 12, 20, 34, 38, 81, 88, 94, 104, 109)

#: Bytes that samples of equal suffixes share.
DEPTH = WINDOW - V + 1

#: Numbers of one rank from which on its members are dealt by the bytes around them too.
HOT = 1 << 10

#: Text bytes of a unit; a longer text is a unit of its own.
UNIT_BYTES = 2 << 20

#: Numbers in a bucket, about.
BUCKET_ROWS = 1 << 20

UNIT = "unit long, doc_ids array<long>, sizes array<long>, texts binary"
BLOCK = "bucket int, unit long, numbers binary"
ANSWER = "unit long, round int, bucket int, answer binary"
RESULT = "doc_id long, n_bytes long, n_removed long, spans array<struct<start:long,end:long>>, kept binary"


def _unpacked(unit: dict) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(zstandard.ZstdDecompressor().decompress(unit["texts"]), np.uint8)
    return data, np.concatenate([[0], np.cumsum(unit["sizes"])]).astype(np.int64)


def pack_units(docs: DataFrame) -> DataFrame:
    """Documents gathered into units of about ``UNIT_BYTES``, compressed; NULL text is empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        unit, press = TaskContext.get().partitionId() << 32, zstandard.ZstdCompressor(3)
        for batch in batches:
            for part in slices(batch, "text", UNIT_BYTES):
                data, at = text_bytes(part.column("text"))
                columns = [[unit], [part.column("doc_id").to_pylist()], [np.diff(at)], [press.compress(data.tobytes())]]
                types = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["unit", "doc_ids", "sizes", "texts"]
                )
                unit += 1

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, UNIT)


def _changes(ordered: np.ndarray) -> np.ndarray:
    """Which rows differ from the one before; the first does."""
    new = np.ones(len(ordered), bool)
    new[1:] = (ordered[1:] != ordered[:-1]).any(axis=1)
    return new


class Blocks:
    """Numbers (row, one or two of them) in order by bucket and number, and their distinct entries."""

    def __init__(self, numbers: np.ndarray, bucket: np.ndarray) -> None:
        self.order = np.lexsort((*numbers.T[::-1], bucket))
        self.numbers, self.bucket = numbers[self.order], bucket[self.order]
        new = _changes(self.numbers)
        new[1:] |= self.bucket[1:] != self.bucket[:-1]
        self.entry, self.first = np.cumsum(new) - 1, np.flatnonzero(new)

    def sent(self) -> Iterator[tuple[int, bytes]]:
        """For each bucket its sorted numbers, those found more than once twice."""
        size = np.diff(np.append(self.first, len(self.order)))
        held = np.sort(np.concatenate([self.first, self.first[size > 1] + 1]))
        own_n, own_b = self.numbers[held], self.bucket[held]
        cuts = [*np.flatnonzero(np.diff(own_b)) + 1, len(held)] if len(held) else []
        for a, b in zip([0, *cuts], cuts, strict=False):
            yield int(own_b[a]), own_n[a:b].astype("<u8").tobytes()

    def _buckets(self) -> Iterator[tuple[int, int, int]]:
        """Bucket, first and last entry and one."""
        own = self.bucket[self.first]
        cuts = [*np.flatnonzero(np.diff(own)) + 1, len(own)] if len(own) else []
        for a, b in zip([0, *cuts], cuts, strict=False):
            yield int(own[a]), a, b

    def ranks(self, answers: dict[int, bytes]) -> np.ndarray:
        """Each row's rank by round 1, 0 for those that nobody shares."""
        out = np.zeros(len(self.first), np.uint32)
        for bucket, a, b in self._buckets():
            if got := answers.get(bucket):
                bits = -(-(b - a) // 8)
                shared = np.unpackbits(np.frombuffer(got, np.uint8, bits), count=b - a).astype(bool)
                out[a:b][shared] = np.frombuffer(got, "<u4", offset=bits)
        ranks = np.zeros(len(self.order), np.uint32)
        ranks[self.order] = out[self.entry]
        return ranks

    def marks(self, answers: dict[int, bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Two marks of each row, and whether it is the first of its numbers in the unit."""
        marks = np.zeros((len(self.first), 2), bool)
        for bucket, a, b in self._buckets():
            if got := answers.get(bucket):
                marks[a:b] = np.unpackbits(np.frombuffer(got, np.uint8), count=2 * (b - a)).reshape(-1, 2)
        settled, asked, is_first = (np.zeros(len(self.order), bool) for _ in range(3))
        settled[self.order], asked[self.order] = marks[self.entry, 0], marks[self.entry, 1]
        is_first[self.order[self.first]] = True
        return settled, asked, is_first


class Unit:
    """A unit's text with the samples and suffixes that can matter: those of documents of WINDOW bytes or more."""

    def __init__(self, unit: dict, buckets: int) -> None:
        self.data, self.at = _unpacked(unit)
        self.buckets = buckets
        self.hashes = RangeHash(self.data)
        sizes = np.diff(self.at)
        self.long = np.flatnonzero(sizes >= WINDOW)
        starts, sizes = self.at[self.long], sizes[self.long]
        # places of samples: turns of V in each document, the cover in each turn
        n = sizes - DEPTH + 1
        cover = np.array(COVER)
        whole = -(-n // V)
        turn = np.arange(whole.sum()) - np.repeat(np.cumsum(whole) - whole, whole)
        inside = (turn[:, None] * V + cover).reshape(-1)
        document = np.repeat(np.repeat(np.arange(len(n)), whole), len(cover))
        fits = inside < n[document]
        inside, document = inside[fits], document[fits]
        start, end = starts[document], (starts + sizes)[document]
        self.sample = start + inside
        self.low, self.high = np.maximum(start, self.sample - (V - 1)), np.minimum(end, self.sample + WINDOW)

    def _bucket(self, number: np.ndarray) -> np.ndarray:
        return (mixed(number + ODD) % np.uint64(self.buckets)).astype(np.int32)

    def samples(self) -> Blocks:
        """The hash of the shared bytes of each sample."""
        shared = self.hashes.of(self.sample, self.sample + DEPTH)
        return Blocks(shared[:, None], self._bucket(shared))

    def shared(self, answers: dict[int, bytes]) -> tuple[np.ndarray, Blocks]:
        """After round 1: samples that others share, with their rank and the hash of the bytes around."""
        blocks = self.samples()
        code = blocks.ranks(answers)
        bucket = np.empty(len(code), np.int32)
        bucket[blocks.order] = blocks.bucket
        held = np.flatnonzero(code)
        sample, low, high = self.sample[held], self.low[held], self.high[held]
        around = mixed(self.hashes.of(low, sample) + mixed(self.hashes.of(sample + DEPTH, high) + ODD))
        rank = (bucket[held].astype(np.uint64) << np.uint64(32)) | code[held]
        hot = code[held] & 1 > 0
        return held, Blocks(np.column_stack([rank, around]), np.where(hot, self._bucket(mixed(rank) + around), bucket[held]))

    def suffixes(self, answers1: dict[int, bytes], answers2: dict[int, bytes]) -> tuple[np.ndarray, np.ndarray, Blocks]:
        """After round 2: bytes settled as repeated (marks), and the places of suffixes to compare, with their numbers."""
        held, blocks = self.shared(answers1)
        settled, asked, first = blocks.marks(answers2)
        # of members with equal surroundings one speaks for all; the first in the unit is as good as any
        low, high, speaks = self.low[held], self.high[held], asked & first
        repeated = self._covered(low[settled], high[settled])
        place = np.flatnonzero(self._covered(low[speaks], high[speaks] - WINDOW + 1))
        number = self.hashes.of(place, place + WINDOW)
        return repeated, place, Blocks(number[:, None], self._bucket(number))

    def _covered(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Marks of all bytes from ``low`` to before ``high``; a range that is empty marks none."""
        change = np.zeros(len(self.data) + 1, np.int64)
        full = high > low
        np.add.at(change, low[full], 1)
        np.add.at(change, high[full], -1)
        return np.cumsum(change)[:-1] > 0

    def removed(self, answers1: dict[int, bytes], answers2: dict[int, bytes], answers3: dict[int, bytes]) -> np.ndarray:
        """Marks of the bytes to remove."""
        repeated, place, blocks = self.suffixes(answers1, answers2)
        found = place[blocks.marks(answers3)[0]]
        return repeated | self._covered(found, found + WINDOW)


class Bucket:
    """All numbers of one bucket in order, and what to tell each unit of the distinct numbers that it sent."""

    def __init__(self, blocks: pa.Table, width: int) -> None:
        self.blocks = blocks
        sent = [np.frombuffer(b, "<u8").reshape(-1, width) for b in blocks.column("numbers").to_pylist()]
        self.number = np.concatenate(sent)
        self.owner = np.repeat(np.arange(len(sent)), [len(s) for s in sent])
        self.order = np.lexsort(self.number.T[::-1])
        self.ordered = self.number[self.order]
        self.new = _changes(self.ordered)
        # a unit's own second copy adds nothing to its answer
        self.again = ~_changes(np.column_stack([self.number, self.owner.astype(np.uint64)]))

    def _repeated(self) -> np.ndarray:
        """In order: which numbers others are equal to."""
        alone = self.new & np.append(self.new[1:], True)
        return ~alone

    def ranks(self) -> pa.Table:
        """Round 1: for each number whether it is shared, and the ranks of those that are; an odd rank is hot."""
        size = np.diff(np.append(np.flatnonzero(self.new), len(self.new)))
        code = np.cumsum(self._repeated() & self.new).astype(np.uint32) << np.uint32(1)
        code |= np.repeat(size > HOT, size)
        code[~self._repeated()] = 0
        out = np.zeros(len(code), "<u4")
        out[self.order] = code
        return self._answers(1, out[~self.again], lambda own: np.packbits(own > 0).tobytes() + own[own > 0].tobytes())

    def settled(self, round_: int) -> pa.Table:
        """Rounds 2 and 3: two bits for each number: repeated, and first of a kind that has to speak."""
        repeated, asked = self._repeated(), np.zeros(len(self.new), bool)
        if round_ == 2:
            # ranks with several surroundings: the first of each kind has to speak
            rank = self.ordered[:, :1]
            begin = np.flatnonzero(_changes(rank))
            kinds = np.add.reduceat(self.new.astype(np.int64), begin)
            several = np.repeat(kinds > 1, np.diff(np.append(begin, len(rank))))
            asked = (several | (rank[:, 0] & np.uint64(1) > 0)) & self.new
        bits = np.zeros((len(self.new), 2), bool)
        bits[self.order, 0], bits[self.order, 1] = repeated, asked
        return self._answers(round_, bits[~self.again], lambda own: np.packbits(own).tobytes())

    def _answers(self, round_: int, told: np.ndarray, packed: Callable[[np.ndarray], bytes]) -> pa.Table:
        cuts = np.searchsorted(self.owner[~self.again], np.arange(len(self.blocks) + 1))
        rows = [packed(told[a:b]) if told[a:b].any() else None for a, b in zip(cuts, cuts[1:], strict=False)]
        answer = pa.table({
            "unit": self.blocks.column("unit").combine_chunks(), "round": pa.array([round_] * len(rows), pa.int32()),
            "bucket": self.blocks.column("bucket").combine_chunks(), "answer": pa.array(rows, pa.binary()),
        })
        return answer.filter(pc.is_valid(answer.column("answer")))


def _of_round(answers: pa.Table, round_: int) -> dict[int, bytes]:
    rows = zip(*(answers.column(c).to_pylist() for c in ("round", "bucket", "answer")), strict=True)
    return {bucket: answer for r, bucket, answer in rows if r == round_}


def _block_table(unit: int, blocks: Iterator[tuple[int, bytes]]) -> pa.RecordBatch:
    rows = list(blocks)
    return pa.RecordBatch.from_arrays(
        [pa.array([b for b, _ in rows], pa.int32()), pa.array([unit] * len(rows), pa.int64()), pa.array([x for _, x in rows], pa.binary())],
        ["bucket", "unit", "numbers"],
    )


def _block_tables(batches: list[pa.RecordBatch]) -> pa.Table:
    return pa.Table.from_batches(batches, schema=pa.schema([("bucket", pa.int32()), ("unit", pa.int64()), ("numbers", pa.binary())]))


def _kept(unit: dict, removed: np.ndarray, at: np.ndarray, data: np.ndarray) -> pa.Table:
    spans, kept, gone = [], [], []
    for a, b in zip(at, at[1:], strict=False):
        marks = removed[a:b]
        edge = np.flatnonzero(np.diff(np.concatenate([[False], marks, [False]]).astype(np.int8)))
        spans.append([{"start": s, "end": e} for s, e in edge.reshape(-1, 2).tolist()])
        kept.append(data[a:b][~marks].tobytes())
        gone.append(int(marks.sum()))
    long = pa.int64()
    return pa.table({
        "doc_id": pa.array(unit["doc_ids"], long), "n_bytes": pa.array(unit["sizes"], long), "n_removed": pa.array(gone, long),
        "spans": pa.array(spans, pa.list_(pa.struct([("start", long), ("end", long)]))), "kept": pa.array(kept, pa.binary()),
    })


def remove_repeats(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, spans (byte ranges removed) and kept (bytes left).

    A byte goes if a string of ``WINDOW`` bytes that covers it starts anywhere
    else too, in the same document or another. Strings never cross documents.
    A NULL text is empty and gives an empty result; texts of fewer bytes stay
    as they are; repeated rows are documents of their own, so all their long
    strings go. Other columns are not read.
    """
    spark = docs.sparkSession
    parts = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    units = bucketed(pack_units(small_batches(docs)), "units", "unit", parts)
    total = units.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x))).first()[0] or 0
    buckets = max(parts, -(-(total * len(COVER) // V) // BUCKET_ROWS))

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield _block_table(row["unit"], Unit(row, buckets).samples().sent())

    def second(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        return _block_tables([
            _block_table(row["unit"], Unit(row, buckets).shared(_of_round(right, 1))[1].sent()) for row in left.to_pylist()
        ])

    def third(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        return _block_tables([
            _block_table(row["unit"], Unit(row, buckets).suffixes(_of_round(right, 1), _of_round(right, 2))[2].sent())
            for row in left.to_pylist()
        ])

    def finish(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for row in left.to_pylist():
            unit = Unit(row, buckets)
            out.append(_kept(row, unit.removed(*(_of_round(right, k) for k in (1, 2, 3))), unit.at, unit.data))
        return pa.concat_tables(out) if out else _kept({"doc_ids": [], "sizes": []}, np.zeros(0, bool), np.zeros(1, np.int64), np.zeros(0, np.uint8))

    def round_(number: int, blocks: DataFrame) -> DataFrame:
        def answer(table: pa.Table) -> pa.Table:
            return Bucket(table, 1).ranks() if number == 1 else Bucket(table, 2 if number == 2 else 1).settled(number)

        return step(blocks.groupBy("bucket").applyInArrow(answer, ANSWER), f"round{number}")

    def with_answers(answers: DataFrame):
        return units.groupBy("unit").cogroup(answers.groupBy("unit"))

    answers = round_(1, units.mapInArrow(first, BLOCK))
    answers = answers.unionByName(round_(2, with_answers(answers).applyInArrow(second, BLOCK)))
    answers = answers.unionByName(round_(3, with_answers(answers).applyInArrow(third, BLOCK)))
    return with_answers(answers).applyInArrow(finish, RESULT)
