"""SimHash near-duplicates with pigeonring filtering.

A fingerprint's 64 bits are a ring of five segments. If two fingerprints
differ in at most 4 bits, then from some segment on, each chain of l segments
differs in at most l * 4 / 5 bits: in 0 bits of the first, 1 of the first two,
2 of three, 3 of four. So they agree in that first segment and in the next one
but for one bit, which gives 65 keys for each fingerprint: a start and the bit
left out. Fingerprints that share a key are checked against the longer chains
and then in full.

Only distinct fingerprints are compared. Within a key that many share, links
are found from one member to the next until no more are left, which needs no
pair of all with all.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField

from sessionlake.llm.arrow import add_columns
from sessionlake.llm.components import components
from sessionlake.llm.steps import step

BITS = 64
MAX_DIFFERENCE = 4
SHINGLE = 4

#: First bit and width of each segment.
SEGMENTS = [(0, 13), (13, 13), (26, 13), (39, 13), (52, 12)]

#: Members of a key that are compared by shifting; more are searched member by member.
SHIFTED = 64

#: Members of a key that one task holds; a larger key is dealt out as pairs of blocks.
BLOCK = 1 << 20


def _mask(segment: int) -> int:
    first, width = SEGMENTS[segment % len(SEGMENTS)]
    return ((1 << width) - 1) << first


#: Start, left-out bit and mask of each key.
KEYS = [
    (i, bit, (_mask(i) | _mask(i + 1)) & ~(1 << bit))
    for i in range(len(SEGMENTS))
    for first, width in [SEGMENTS[(i + 1) % len(SEGMENTS)]]
    for bit in range(first, first + width)
]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprint_of(texts: list[bytes], shingle: int = SHINGLE) -> np.ndarray:
    """SimHash of each text: a bit is set if it is in over half of the shingles' XXH64 (seed 42)."""
    from xxhash import xxh64_intdigest

    hashes: list[int] = []
    counts = []
    for text in texts:
        words = text.lower().split()  # of bytes: only A-Z, and only the six ASCII blanks
        joined, ends = b" ".join(words), list(accumulate(len(w) + 1 for w in words))
        if len(words) <= shingle:
            made = [xxh64_intdigest(joined, 42)] if words else []
        else:
            starts = [0, *ends]
            made = [xxh64_intdigest(joined[a : b - 1], 42) for a, b in zip(starts, ends[shingle - 1 :])]  # noqa: B905
        hashes += made
        counts.append(len(made))
    out, n = np.zeros(len(texts), np.uint64), np.array(counts, np.int64)
    if hashes:
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        full = np.flatnonzero(n)
        ones = np.add.reduceat(bits, np.cumsum(n[full]) - n[full], axis=0, dtype=np.int32)
        out[full] = np.packbits(2 * ones > n[full][:, None], axis=1, bitorder="little").view("<u8")[:, 0]
    return out


def fingerprints(docs: DataFrame, drop: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` with ``fingerprint``; NULL, empty and blank texts have 0."""

    def compute(part: pa.RecordBatch) -> dict[str, pa.Array]:
        texts = pc.fill_null(part.column("text"), "").cast(pa.binary()).to_pylist()
        return {"fingerprint": pa.array(fingerprint_of(texts).view(np.int64))}

    return add_columns(docs, "text", [StructField("fingerprint", LongType())], compute, drop)


def _differences(x: np.ndarray) -> np.ndarray:
    """Differing bits per segment (pair, segment)."""
    return np.column_stack([np.bitwise_count(x & np.uint64(_mask(i))) for i in range(len(SEGMENTS))]).astype(np.int16)


def _chains(x: np.ndarray) -> np.ndarray:
    """Whether every chain from each start stays within its share of the budget (pair, start)."""
    d, m = _differences(x), len(SEGMENTS)
    return np.column_stack([
        np.all([sum(d[:, (i + k) % m] for k in range(size)) <= size * MAX_DIFFERENCE // m for size in range(1, m + 1)], axis=0)
        for i in range(m)
    ])


def _first_key(x: np.ndarray) -> np.ndarray:
    """The first of the keys that a linked pair shares: it is reported there and nowhere else."""
    start = np.argmax(_chains(x), axis=1)
    first_of = np.array([next(k for k, key in enumerate(KEYS) if key[0] == i) for i in range(len(SEGMENTS))])
    out = first_of[start]
    for i in range(len(SEGMENTS)):
        mine = np.flatnonzero(start == i)
        rest = x[mine] & np.uint64(_mask(i + 1))
        set_bit = np.zeros(len(mine), np.int64)
        set_bit[rest > 0] = np.round(np.log2(rest[rest > 0].astype(float))).astype(np.int64) - SEGMENTS[(i + 1) % len(SEGMENTS)][0]
        out[mine] += set_bit
    return out


def search(members: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links that connect whatever members are connected, at most one for each member but the first."""
    left = members
    while len(left):
        todo, left = [left[0]], left[1:]
        while todo and len(left):
            one = todo.pop()
            x = left ^ one
            near = np.bitwise_count(x) <= MAX_DIFFERENCE
            if near.any():
                yield np.full(int(near.sum()), one), left[near]
                todo.extend(left[near])
                left = left[~near]


def _links_of(key: np.ndarray, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links within the groups of equal keys; equal keys stand together."""
    if not len(key):
        return fp, fp
    new = np.concatenate([[True], key[1:] != key[:-1]])
    first = np.flatnonzero(new)
    size = np.diff(np.append(first, len(key)))
    us, vs = [], []
    small = np.repeat(size, size) <= SHIFTED
    for shift in range(1, int(size[size <= SHIFTED].max(initial=1))):
        at = np.flatnonzero((key[:-shift] == key[shift:]) & small[shift:])
        if not len(at):
            break
        x = fp[at] ^ fp[at + shift]
        start = (key[at] >> np.uint64(57)).astype(np.int64)
        begin = np.array([k[0] for k in KEYS])[start]
        viable = _chains(x)[np.arange(len(x)), begin]  # chains first, all five segments last
        at, x, start = at[viable], x[viable], start[viable]
        own = _first_key(x) == start if len(x) else np.zeros(0, bool)
        us.append(fp[at[own]])
        vs.append(fp[at[own] + shift])
    for f, n in zip(first[size > SHIFTED].tolist(), size[size > SHIFTED].tolist(), strict=True):
        for u, v in search(np.unique(fp[f : f + n])):
            us.append(u)
            vs.append(v)
    none = [np.zeros(0, np.uint64)]
    return np.concatenate(us or none), np.concatenate(vs or none)


def _run_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of sorted rows (key, fingerprint); the last key of a batch waits for the next one."""

    def links(parts: list) -> pa.RecordBatch:
        u, v = _links_of(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))
        return pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], ["u", "v"])

    held: list = []
    for batch in batches:
        key, fp = (batch.column(i).to_numpy(zero_copy_only=False).view(np.uint64) for i in range(2))
        other = np.flatnonzero(key != key[-1]) if len(key) else []
        if not len(other):
            if len(key):
                held.append((key, fp))
            continue
        cut = other[-1] + 1
        yield links([*held, (key[:cut], fp[:cut])])
        held = [(key[cut:], fp[cut:])]
    if held:
        yield links(held)


def _keyed(classes: DataFrame) -> DataFrame:
    """(key, fingerprint): the key's number in the top 7 bits, a hash of the agreeing bits below."""
    keys = F.array(
        *[F.named_struct(F.lit("k"), F.lit(k), F.lit("mask"), F.lit(_signed(m))) for k, (_, _, m) in enumerate(KEYS)]
    )
    rows = classes.select("fingerprint", F.explode(keys).alias("x"))
    inside = F.shiftrightunsigned(F.xxhash64("x.k", F.col("fingerprint").bitwiseAND(F.col("x.mask"))), 7)
    return rows.select(F.shiftleft(F.col("x.k").cast("long"), 57).bitwiseOR(inside).alias("key"), "fingerprint")


def _in_blocks(rows: DataFrame, block: int) -> DataFrame:
    """Rows whose key has more than ``block`` members once for each pair of blocks they are in."""
    large = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > block)
    blocks = F.ceil(F.col("n") / block).cast("int")
    own = F.pmod(F.xxhash64("fingerprint"), F.col("blocks")).cast("int")
    pair = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1), lambda b: F.struct(F.least(b, F.col("own")), F.greatest(b, F.col("own")))
    )
    top = F.shiftleft(F.shiftrightunsigned(F.col("key"), 57), 57)
    dealt = (
        rows.join(large.select("key", blocks.alias("blocks")), "key")
        .withColumn("own", own)
        .select("key", "fingerprint", F.explode(pair).alias("pair"))
        .select(top.bitwiseOR(F.shiftrightunsigned(F.xxhash64("key", "pair"), 7)).alias("key"), "fingerprint")
    )
    return rows.join(large, "key", "left_anti").unionByName(dealt)


def links(classes: DataFrame, block: int = BLOCK) -> DataFrame:
    """Pairs (u, v) of distinct fingerprints at 4 or fewer differing bits, enough to connect all that are connected."""
    rows = _keyed(classes)
    starts = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(_signed(_mask(i) | _mask(i + 1))).alias("mask")) for i in range(len(SEGMENTS))])
    # two of these groups make up one key's
    groups = classes.select("fingerprint", F.explode(starts).alias("x")).groupBy(
        "x.i", F.col("fingerprint").bitwiseAND(F.col("x.mask"))
    ).agg(F.count(F.lit(1)).alias("n"))
    largest = groups.agg(F.max("n")).first()[0] or 0
    if 2 * largest > block:
        rows = _in_blocks(rows, block)
    return rows.repartition("key").sortWithinPartitions("key").mapInArrow(_run_links, "u long, v long")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_key, fingerprint (long), root and component_id.

    Fingerprints link at 4 or fewer differing bits, and equal ones always;
    ``component_id`` is the smallest doc_id of all that are connected, ``root``
    the least fingerprint. ``text_key`` is a hash of the text. Texts without
    words have fingerprint 0 and link like any other. Rows without doc_id take
    part; they give no id, so a component of such rows alone has NULL. Repeated
    rows have one row each. An empty table gives no rows.
    """
    named = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), text_key(docs).alias("text_key"))
    rows = step(fingerprints(named, ("text",)), "prints")
    classes = step(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id")), "classes")
    roots = components(step(links(classes), "links"))
    rooted = classes.join(roots, classes["fingerprint"] == roots["node"], "left").select(
        "fingerprint", "first_id", F.coalesce("root", "fingerprint").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of_class = rooted.join(least, "root").select("fingerprint", "root", "component_id")
    return rows.join(of_class, "fingerprint").select("doc_id", "text_key", "fingerprint", "root", "component_id")


def text_key(docs: DataFrame) -> Column:
    return F.xxhash64(docs["text"].cast("string"))


def hex_digits(fingerprint: Column) -> Column:
    """16 lower-case hex digits."""
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


def keep_first(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each component: one with the smallest doc_id, or without doc_id if none has one."""
    return first_of_each(docs, near_duplicates(docs))


def first_of_each(docs: DataFrame, found: DataFrame) -> DataFrame:
    """What ``keep_first`` gives, from rows with doc_id, text_key, root and component_id."""
    first = (
        found.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
        .groupBy("root")
        .agg(F.min(F.struct("doc_id", "text_key")).alias("first"))
        .select("first.doc_id", "first.text_key")
    )
    # the row as one column, so that no name of its own can clash
    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), docs["doc_id"].cast("long").alias("id"), text_key(docs).alias("key")
    )
    same = keyed["id"].eqNullSafe(first["doc_id"]) & (keyed["key"] == first["text_key"])
    kept = keyed.join(first, same, "left_semi").dropDuplicates(["id", "key"])  # rows that repeat
    return kept.select("row.*")
