"""Sharding by a K-d tree: weighted medians along the widest metadata dimension.

Only DataFrame functions. A node is cut where the weights of its rows reach
the share of its left leaves, along the dimension in which it is widest. The
cut is found by histograms: each round counts weights in a few bins per node
and goes on inside the bin that holds the cut. So a round moves one row per
node, bin and task, and the driver gets at most ``HISTOGRAM_ROWS`` rows.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from sessionlake.workspace import materialize

#: Rows of a histogram over all nodes of a level.
HISTOGRAM_ROWS = 1 << 18

#: Rows that are numbered together inside a shard.
SLOT_ROWS = 2000

#: Parts that the rows of one text are spread over when they meet its place.
SALTS = 32

#: Share of a node's weight by which a cut may miss, so that equal texts stay together.
TOLERANCE = 0.001

# Bits of a row's key along one dimension: place in the dimension, text, row.
PLACE_BITS, TEXT_BITS, ROW_BITS = 24, 23, 15
KEY_BITS = PLACE_BITS + TEXT_BITS + ROW_BITS


def _number(df: DataFrame, name: str) -> Column:
    """A dimension as a number: long tails shortened, text by its first six bytes, NULL before all."""
    c = F.col(f"`{name}`")
    if isinstance(df.schema[name].dataType, NumericType):
        as_double = c.cast("double")
        return F.coalesce(F.signum(as_double) * F.log1p(F.abs(as_double)), F.lit(-1.0))
    first = F.rpad(F.hex(F.substring(c.cast("string").cast("binary"), 1, 6)), 12, "0")
    return F.coalesce(F.conv(first, 16, 10).cast("double"), F.lit(-1.0))


def shard(
    docs: DataFrame, shards: int | None = None, target_bytes: int | None = None, dims: tuple[str, ...] = ("n_chars", "lang")
) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    ``size`` is the text's UTF-8 bytes (NULL: none) plus 1. The tree is cut
    until leaves hold ``target_bytes``, or until there are ``shards`` leaves.
    The law is ``bytes``: sizes of shards are near equal. Equal texts stay in one
    shard, whatever their metadata, unless they weigh more than the tolerance;
    then they are cut by a hash of doc_id. Their place is that of their least
    value in each dimension. Slots count from 0 without gaps. A
    dimension that is not in the table is left out; NULL comes first. Rows
    that repeat each get a slot; an empty table gives no rows.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    have = [d for d in dims if d in docs.columns]
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("text_hash"),
        F.shiftrightunsigned(F.xxhash64(F.lit("row"), F.col("doc_id")), 64 - ROW_BITS).alias("row_key"),
        *[_number(docs, d).alias(f"d{i}") for i, d in enumerate(have)],
    )
    count = len(have) or 1
    rows = _one_place(materialize(rows, "shard-rows"), count) if have else rows.withColumn("d0", F.lit(0.0))
    rows = rows.withColumn("text_key", F.shiftrightunsigned("text_hash", 64 - TEXT_BITS)).drop("text_hash")
    rows = materialize(rows, "shard-places")
    total, n, *ends = rows.agg(
        F.sum("size"), F.count(F.lit(1)), *[f(f"d{i}") for i in range(count) for f in (F.min, F.max)]
    ).first()
    leaves = shards or max(1, ceil((total or 0) / target_bytes))
    spans = [(ends[2 * i] or 0.0, (ends[2 * i + 1] or 0.0) - (ends[2 * i] or 0.0)) for i in range(count)]
    placed = _cut_tree(rows, leaves, spans)
    return _with_slots(placed, leaves, n).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def _one_place(rows: DataFrame, count: int) -> DataFrame:
    """``rows`` with equal texts at one place; a text that very many rows have is salted."""
    dims = [f"d{i}" for i in range(count)]
    apart = [f(d).alias(f"{n}_{d}") for d in dims for f, n in ((F.min, "least"), (F.max, "most"))]
    texts = rows.groupBy("text_hash", "text_crc32").agg(*apart)
    moved = texts.where(" OR ".join(f"least_{d} < most_{d}" for d in dims)).select(
        "text_hash", "text_crc32", *[f"least_{d}" for d in dims], F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    )
    salted = rows.withColumn("salt", F.pmod("row_key", F.lit(SALTS)).cast("int"))
    met = salted.join(moved, ["text_hash", "text_crc32", "salt"], "left")
    return met.withColumns({d: F.coalesce(f"least_{d}", d) for d in dims}).select(*rows.columns)


def _key(dim: Column, spans: list[tuple[float, float]]) -> Column:
    """A row's key along the dimension of its node: place, then text, then row."""
    place = F.lit(0)
    for i, (low, width) in enumerate(spans):
        if width > 0:
            unit = F.least(F.lit((1 << PLACE_BITS) - 1), F.floor((F.col(f"d{i}") - low) / width * ((1 << PLACE_BITS) - 1)).cast("int"))
            place = F.when(dim == i, unit).otherwise(place)
    place = place.cast("long")
    return F.shiftleft(place, TEXT_BITS + ROW_BITS) + F.shiftleft(F.col("text_key"), ROW_BITS) + F.col("row_key")


def _cut_tree(rows: DataFrame, leaves: int, spans: list[tuple[float, float]]) -> DataFrame:
    """``rows`` with ``shard``: nodes are known by their first leaf; a cut halves the leaves of a node."""
    rows = rows.withColumn("shard", F.lit(0))
    nodes = {0: leaves}
    while any(k > 1 for k in nodes.values()):
        cuts = _cuts(rows, {s: k for s, k in nodes.items() if k > 1}, spans)
        table = rows.sparkSession.createDataFrame(
            [(s, dim, at, nodes[s] // 2) for s, (dim, at) in cuts.items()], "node int, dim int, at long, left int"
        )
        # one row per node: no more rows than shards
        rows = (
            rows.join(F.broadcast(table), F.col("shard") == F.col("node"), "left")
            .withColumn("shard", F.col("shard") + F.when(_key(F.col("dim"), spans) >= F.col("at"), F.col("left")).otherwise(0))
            .drop("node", "dim", "at", "left")
        )
        halves = [((s, k),) if k == 1 else ((s, k // 2), (s + k // 2, k - k // 2)) for s, k in nodes.items()]
        nodes = {s: k for pair in halves for s, k in pair}
    return rows


def _cuts(rows: DataFrame, nodes: dict[int, int], spans: list[tuple[float, float]]) -> dict[int, tuple[int, int]]:
    """For each node its widest dimension and the key of the first row to the right of the cut."""
    wide = rows.groupBy("shard").agg(
        F.sum("size").alias("weight"),
        *[(F.max(f"d{i}") - F.min(f"d{i}")).alias(f"w{i}") for i in range(len(spans))],
    )
    state = {}
    for r in wide.where(F.col("shard").isin(list(nodes)) if len(nodes) < 1000 else F.lit(True)).collect():
        if r["shard"] in nodes:
            shares = [r[f"w{i}"] / width if width > 0 else 0.0 for i, (_, width) in enumerate(spans)]
            k = nodes[r["shard"]]
            state[r["shard"]] = {
                "dim": max(range(len(spans)), key=lambda i: shares[i]), "low": 0, "bits": KEY_BITS,
                "below": 0, "goal": r["weight"] * (k // 2) / k, "slack": r["weight"] * TOLERANCE,
            }
    cuts = {s: (0, 1 << KEY_BITS) for s in nodes if s not in state}
    round_bits = max(4, min(10, (HISTOGRAM_ROWS // max(1, len(nodes))).bit_length() - 1))
    while state:
        for x in state.values():  # bins of whole texts come before bins within one
            step = x["bits"] - round_bits
            x["step"] = max(ROW_BITS if x["bits"] > ROW_BITS else 0, step)
        table = rows.sparkSession.createDataFrame(
            [(s, x["dim"], x["low"], x["low"] + (1 << x["bits"]), x["step"]) for s, x in state.items()],
            "node int, dim int, low long, high long, step int",
        )
        histogram = (
            rows.join(F.broadcast(table), F.col("shard") == F.col("node"))
            .select("node", "low", "high", "step", "size", _key(F.col("dim"), spans).alias("key"))
            .where("key >= low AND key < high")
            .groupBy("node", F.expr("shiftright(key - low, step)").alias("bin"))
            .agg(F.sum("size").alias("weight"))
            .collect()
        )
        by_node: dict[int, list] = {}
        for r in histogram:
            by_node.setdefault(r["node"], []).append((r["bin"], r["weight"]))
        for s, x in list(state.items()):
            for b, weight in sorted(by_node[s]):
                if x["below"] + weight >= x["goal"]:
                    break
                x["below"] += weight
            low = x["low"] + (b << x["step"])
            if weight > x["slack"] and x["step"]:
                x["low"], x["bits"] = low, x["step"]
                continue
            nearer = x["goal"] - x["below"] < x["below"] + weight - x["goal"]
            cuts[s] = (x["dim"], low if nearer else low + (1 << x["step"]))
            del state[s]
    return cuts


def _with_slots(rows: DataFrame, leaves: int, n: int) -> DataFrame:
    """Number the rows of each shard: inside hashed buckets of bounded size, after the rows of earlier buckets."""
    from pyspark.sql import Window

    buckets = max(1, ceil(n / leaves / SLOT_ROWS))
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "text_key", F.lit("slot")), F.lit(buckets)))
    counts = rows.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("shard", "bucket").orderBy("doc_id", "text_crc32", "size")
    return rows.withColumn("rank", F.row_number().over(inside)).join(starts, ["shard", "bucket"]).withColumn(
        "slot", (F.col("before") + F.col("rank") - 1).cast("long")
    )
