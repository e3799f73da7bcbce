"""Near-duplicates by the Jaccard similarity of word shingles: MinHash bands, then an exact check.

A text is the set of its shingles of five words. Texts that share the least
hashes of one of ``BANDS`` bands may be alike, and only such pairs are checked,
with whole sets. A pair at a similarity of exactly 0.8 shares no band with a
chance of (1 - 0.8 ** ROWS) ** BANDS, two in a million, and a closer one with
less. The chance of unlike texts to share one does not depend on how common
single passages are.

Members of a band's group are first checked against the one of them that shares
bands with most others. Only groups that this leaves in several components go
on, and there the prefix principle finds all other pairs: with the shingles of
each set in one order, rare ones first, two sets that are alike share one of
their first shingles. The sets of a key's largest component are compared with
those of other components, not with each other. So a large group of near copies
takes no pair of all with all.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField

from sessionlake.llm.arrow import LOWER, NOT_BLANK, ODD, RangeHash, add_columns, mixed, salt, text_bytes, words
from sessionlake.llm.components import components
from sessionlake.llm.simhash import first_of_each, text_key
from sessionlake.llm.steps import step

SHINGLE = 5
SIMILARITY = 0.8
BANDS = 25
ROWS = 4

#: A number for each of the random orders of which a text's least hash is taken.
ORDERS = mixed(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64) * ODD)


def shingles(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes, in order within each text, and the n + 1 offsets.

    A text of fewer words is one shingle, and so is one without words.
    """
    data, n = LOWER[data], len(at) - 1
    starts, ends, _ = words(data, at, NOT_BLANK)
    word = RangeHash(data).of(starts, ends)
    count = np.diff(np.searchsorted(starts, at))
    made = np.maximum(count - SHINGLE + 1, 1)
    owner = np.repeat(np.arange(n), made)
    first = (np.cumsum(count) - count)[owner] + np.arange(len(owner)) - (np.cumsum(made) - made)[owner]
    size = np.minimum(count, SHINGLE)[owner]
    word = np.append(word, np.zeros(SHINGLE, np.uint64))
    value = size.astype(np.uint64)
    for k in range(SHINGLE):
        value = np.where(k < size, mixed(value * ODD + word[first + k] + salt(k + 1)), value)
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    return value[new], np.append(0, np.cumsum(np.bincount(owner[new], minlength=n)))


def _prints(part: pa.RecordBatch) -> dict[str, pa.Array]:
    """``same``, a hash of each text's set, and ``bands``."""
    value, at = shingles(*text_bytes(part.column("text")))
    if not len(at) - 1:
        return {"same": pa.array([], pa.int64()), "bands": pa.array([], pa.list_(pa.int64()))}
    same = mixed(np.add.reduceat(mixed(value + ODD), at[:-1]) + np.diff(at).astype(np.uint64) * ODD)
    bands = np.empty((len(at) - 1, BANDS), np.uint64)
    for band in range(BANDS):
        key = np.full(len(at) - 1, salt(band + 1))
        for row in range(ROWS):
            key = mixed(key * ODD + np.minimum.reduceat(mixed(value ^ ORDERS[band * ROWS + row]), at[:-1]))
        bands[:, band] = key
    offsets = pa.array(np.arange(len(at), dtype=np.int32) * BANDS)
    return {"same": pa.array(same.view(np.int64)), "bands": pa.ListArray.from_arrays(offsets, pa.array(bands.reshape(-1).view(np.int64)))}


def _sets(part: pa.RecordBatch) -> dict[str, pa.Array]:
    value, at = shingles(*text_bytes(part.column("text")))
    return {"shingles": pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(value.view(np.int64)))}


def _alike(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (u, v) whose sets have the similarity or more."""
    a = sets.select(F.col("same").alias("u"), F.col("shingles").alias("x"))
    b = sets.select(F.col("same").alias("v"), F.col("shingles").alias("y"))
    shared, both = F.size(F.array_intersect("x", "y")), F.size("x") + F.size("y")
    fit = F.least(F.size("x"), F.size("y")) >= similarity * F.greatest(F.size("x"), F.size("y"))
    return pairs.distinct().join(a, "u").join(b, "v").where(fit).where(shared >= similarity * (both - shared)).select("u", "v")


def _rooted(members: DataFrame, roots: DataFrame) -> DataFrame:
    named = roots.select(F.col("node").alias("same"), "root")
    return members.join(named, "same", "left").select("band", "same", F.coalesce("root", "same").alias("root"))


def _prefixes(sets: DataFrame, similarity: float) -> DataFrame:
    """(key, same, root, n, place): the first shingles of each set, rare ones first, that alike sets cannot all lack.

    A shingle that one set has alone takes its place but is no key.
    """
    each = sets.select("same", F.explode("shingles").alias("key"))
    often = each.groupBy("key").agg(F.count(F.lit(1)).alias("often"))
    n, first = F.size("ordered"), F.floor(F.size("ordered") * (1 - similarity) + 1e-9).cast("int") + 1
    ordered = (
        each.join(often, "key").groupBy("same").agg(F.sort_array(F.collect_list(F.struct("often", "key"))).alias("ordered"))
        .select("same", n.alias("n"), F.posexplode(F.slice("ordered", F.lit(1), first)).alias("place", "x"))
        .where("x.often > 1")
    )
    return ordered.join(sets.select("same", "root"), "same").select("x.key", "same", "root", "n", "place")


def candidates(sets: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Pairs (u, v) of ``sets`` (same, root, shingles) of different roots; none that is alike is missing."""
    rows = step(_prefixes(sets, similarity), "prefixes")
    roots = rows.groupBy("key", "root").agg(F.count(F.lit(1)).alias("size"))
    largest = roots.groupBy("key").agg(F.max_by("root", F.struct("size", "root")).alias("largest"), F.count(F.lit(1)).alias("roots"))
    dealt = rows.join(largest.where("roots > 1").drop("roots"), "key").withColumn("inside", F.col("root") == F.col("largest")).drop("largest")
    a, b = (dealt.select("key", *[F.col(c).alias(c + side) for c in ("same", "root", "n", "place", "inside")]) for side in "ab")
    least, most = F.least("na", "nb"), F.greatest("na", "nb")
    # what both can still share from this key on, if it is the first that they share
    rest = F.least(F.col("na") - F.col("placea"), F.col("nb") - F.col("placeb"))
    fit = (least >= similarity * most - 1e-9) & (rest >= similarity / (1 + similarity) * (F.col("na") + F.col("nb")) - 1e-9)
    once = F.col("insideb") | (F.col("samea") < F.col("sameb"))
    pairs = a.where("NOT insidea").join(b, "key").where((F.col("roota") != F.col("rootb")) & fit & once)
    return pairs.select(F.least("samea", "sameb").alias("u"), F.greatest("samea", "sameb").alias("v")).distinct()


def links(members: DataFrame, sets: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Pairs (u, v) of alike sets that connect all that alike pairs of a common band connect.

    ``members`` has (band, same), ``sets`` (same, shingles).
    """
    # the text that copies were made from shares bands with most of them, so it leads
    sizes = members.groupBy("band").agg(F.count(F.lit(1)).alias("size"))
    degree = members.join(sizes, "band").groupBy("same").agg(F.sum("size").alias("degree"))
    ranked = members.join(degree, "same").groupBy("band")
    lead = ranked.agg(F.max_by("same", F.struct("degree", "same")).alias("u"))
    pairs = members.join(lead, "band").where("u <> same").select("u", F.col("same").alias("v"))
    found = step(_alike(pairs, sets, similarity), "links")
    rooted = _rooted(members, components(found))
    groups = rooted.groupBy("band").agg(F.min("root").alias("a"), F.max("root").alias("b")).where("a <> b")
    open_ = rooted.join(groups.select("band"), "band").select("same", "root").distinct()
    # equal pairs are not looked for again: their sets have one root
    held = step(sets.join(open_, "same").select("same", "root", "shingles"), "open")
    more = _alike(step(candidates(held, similarity), "candidates"), sets, similarity)
    return step(found.unionByName(more), "links")


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_key, root and component_id.

    Texts link whose five-word shingles, in lower case of A-Z, have a Jaccard
    similarity of ``similarity`` or more; what is connected is one component.
    ``component_id`` is its smallest doc_id, NULL if none of its rows has one.
    Texts of fewer than five words link if their words are equal, and texts
    without words (NULL too) with each other. An empty table gives no rows.
    """
    named = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), text_key(docs).alias("text_key"))
    fields = [StructField("same", LongType()), StructField("bands", ArrayType(LongType()))]
    rows = step(add_columns(named, "text", fields, _prints, ("text",)), "prints")
    classes = rows.groupBy("same").agg(F.min("doc_id").alias("first_id"), F.first("bands").alias("bands"))
    spread = classes.select("same", F.explode("bands").alias("band"))
    shared = spread.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("band")
    members = step(spread.join(shared, "band", "left_semi").select("band", "same"), "members")
    wanted = rows.join(members.select("same").distinct(), "same", "left_semi").groupBy("same").agg(F.min("text_key").alias("text_key"))
    texts = named.select("text", "text_key").join(wanted, "text_key").select("same", "text")
    made = add_columns(texts, "text", [StructField("shingles", ArrayType(LongType()))], _sets, ("text",))
    sets = step(made.dropDuplicates(["same"]), "sets")
    roots = components(links(members, sets, similarity))
    rooted = rows.select("same", "doc_id", "text_key").join(roots, rows["same"] == roots["node"], "left").select(
        "doc_id", "text_key", F.coalesce("root", "same").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return rooted.join(least, "root").select("doc_id", "text_key", "root", "component_id")


def keep_first(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` with one row of each component: one with the smallest doc_id, or without doc_id if none has one."""
    return first_of_each(docs, near_duplicates(docs, similarity))


def joined(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows like those of ``near_duplicates``, of the components that two such frames of the same rows make together.

    What either of them connects is connected.
    """
    own = a.select("doc_id", "text_key", F.col("root").alias("x"))
    other = b.groupBy("text_key").agg(F.min("root").alias("y"))  # equal texts have one root
    both = step(own.join(other, "text_key"), "both")
    least = both.groupBy("x").agg(F.min("y").alias("least"), F.max("y").alias("most")).where("least <> most")
    edges = both.select("x", "y").distinct().join(least, "x").where("y <> least").select(F.col("y").alias("u"), F.col("least").alias("v"))
    roots = components(edges)
    rooted = both.join(roots, both["y"] == roots["node"], "left").select("doc_id", "text_key", F.coalesce("root", "y").alias("root"))
    ids = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return rooted.join(ids, "root").select("doc_id", "text_key", "root", "component_id")
