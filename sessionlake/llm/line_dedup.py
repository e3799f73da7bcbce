"""Line deduplication by a deletion-neighbourhood join, in DataFrame functions only.

Lines within one edit of each other agree once one character is deleted from
one or both: the longer one without a character is the shorter one, and two of
equal length agree without the character that differs. So the deletion
variants of lines are emitted as hashed keys, and lines that share a key with
the same place (or a variant with a whole line) are one edit apart.

A line has as many variants as characters. Before they are emitted, rounds of
halving rule out lines that can have no partner: the edit lies in one half, so
the other half is shared. A round keeps the halves that two lines share, and
goes on within the half that may hold the edit, until that is short. Groups
are counted and their earliest line is taken by aggregates; no pairs within a
group are made, so a group may hold any share of the lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionlake.llm.steps import step

#: Edits within which lines count as the same.
MAX_EDITS = 1

#: Shorter lines must be equal to count as the same: one edit makes another word of them.
MIN_CHARS = 20

#: Characters within which the edit may lie when variants are emitted.
VARIANT_CHARS = 24

ORDER = ("d", "t", "i")


def _document_key(docs: DataFrame) -> list[Column]:
    return [
        F.coalesce(docs["doc_id"].cast("long"), F.lit((1 << 63) - 1)).alias("d"),
        F.xxhash64(docs["text"].cast("string")).alias("t"),
    ]


def _lines(docs: DataFrame) -> DataFrame:
    """Lines with a word: document key, number, text and a hash of 128 bits."""
    rows = docs.select(*_document_key(docs), F.posexplode(F.split(docs["text"].cast("string"), "\n")).alias("i", "line"))
    return rows.where(F.col("line").rlike(r"[^\x20\x09-\x0D]")).withColumns(
        {"a": F.xxhash64("line"), "b": F.xxhash64(F.lit("line"), F.col("line"))}
    )


def _distinct(lines: DataFrame) -> DataFrame:
    """(a, b, order, n, keys): first place and number of equal lines, and the keys of their halves; no texts are moved."""
    keys = F.when(F.length("line") >= MIN_CHARS, _half_keys(F.col("line")))
    held = lines.select("a", "b", _order().alias("order"), keys.alias("keys")).groupBy("a", "b")
    return held.agg(F.min("order").alias("first"), F.count(F.lit(1)).alias("n"), F.first("keys").alias("keys")).select(
        "a", "b", "first.*", "n", "keys"
    )


def _order(prefix: str = "") -> Column:
    return F.struct(*[F.col(f"{prefix}{c}") for c in ORDER])


def _halves(key: Column, rest: Column) -> Column:
    """Ways to share a half of ``rest``: the key so far with the shared half, and what is left.

    A line of n characters shares its first n // 2 with one of n or n + 1, or
    its last n - n // 2; for the longer of the two these are counted from n - 1.
    """
    n = F.length(rest)
    made = [(k, F.substring(rest, h + 1, n - h)) for k, h in _first_keys(key, rest)]
    made += [(k, F.left(rest, n - s)) for k, s in _last_keys(key, rest)]
    return F.array_distinct(F.array(*[F.named_struct(F.lit("key"), k, F.lit("rest"), r) for k, r in made]))


def _first_keys(key: Column, rest: Column) -> list[tuple[Column, Column]]:
    n = F.length(rest)
    sizes = [F.floor(n / 2).cast("int"), F.floor((n - 1) / 2).cast("int")]
    return [(F.xxhash64(key, F.lit("first"), h, F.left(rest, h)), h) for h in sizes]


def _last_keys(key: Column, rest: Column) -> list[tuple[Column, Column]]:
    n = F.length(rest)
    sizes = [F.floor((n + 1) / 2).cast("int"), F.floor(n / 2).cast("int")]
    return [(F.xxhash64(key, F.lit("last"), s, F.right(rest, s)), s) for s in sizes]


def _half_keys(line: Column) -> Column:
    """The keys of a line's halves alone, in the order of ``_halves``."""
    pairs = _first_keys(F.lit(0), line) + _last_keys(F.lit(0), line)
    return F.array_distinct(F.array(*[k for k, _ in pairs]))


def _shared(rows: DataFrame) -> DataFrame:
    """Rows whose key belongs to two lines or more."""
    keys = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    return rows.join(keys, "key", "left_semi")


def _long_candidates(docs: DataFrame, distinct: DataFrame) -> DataFrame:
    """(a, b, order, ways, line): texts of lines that share a half with another line, and by which of their ways."""
    keys = distinct.select("a", "b", *ORDER, F.posexplode("keys").alias("way", "key"))
    ways = _shared(keys).groupBy("a", "b", *ORDER).agg(F.collect_list("way").alias("ways"))
    wanted = ways.groupBy("d", "t").agg(F.collect_list(F.struct("a", "b", "i", "ways")).alias("wanted"))
    texts = docs.select(*_document_key(docs), F.split(docs["text"].cast("string"), "\n").alias("lines"))
    found = texts.join(wanted, ["d", "t"]).select("d", "t", "lines", F.explode("wanted").alias("x"))
    # rows that repeat give a line more than once
    return found.select("x.a", "x.b", "d", "t", "x.i", "x.ways", F.get("lines", F.col("x.i")).alias("line")).dropDuplicates(["a", "b"])


def _candidates(long: DataFrame) -> DataFrame:
    """(a, b, order, key, rest): lines with a possible partner and the few characters that may differ."""
    rows = long.select("a", "b", *ORDER, _halves(F.lit(0), F.col("line")).alias("x"), F.explode("ways").alias("way"))
    rows = rows.select("a", "b", *ORDER, F.get("x", F.col("way")).alias("x")).select("a", "b", *ORDER, "x.key", "x.rest")
    rows = step(rows, "rests")
    done = []
    while True:
        # a rest that is one longer may belong to one of these, or go on with others of its length
        done.append(rows.where(F.length("rest") <= VARIANT_CHARS + 1))
        more = rows.where(F.length("rest") > VARIANT_CHARS)
        if more.isEmpty():
            break
        split = more.select("a", "b", *ORDER, F.explode(_halves(F.col("key"), F.col("rest"))).alias("x")).select(
            "a", "b", *ORDER, "x.key", "x.rest"
        )
        rows = step(_shared(split), "rests")
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def _near(candidates: DataFrame, long: DataFrame) -> DataFrame:
    """(a, b) of lines with an earlier line within one edit."""
    rest, n = F.col("rest"), F.length("rest")
    without = F.transform(
        F.sequence(F.lit(1), n),
        lambda p: F.named_struct(
            F.lit("key"), F.xxhash64(F.col("key"), F.concat(F.substring(rest, F.lit(1), p - 1), F.substring(rest, p + 1, n - p))),
            F.lit("place"), p,
        ),
    )
    whole = F.array(F.named_struct(F.lit("key"), F.xxhash64("key", "rest"), F.lit("place"), F.lit(0)))
    variants = F.when(n > 0, F.concat(whole, without)).otherwise(whole)
    rows = candidates.select("a", "b", _order().alias("order"), F.explode(variants).alias("x")).select(
        "a", "b", "order", F.col("x.key").alias("key"), F.col("x.place").alias("place")
    )
    line = F.struct("order", "a", "b")
    # two lines without the same character, or a whole line and a longer one without a character
    alike = rows.where("place > 0").groupBy("key", "place").agg(F.min(line).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    within = rows.groupBy("key").agg(
        F.min(F.when(F.col("place") == 0, line)).alias("whole"), F.min(F.when(F.col("place") > 0, line)).alias("longer")
    ).where("whole IS NOT NULL AND longer IS NOT NULL")
    pairs = (
        rows.join(alike.select("key", "place", "first"), ["key", "place"])
        .unionByName(
            rows.join(within, "key").select(
                "key", "place", "a", "b", "order", F.when(F.col("place") == 0, F.col("longer")).otherwise(F.col("whole")).alias("first")
            )
        )
        .where("first.order < order")
        .select("a", "b", F.col("first.a").alias("a0"), F.col("first.b").alias("b0"))
        .distinct()
    )
    earlier = long.select(F.col("a").alias("a0"), F.col("b").alias("b0"), F.col("line").alias("line0"))
    verified = pairs.join(long.select("a", "b", "line"), ["a", "b"]).join(earlier, ["a0", "b0"])
    return verified.where(F.levenshtein("line", "line0", MAX_EDITS) >= 0).select("a", "b").distinct()


def mark_lines(docs: DataFrame) -> DataFrame:
    """Lines to remove: one row per document key (d, t) with the numbers of ``copies`` and ``near`` lines.

    A line goes if an equal one comes earlier, by (doc_id, text hash, line
    number), or if its text is within one edit of another whose first
    occurrence comes earlier than its own. A blank line never goes. Documents
    without doc_id come last.
    """
    distinct = step(_distinct(_lines(docs)), "lines")
    long = step(_long_candidates(docs, distinct), "candidates")
    near = step(_near(_candidates(long), long), "near")
    first = [F.col(c).alias(f"{c}0") for c in ORDER]
    repeated = distinct.where("n > 1").select("a", "b", *first)
    marked = near.withColumn("near", F.lit(True))
    affected = repeated.join(marked, ["a", "b"], "full").withColumn("near", F.coalesce("near", F.lit(False)))
    spots = _lines(docs).select(*ORDER, "a", "b").join(affected, ["a", "b"])
    goes = spots.where("near OR struct(d, t, i) <> struct(d0, t0, i0)")
    return goes.groupBy("d", "t").agg(
        F.collect_set(F.when(~F.col("near"), F.col("i"))).alias("copies"), F.collect_set(F.when(F.col("near"), F.col("i"))).alias("near")
    )


def remove_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with the lines that ``mark_lines`` names cut out of ``text``, and n_lines, n_copies and n_near.

    Rows with the same doc_id and text are one document and are treated alike.
    NULL stays NULL with 0 lines; a text of which every line goes is empty;
    blank lines stay. Columns of the input with the three names give way.
    """
    added = ("n_lines", "n_copies", "n_near")
    kept = [c for c in docs.columns if c.lower() not in added]
    # the row as one column, so that no name of its own can clash
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *_document_key(docs))
    lines = F.split(F.col("row.text").cast("string"), "\n")
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.concat("copies", "near"))
    cut = F.array_join(F.transform(left, lambda i: F.get(lines, i)), "\n")
    text = F.when(F.col("copies").isNull(), F.col("row.text")).otherwise(cut)
    counts = [F.when(F.col(c).isNull(), 0).otherwise(F.size(c)).cast("long").alias(f"n_{c}") for c in ("copies", "near")]
    n_lines = F.when(F.col("row.text").isNull(), 0).otherwise(F.size(lines)).cast("long").alias("n_lines")
    return rows.join(mark_lines(docs), ["d", "t"], "left").select(
        *[text.alias(c) if c == "text" else F.col("row")[c].alias(c) for c in kept], n_lines, *counts
    )


def without_copies(docs: DataFrame) -> DataFrame:
    """``docs`` without repeated lines; a document that had lines and lost them all goes."""
    added = ("n_lines", "n_copies", "n_near")
    lost = (F.col("n_copies") + F.col("n_near") > 0) & ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    left = remove_lines(docs).where(F.coalesce(~lost, F.lit(True)))
    return left.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in added])
