"""Batch operators on change records.

A change record has ``_metadata_table``, ``_op`` (INSERT, UPDATE or DELETE),
``_ts``, ``_seq`` and the payload of the row after the change.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionlake.workspace import materialize

ORDER = ["_ts", "_seq"]
ENVELOPE = ["_metadata_table", "_op", "_ts", "_seq"]


def latest(df: DataFrame, keys: list[str], order: list[str] = ORDER) -> DataFrame:
    """The last change of each key.

    Changes that are equal in ``order`` are told apart by operation and then by
    a hash of the row, so the result does not depend on the order of rows. An
    aggregate, not a window: every task keeps one row per key before the
    shuffle, so a key with a third of all changes costs one row per task. Rows
    are structs, so the aggregate sorts by key; keep the payload narrow.
    """
    rest = [c for c in df.columns if c not in keys]
    ties = [F.col("_op")] if "_op" in rest and "_op" not in order else []
    newest = F.max_by(F.struct(*rest), F.struct(*order, *ties, F.xxhash64(*rest)))
    return df.groupBy(*keys).agg(newest.alias("_row")).select(*keys, "_row.*")


def apply_changes(
    base: DataFrame,
    changes: DataFrame,
    keys: list[str],
    order: list[str] = ORDER,
    op: str = "_op",
) -> DataFrame:
    """``base`` after inserts, updates and deletes; ``base`` has one row per key.

    Rows of ``base`` without a change pass through an anti join. The last
    changes are written once and used twice; where they are small, they are
    broadcast by their known size, and ``base`` is then not shuffled at all.
    """
    last = materialize(latest(changes, keys, order), "last_changes")
    same = reduce(
        Column.__and__, [F.col(f"b.{k}").eqNullSafe(F.col(f"c.{k}")) for k in keys]
    )
    touched = last.select(*keys).alias("c")
    untouched = base.alias("b").join(touched, same, "left_anti")
    alive = last.filter(~F.col(op).eqNullSafe("DELETE"))
    return untouched.unionByName(alive.select(*base.columns))


def with_backfill(snapshot: DataFrame, changes: DataFrame, table: str | None = None) -> DataFrame:
    """A full copy of the source as inserts that precede every change."""
    first = snapshot.select(
        "*",
        F.lit("INSERT").alias("_op"),
        F.lit(None).cast("timestamp_ntz").alias("_ts"),
        F.lit(-1).cast("bigint").alias("_seq"),
    )
    if table is not None:
        first = first.withColumn("_metadata_table", F.lit(table))
    return first.unionByName(changes, allowMissingColumns=True)


def with_reasons(df: DataFrame, rules: Mapping[str, Column], out: str = "_reasons") -> DataFrame:
    """Add the names of the rules a row breaks; a rule that is NULL counts as broken."""
    broken = [
        F.when(F.coalesce(ok, F.lit(False)), None).otherwise(F.lit(name)) for name, ok in rules.items()
    ]
    return df.withColumn(out, F.array_compact(F.array(*broken)))


def split_valid(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Rows that pass all rules, and the others with the names of the broken rules."""
    checked = with_reasons(df, rules)
    valid = checked.filter(F.size("_reasons") == 0).drop("_reasons")
    return valid, checked.filter(F.size("_reasons") > 0)


def route(df: DataFrame, template: str = "{_metadata_table}_log", out: str = "_target") -> DataFrame:
    """Add the name of the table each change goes to, from a ``{column}`` template."""
    pieces = []
    rest = template
    while "{" in rest:
        text, _, rest = rest.partition("{")
        column, _, rest = rest.partition("}")
        pieces += [F.lit(text), F.col(column)]
    return df.withColumn(out, F.concat(*pieces, F.lit(rest)))


def select_sources(
    df: DataFrame, allow: Iterable[str] = (), reject: Iterable[str] = (), column: str = "_metadata_table"
) -> DataFrame:
    """Changes of the allowed tables without the rejected ones; no list means all."""
    allow, reject = list(allow), list(reject)
    if allow:
        df = df.filter(F.col(column).isin(allow))
    if reject:
        df = df.filter(~F.col(column).isin(reject))
    return df


def since(df: DataFrame, start: str, column: str = "_ts") -> DataFrame:
    """Changes from ``start`` on."""
    return df.filter(F.col(column) >= F.lit(start).cast("timestamp_ntz"))


def high_watermark(df: DataFrame, column: str = "_seq", by: str | None = None) -> DataFrame:
    """The greatest position seen, for all changes or per ``by``."""
    top = F.max(column).alias("high_watermark")
    return df.groupBy(by).agg(top) if by else df.agg(top)
