"""Rows in the order of a space-filling curve, so that files are narrow in several columns at once."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, NumericType, StringType, TimestampNTZType, TimestampType

#: Bits of a column's rank: 2 ** BITS ranges of about as many rows each.
BITS = 8

#: Error of the quantiles: one in so many rows.
ACCURACY = 10_000


def as_number(c: Column, kind: DataType) -> Column:
    """A double that orders values as the column does; of text the first six bytes count."""
    if isinstance(kind, StringType):
        return F.conv(F.rpad(F.hex(F.substring(c.cast("binary"), 1, 6)), 12, "0"), 16, 10).cast("double")
    if isinstance(kind, DateType):
        return F.unix_date(c).cast("double")
    if isinstance(kind, TimestampType | TimestampNTZType):
        return F.unix_micros(c.cast("timestamp")).cast("double")
    if isinstance(kind, NumericType):
        return c.cast("double")
    return c.cast("int").cast("double")


def _cuts(df: DataFrame, numbers: list[str], bits: int) -> list[list[float]]:
    """2 ** bits - 1 quantiles of each column, from sketches that tasks make and Spark merges."""
    shares = F.array(*[F.lit(k / (1 << bits)) for k in range(1, 1 << bits)])
    row = df.agg(*[F.percentile_approx(n, shares, ACCURACY).alias(n) for n in numbers]).first()
    return [list(row[n]) if row[n] else [0.0] * ((1 << bits) - 1) for n in numbers]


def _rank(value: Column, cuts: list[float], bits: int) -> Column:
    """How many cuts are not above the value, by halves; 0 for NULL."""
    all_cuts = F.array(*[F.lit(c) for c in cuts])
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(bits))])

    def one(rank: Column, size: Column) -> Column:
        return F.when(F.get(all_cuts, rank + size - 1) <= value, rank + size).otherwise(rank)

    return F.coalesce(F.aggregate(steps, F.lit(0), one), F.lit(0))


def interleaved(ranks: list[Column], bits: int) -> Column:
    """The bits of all ranks taken in turn, the highest of each first."""
    places = [(b, k) for b in reversed(range(bits)) for k in range(len(ranks))]
    total = len(places)
    parts = [
        F.shiftleft(F.shiftright(ranks[k], b).bitwiseAND(F.lit(1)).cast("long"), total - 1 - at)
        for at, (b, k) in enumerate(places)
    ]
    return reduce(Column.bitwiseOR, parts)


def with_curve(df: DataFrame, columns: Mapping[str, Column], bits: int = BITS, name: str = "_curve") -> DataFrame:
    """``df`` with the place of each row on a curve through the named expressions.

    Ranges of each expression are cut at its quantiles, which a first pass over
    those leaves finds; so the curve fits values of any spread. NULL comes first.
    """
    if bits * len(columns) > 63:
        raise ValueError("at most 63 bits in all")
    shown = df.select(*[c.alias(f"_{k}") for k, c in enumerate(columns.values())])
    kinds = [f.dataType for f in shown.schema.fields]
    values = [as_number(F.col(f"_{k}"), kind).alias(f"_{k}") for k, kind in enumerate(kinds)]
    numbers = [f"_{k}" for k in range(len(columns))]
    cuts = _cuts(shown.select(*values), numbers, bits)
    ranks = {
        f"_rank{k}": _rank(as_number(c, kind), cut, bits)
        for k, (c, kind, cut) in enumerate(zip(columns.values(), kinds, cuts, strict=True))
    }
    ranked = df.withColumns(ranks)
    return ranked.withColumn(name, interleaved([F.col(r) for r in ranks], bits)).drop(*ranks)
