"""Bring nested data to a declared contract: cast what is there, NULL what is not."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, DateType, MapType, StringType, StructType

from sessionlake.functions.casts import fit
from sessionlake.functions.dates import parse_date


def same_shape(have: DataType, want: DataType) -> bool:
    """True if the types differ in their leaves only, so that a cast can bridge them."""
    if isinstance(want, StructType):
        return (
            isinstance(have, StructType)
            and have.fieldNames() == want.fieldNames()
            and all(same_shape(h.dataType, w.dataType) for h, w in zip(have.fields, want.fields))
        )
    if isinstance(want, ArrayType):
        return isinstance(have, ArrayType) and same_shape(have.elementType, want.elementType)
    if isinstance(have, (StructType, ArrayType, MapType)):
        return False
    # a text date has a format of its own
    return not (isinstance(want, DateType) and isinstance(have, StringType))


def conform_column(c: Column, have: DataType | None, want: DataType, item: bool = False) -> Column:
    """``c``, of type ``have``, as ``want``. ``have`` None means the field is absent.

    Values that do not fit become NULL. Structs of the root are always built,
    so an absent one becomes a struct of NULLs; inside array items (``item``) a
    NULL struct stays NULL. Arrays are changed in place, not exploded: with one
    compiled cast if their items have the wanted shape, as those read with
    ``read_schema`` do, else item by item.
    """
    if have is None and (item or not isinstance(want, StructType)):
        return F.lit(None).cast(want)
    if isinstance(want, StructType):
        fields = {f.name: f.dataType for f in have.fields} if isinstance(have, StructType) else {}
        made = F.struct(
            *[
                conform_column(
                    c.getField(f.name) if f.name in fields else F.lit(None),
                    fields.get(f.name),
                    f.dataType,
                    item,
                ).alias(f.name)
                for f in want.fields
            ]
        )
        return F.when(c.isNotNull(), made) if item else made
    if isinstance(want, ArrayType):
        if not isinstance(have, ArrayType):
            return F.lit(None).cast(want)
        if same_shape(have, want):
            return c if have == want else c.try_cast(want)
        return F.transform(
            c, lambda x: conform_column(x, have.elementType, want.elementType, item=True)
        )
    if have == want:
        return c
    if isinstance(have, (StructType, ArrayType, MapType)) and not isinstance(want, StringType):
        return F.lit(None).cast(want)
    if isinstance(want, DateType) and isinstance(have, StringType):
        return parse_date(c)
    return fit(c, have, want)


def conform(df: DataFrame, contract: StructType, keep: list[str] | None = None) -> DataFrame:
    """Exactly the contract's columns, in its order, then the columns in ``keep``.

    One projection: no shuffle, and no long chain of added columns to analyse.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    columns = [
        conform_column(F.col(f.name) if f.name in types else F.lit(None), types.get(f.name), f.dataType)
        .alias(f.name)
        for f in contract.fields
    ]
    return df.select(*columns, *(keep or []))


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast the named columns that exist and keep every other column as it is."""
    return df.select(
        [
            fit(F.col(f.name), f.dataType, types[f.name]).alias(f.name)
            if f.name in types
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def silver(df: DataFrame, types: Mapping[str, str], date: str = "date") -> DataFrame:
    """Root casts plus the text date replaced by a DATE."""
    return cast_columns(df, types).withColumn(date, parse_date(F.col(date)))
