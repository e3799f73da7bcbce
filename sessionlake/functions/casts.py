"""Casts that give NULL for a value that does not fit."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, IntegralType, StringType

# What a cast reads as a whole number, blanks and control characters around it.
_BLANK = r"[\x00-\x20\x7f]*"
WHOLE_NUMBER = rf"^{_BLANK}[+-]?[0-9]+{_BLANK}$"
INTEGRAL = ("tinyint", "smallint", "int", "bigint")


def fit(c: Column, have: DataType, want: DataType | str) -> Column:
    """``c`` as ``want``, NULL where it cannot be.

    A failing cast of text to a number costs about ten times a good one, so
    text that is no number is told apart by its pattern first.
    """
    whole = isinstance(want, IntegralType) or want in INTEGRAL
    if isinstance(have, StringType) and whole:
        return F.when(c.rlike(WHOLE_NUMBER), c.try_cast(want))
    return c.try_cast(want)
