"""Date expressions. None of them depends on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionlake.contracts import RAW_DATE_FORMAT


def parse_date(c: Column, fmt: str = RAW_DATE_FORMAT) -> Column:
    """Text to DATE, NULL where the text is no date."""
    return F.try_to_date(c, fmt)


def day_of(c: Column) -> Column:
    """The DATE of a timestamp."""
    return F.to_date(c)


def epoch_seconds(c: Column) -> Column:
    """Seconds since 1970 of a TIMESTAMP_NTZ, read as UTC."""
    days = F.datediff(F.to_date(c), F.lit("1970-01-01").cast("date")).cast("bigint")
    return days * 86400 + F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c)


def ymd(c: Column) -> list[Column]:
    """Year, month and day of a DATE as the partition columns."""
    return [
        F.year(c).alias("year"),
        F.month(c).alias("month"),
        F.dayofmonth(c).alias("day"),
    ]


def with_ymd(df: DataFrame, c: Column | str = "date") -> DataFrame:
    return df.select("*", *ymd(F.col(c) if isinstance(c, str) else c))


def date_group(c: Column, name: str = "date") -> dict[str, Column]:
    """The timeframes of a date dimension; weeks start on Monday."""
    return {
        f"{name}_raw": c,
        f"{name}_date": c,
        f"{name}_week": F.trunc(c, "week"),
        f"{name}_month": F.date_format(c, "yyyy-MM"),
        f"{name}_month_name": F.date_format(c, "MMMM"),
        f"{name}_quarter": F.concat(F.year(c).cast("string"), F.lit("-Q"), F.quarter(c).cast("string")),
        f"{name}_year": F.year(c),
    }


# Month names of the dashboard filters.
MONTH_NAMES = [
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
]


def month_number(name: str) -> int:
    return MONTH_NAMES.index(name) + 1


def two_digits(c: Column) -> Column:
    """Day number with a leading zero."""
    return F.lpad(c.cast("string"), 2, "0")
