from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from sessionlake.functions.casts import fit
from sessionlake.functions.dates import date_group, epoch_seconds, month_number, parse_date, two_digits, with_ymd
from sessionlake.functions.paths import (
    data_glob, is_marker, parse_upload_path, staging_name, staging_name_of, upload_folder, zone_path,
)

MARKER_PATH = "customer01/sessions/2017-06-13/end_file.txt"


def one(spark, c):
    return spark.range(1).select(c.alias("v")).collect()[0].v


def test_parse_date(spark):
    assert one(spark, parse_date(F.lit("20170601"))) == dt.date(2017, 6, 1)
    assert one(spark, parse_date(F.lit("bad"))) is None
    assert one(spark, parse_date(F.lit("20170231"))) is None


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Tokyo"])
def test_dates_do_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert one(spark, epoch_seconds(F.expr("TIMESTAMP_NTZ'2017-06-01 00:00:59'"))) == 1496275259
        assert one(spark, parse_date(F.lit("20170601")).cast("string")) == "2017-06-01"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_date_group(spark):
    group = date_group(F.lit(dt.date(2017, 6, 1)))
    row = spark.range(1).select(*[c.alias(n) for n, c in group.items()]).collect()[0]
    assert row.date_week == dt.date(2017, 5, 29)
    assert (row.date_month, row.date_month_name, row.date_quarter, row.date_year) == (
        "2017-06", "June", "2017-Q2", 2017,
    )
    assert month_number("June") == 6


def test_ymd_is_not_padded_but_the_day_text_is(spark):
    df = spark.sql("SELECT DATE'2017-06-01' AS date")
    assert tuple(with_ymd(df).collect()[0])[1:] == (2017, 6, 1)
    assert one(spark, two_digits(F.lit(7))) == "07" and one(spark, two_digits(F.lit(17))) == "17"


def test_upload_path(spark):
    parts = parse_upload_path(F.lit(MARKER_PATH))
    row = spark.range(1).select(*[c.alias(n) for n, c in parts.items()]).collect()[0]
    assert tuple(row) == ("customer01", "sessions", dt.date(2017, 6, 13), "end_file.txt")
    assert one(spark, is_marker(F.lit(MARKER_PATH))) is True
    assert one(spark, upload_folder(F.lit(MARKER_PATH))) == "customer01/sessions/2017-06-13"
    assert one(spark, data_glob(F.lit(MARKER_PATH))) == "customer01/sessions/2017-06-13/*.json"
    assert one(spark, staging_name(F.lit(MARKER_PATH))) == "customer01_sessions_2017_06_13"
    assert staging_name_of(MARKER_PATH) == "customer01_sessions_2017_06_13"


def test_short_path_gives_nulls(spark):
    parts = parse_upload_path(F.lit("end_file.txt"))
    row = spark.range(1).select(*[c.alias(n) for n, c in parts.items()]).collect()[0]
    assert (row.customer, row.upload_date, row.file) == (None, None, "end_file.txt")


def test_zone_path():
    assert zone_path("/lake/", "gold", "c", "e") == "/lake/gold/c/e"
    with pytest.raises(ValueError):
        zone_path("/lake", "platinum", "c", "e")


def test_fit_equals_the_plain_cast(spark):
    values = [
        "12", " 12\t", "+7", "-3", "1.5", "1e3", "", "  ", "99999999999999999999", "12\n", "\x0112", "1 2",
        "--3", "+", "\u0663", None, "0x1F", "1L", "12.", "\u00a012", "2147483648", "word",
    ]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    v = F.col("v")
    for want in ("bigint", "int", "boolean", "date"):
        both = df.select(fit(v, StringType(), want).alias("a"), v.try_cast(want).alias("b")).collect()
        assert [r.a for r in both] == [r.b for r in both]
