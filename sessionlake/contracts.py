"""Schemas of the raw session files, the gold zone and the change files."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

_ATOMIC = {
    "string": StringType(),
    "long": LongType(),
    "double": DoubleType(),
    "bool": BooleanType(),
    "date": DateType(),
    "timestamp": TimestampNTZType(),
}


def record(**fields: str | DataType) -> StructType:
    """``record(city="string", hits=ArrayType(...))`` as a StructType."""
    return StructType(
        [StructField(n, _ATOMIC[t] if isinstance(t, str) else t) for n, t in fields.items()]
    )


# The session contract of the gold zone and the final table.
GOLD = record(
    visitId="long",
    visitNumber="long",
    visitStartTime="long",
    channelGrouping="string",
    date="date",
    fullVisitorId="string",
    socialEngagementType="string",
    totals=record(
        hits="long",
        bounces="long",
        newVisits="long",
        pageviews="long",
        totalTransactionRevenue="long",
        transactionRevenue="long",
        transactions="long",
        visits="long",
    ),
    trafficSource=record(
        campaign="string", isTrueDirect="bool", keyword="string", source="string"
    ),
    device=record(
        browser="string", browserVersion="string", deviceCategory="string", isMobile="bool"
    ),
    geoNetwork=record(city="string", country="string", latitude="string", longitude="string"),
    hits=ArrayType(
        record(
            type="string",
            time="long",
            hitNumber="long",
            isEntrance="bool",
            isExit="bool",
            isInteraction="bool",
            page=record(
                hostname="string",
                pagePath="string",
                pageTitle="string",
                searchCategory="string",
                searchKeyword="string",
            ),
            transaction=record(
                affiliation="string",
                currencyCode="string",
                transactionId="string",
                transactionRevenue="long",
                transactionShipping="long",
                transactionTax="long",
            ),
        )
    ),
)

# The raw session record. Numbers arrive as text.
RAW = record(
    visitNumber="string",
    visitId="string",
    visitStartTime="string",
    date="string",
    totals=record(
        visits="string",
        hits="string",
        pageviews="string",
        bounces="string",
        newVisits="string",
        totalTransactionRevenue="string",
        transactionRevenue="string",
        transactions="string",
    ),
    trafficSource=record(
        campaign="string",
        source="string",
        medium="string",
        keyword="string",
        isTrueDirect="bool",
    ),
    device=record(
        browser="string",
        browserVersion="string",
        operatingSystem="string",
        isMobile="bool",
        deviceCategory="string",
    ),
    geoNetwork=record(
        continent="string",
        subContinent="string",
        country="string",
        region="string",
        metro="string",
        city="string",
        latitude="string",
        longitude="string",
    ),
    customDimensions=ArrayType(record(index="string", value="string")),
    hits=ArrayType(
        record(
            hitNumber="string",
            time="string",
            isInteraction="bool",
            isEntrance="bool",
            isExit="bool",
            referer="string",
            page=record(
                pagePath="string",
                hostname="string",
                pageTitle="string",
                searchCategory="string",
                searchKeyword="string",
            ),
            transaction=record(
                affiliation="string",
                currencyCode="string",
                transactionId="string",
                transactionRevenue="string",
                transactionShipping="string",
                transactionTax="string",
            ),
            type="string",
            dataSource="string",
        )
    ),
    fullVisitorId="string",
    channelGrouping="string",
    socialEngagementType="string",
)

# The session key, the silver types of the root columns, the
# marker file and the clustering features.
SESSION_KEY = ["visitNumber", "visitId", "visitStartTime", "fullVisitorId"]
SILVER_TYPES = {
    "visitorId": "bigint",
    "visitNumber": "bigint",
    "visitId": "bigint",
    "visitStartTime": "bigint",
}
MARKER = "end_file.txt"
RAW_DATE_FORMAT = "yyyyMMdd"
FEATURES = [
    "body_visitNumber",
    "body_visitStartTime",
    "body_date",
    "body_channelGrouping",
    "body_totals_visits",
    "body_device_operatingSystem",
    "body_device_isMobile",
    "body_geoNetwork_continent",
    "body_geoNetwork_subContinent",
    "body_geoNetwork_country",
    "body_hits_dataSource",
    "body_hits_page_pagePath",
    "body_hits_page_hostname",
    "body_hits_page_pageTitle",
]

# Partition columns of the zones.
DAY = ["year", "month", "day"]
MONTH = ["year", "month"]

# A session with more hits than a row should hold goes on in further rows;
# PART numbers them from 0. Nearly every session has part 0 only.
PART = "part"
PART_FIELD = StructField(PART, IntegerType())

# The upload that rows came with: a partition of the zones and of the final
# table, so that running an upload again replaces its own rows and no others.
UPLOAD = "upload"
UPLOAD_FIELD = StructField(UPLOAD, StringType())

# The line a session was read from, kept as it is beside the parsed columns.
LINE = "_line"
LINE_FIELD = StructField(LINE, StringType())

# Envelope of a change record; the payload columns follow.
CHANGE_ENVELOPE = record(
    _metadata_table="string", _op="string", _ts="timestamp", _seq="long"
)


def read_schema(have: StructType, contract: StructType) -> StructType:
    """The contract's fields and order with the types the files have.

    Given to a reader it keeps the scan to the leaves the contract needs, also
    inside arrays, and gives rows the contract's shape, which one cast then
    brings to its types. Fields the files lack are read as NULL text.
    """

    def shaped(had: DataType | None, want: DataType) -> DataType:
        if isinstance(want, StructType):
            return read_schema(had if isinstance(had, StructType) else StructType([]), want)
        if isinstance(want, ArrayType):
            item = had.elementType if isinstance(had, ArrayType) else None
            return ArrayType(shaped(item, want.elementType))
        return StringType() if had is None else had

    types = {f.name: f.dataType for f in have.fields}
    return StructType(
        [StructField(f.name, shaped(types.get(f.name), f.dataType)) for f in contract.fields]
    )


def meets(schema: StructType, contract: StructType) -> bool:
    """True if the columns are the contract's in name, order and type, nullability aside."""
    return schema.simpleString() == contract.simpleString()
