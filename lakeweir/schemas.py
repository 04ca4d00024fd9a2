"""Declared record schemas of the default site lake."""

from __future__ import annotations

from pyspark.sql import types as T

CORRUPT = "_corrupt_record"
AUDIT = "ingestion_at"


def record(**types: str) -> T.StructType:
    """A flat schema from field names and type names."""
    schema = T.StructType()
    for name, type_name in types.items():
        schema = schema.add(name, type_name)
    return schema


# Field names and types of a site record, as curated tables expose them.
CURATED = record(
    id="string",
    name="string",
    brewery_type="string",
    address_1="string",
    address_2="string",
    address_3="string",
    city="string",
    state_province="string",
    postal_code="string",
    country="string",
    longitude="double",
    latitude="double",
    phone="string",
    website_url="string",
    state="string",
    street="string",
    ingestion_at="timestamp",
)
KEYS = ("id",)
PARTITIONS = ("country", "state", "city")
MART_DIMENSIONS = ("brewery_type", "country", "state", "city")
MART_COUNT = "brewery_count"
MART_AUDIT = "update_at"
WATERMARK = record(max_id="string", timestamp="string")


def raw_of(curated: T.StructType, audit: str | None = AUDIT) -> T.StructType:
    """The reading schema of raw JSON: every field as text, plus the corrupt-record slot."""
    names = [field.name for field in curated if field.name != audit]
    return T.StructType([T.StructField(name, T.StringType()) for name in [*names, CORRUPT]])


RAW = raw_of(CURATED)
