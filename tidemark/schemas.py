"""Declared schemas of the raw feeds and their enumerations.

Nothing is inferred: a streaming file source needs a schema, and a feed whose
types depend on the day's files cannot be compared with yesterday's.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# What the feeds may contain.
EVENT_TYPES = [
    "signup",
    "login",
    "page_view",
    "purchase",
    "refund",
    "trial_start",
    "trial_convert",
    "cancel",
]
SUBSCRIPTION_STATUSES = ["active", "canceled"]
SUBSCRIPTION_PLANS = ["basic", "pro", "team"]

# What an events line holds. Schema version 1 lacks currency and tax.
EVENT_FIELDS = StructType(
    [
        StructField("event_id", StringType()),
        StructField("user_id", StringType()),
        StructField("event_type", StringType()),
        StructField("timestamp", StringType()),
        StructField("schema_version", StringType()),
        StructField("amount", DoubleType()),
        StructField("currency", StringType()),
        StructField("tax", DoubleType()),
        StructField("refers_to_event_id", StringType()),
        StructField("acquisition_channel", StringType()),
    ]
)

EVENTS_BRONZE = StructType(
    EVENT_FIELDS.fields
    + [
        StructField("_rescued_data", StringType()),
        StructField("_ingest_timestamp", TimestampType()),
    ]
)

# Keys and values of a record that no column took.
EXTRA_FIELDS = StructField(
    "_extra_fields",
    ArrayType(StructType([StructField("key", StringType()), StructField("value", StringType())])),
)

# Text as in the file; typed in silver.
MARKETING_FIELDS = StructType(
    [
        StructField("date", StringType()),
        StructField("channel", StringType()),
        StructField("spend", StringType()),
    ]
)

# Price arrives quoted or bare; a string field takes both.
SUBSCRIPTION_FIELDS = StructType(
    [
        StructField("subscription_id", StringType()),
        StructField("user_id", StringType()),
        StructField("plan_id", StringType()),
        StructField("price", StringType()),
        StructField("currency", StringType()),
        StructField("start_date", StringType()),
        StructField("end_date", StringType()),
        StructField("status", StringType()),
        StructField("created_at", StringType()),
    ]
)

_RESCUED = StructField("_rescued_data", StringType())
_STAMP = StructField("_ingest_timestamp", TimestampType())

# The bronze tables as they are stored: they exist, typed and empty, before their first file,
# and older files are read under these columns.
BRONZE_TABLES = {
    "events_bronze": StructType([*EVENT_FIELDS.fields, _RESCUED, EXTRA_FIELDS, _STAMP]),
    "marketing_spend_bronze": StructType([*MARKETING_FIELDS.fields, _RESCUED, EXTRA_FIELDS, _STAMP]),
    "subscriptions_bronze": StructType([*SUBSCRIPTION_FIELDS.fields, _RESCUED, EXTRA_FIELDS, _STAMP]),
}


def ensure_columns(df: DataFrame, schema: StructType) -> DataFrame:
    """Add the columns of ``schema`` that ``df`` lacks, as typed nulls."""
    missing = [field for field in schema if field.name not in df.columns]
    return df.select(
        "*", *[F.lit(None).cast(field.dataType).alias(field.name) for field in missing]
    )
