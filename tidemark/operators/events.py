"""Product events: quarantine and cleaning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.parsing import parse_timestamp
from tidemark.functions.rules import Rules, first_reason, is_clean
from tidemark.operators.dedup import keep_first
from tidemark.operators.quality import Rule
from tidemark.schemas import EVENT_TYPES, EVENTS_BRONZE, ensure_columns

_TYPE_LIST = ", ".join(f"'{name}'" for name in EVENT_TYPES)

# The rules' names and predicates.
EVENT_RULES = [
    Rule("event_id_not_null", "event_id IS NOT NULL"),
    Rule("valid_event_type", f"event_type IN ({_TYPE_LIST})"),
    Rule("normalized_timestamp_not_null", "_timestamp_utc IS NOT NULL"),
    Rule("non_negative_amount", "amount IS NULL OR amount >= 0"),
]

# The table's columns, in order.
EVENTS_SILVER_COLUMNS = [
    "event_id",
    "user_id",
    "_user_id_missing",
    "event_type",
    "timestamp",
    "_timestamp_utc",
    "event_date",
    "schema_version",
    "amount",
    "currency",
    "tax",
    "refers_to_event_id",
    "acquisition_channel",
    "_ingest_timestamp",
]


def event_faults() -> Rules:
    """What makes a bronze event unusable, in order of precedence."""
    # The reasons' names.
    return [
        ("corrupted_json", F.col("_rescued_data").isNotNull()),
        ("null_event_id", F.col("event_id").isNull()),
        ("null_event_type", F.col("event_type").isNull()),
        ("null_timestamp", F.col("timestamp").isNull()),
        ("invalid_event_type", ~F.col("event_type").isin(EVENT_TYPES)),
    ]


def events_quarantine(bronze: DataFrame) -> DataFrame:
    """Unusable events with ``_quarantine_reason``; all bronze columns kept."""
    bronze = ensure_columns(bronze, EVENTS_BRONZE)
    return bronze.withColumn("_quarantine_reason", first_reason(event_faults())).filter(
        F.col("_quarantine_reason").isNotNull()
    )


def valid_events(bronze: DataFrame) -> DataFrame:
    """The complement of the quarantine, with every declared column present."""
    return ensure_columns(bronze, EVENTS_BRONZE).filter(is_clean(event_faults()))


def event_order() -> list[Column]:
    """Which row of an event comes first: largest amount, then latest ingest.

    The other payload columns only break ties, so the outcome does not depend
    on how the data is laid out.
    """
    ties = [
        "user_id",
        "event_type",
        "timestamp",
        "schema_version",
        "currency",
        "tax",
        "refers_to_event_id",
        "acquisition_channel",
    ]
    return [F.desc_nulls_last("amount"), F.desc_nulls_last("_ingest_timestamp")] + [
        F.asc_nulls_first(name) for name in ties
    ]


def deduplicate_events(events: DataFrame) -> DataFrame:
    """One row per event, the first by ``event_order``."""
    return keep_first(events, ["event_id"], event_order())


def normalize_timestamps(events: DataFrame) -> DataFrame:
    """Add ``_timestamp_utc`` and ``event_date``; null where no format fits."""
    return events.withColumn("_timestamp_utc", parse_timestamp(F.col("timestamp"))).withColumn(
        "event_date", F.to_date("_timestamp_utc")
    )


def flag_missing_users(events: DataFrame) -> DataFrame:
    """Events without a user still carry revenue, so they are marked, not dropped."""
    return events.withColumn("_user_id_missing", F.col("user_id").isNull())


def events_silver(bronze: DataFrame) -> DataFrame:
    """Valid events, one per id, typed and flagged.

    Timestamps are parsed after the de-duplication: fewer rows to parse and one
    column less to shuffle.
    """
    events = deduplicate_events(valid_events(bronze))
    return flag_missing_users(normalize_timestamps(events)).select(*EVENTS_SILVER_COLUMNS)
