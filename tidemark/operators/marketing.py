"""Marketing spend: quarantine and cleaning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.parsing import parse_date, parse_double
from tidemark.functions.rules import Rules, first_reason, is_clean
from tidemark.operators.previous_row import with_previous
from tidemark.operators.quality import DROP, Rule, drop_violations

# The rules' names and predicates.
MARKETING_RULES = [
    Rule("valid_date", "date IS NOT NULL", DROP),
    Rule("valid_channel", "channel IS NOT NULL AND channel != ''", DROP),
    Rule("non_negative_spend", "spend >= 0", DROP),
    Rule("spend_not_null", "spend IS NOT NULL"),
]


def spend_faults() -> Rules:
    """What makes a spend row with a parsed date unusable, in order of precedence."""
    # The reasons' names.
    channel, spend = F.col("channel"), parse_double(F.col("spend"))
    return [
        ("missing_date", F.col("date").isNull()),
        ("missing_channel", channel.isNull() | (channel == "")),
        ("null_spend", spend.isNull()),
        ("negative_spend", spend < 0),
    ]


def marketing_spend_quarantine(bronze: DataFrame) -> DataFrame:
    """Unusable spend rows with ``_quarantine_reason``; the date is parsed."""
    return (
        bronze.withColumn("date", parse_date(F.col("date")))
        .withColumn("_quarantine_reason", first_reason(spend_faults()))
        .filter(F.col("_quarantine_reason").isNotNull())
    )


def valid_spend(bronze: DataFrame) -> DataFrame:
    """The complement of the quarantine, with typed date and spend."""
    return (
        bronze.withColumn("date", parse_date(F.col("date")))
        .filter(is_clean(spend_faults()))
        .withColumn("spend", parse_double(F.col("spend")))
    )


def deduplicate_spend(spend: DataFrame) -> DataFrame:
    """One row per (date, channel, spend), with the earliest ingest.

    A plain aggregate: copies are combined before the shuffle.
    """
    return spend.groupBy("date", "channel", "spend").agg(
        F.min("_ingest_timestamp").alias("_ingest_timestamp")
    )


def flag_gaps(spend: DataFrame) -> DataFrame:
    """Add ``has_gap_before``: more than a day since the channel's previous row.

    Rows of a day are ordered by spend, so only the one with the least can follow a
    gap. The feed is computed once, and no channel or day is gathered in one task.
    """
    rows = with_previous(spend, "channel", "date", "spend", {"_previous_date": "date"})
    gap = F.datediff("date", "_previous_date") > 1
    return rows.withColumn("has_gap_before", F.coalesce(gap, F.lit(False))).drop("_previous_date")


def checked_spend(bronze: DataFrame) -> DataFrame:
    """The spend table before the drop rules, for counting violations."""
    return flag_gaps(deduplicate_spend(valid_spend(bronze))).select(
        "date", "channel", "spend", "has_gap_before", "_ingest_timestamp"
    )


def marketing_spend_silver(bronze: DataFrame) -> DataFrame:
    """Valid spend, exact copies removed, days after a gap flagged."""
    return drop_violations(checked_spend(bronze), MARKETING_RULES)
