"""Subscriptions: cleaning and per-user flags."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.parsing import parse_date, parse_double
from tidemark.operators.dedup import keep_first
from tidemark.operators.previous_row import with_previous
from tidemark.operators.quality import DROP, Rule, drop_violations
from tidemark.schemas import SUBSCRIPTION_PLANS, SUBSCRIPTION_STATUSES


def _sql_list(values: list[str]) -> str:
    return ", ".join(f"'{value}'" for value in values)


# The rules' names and predicates.
SUBSCRIPTION_RULES = [
    Rule("valid_status", f"status IN ({_sql_list(SUBSCRIPTION_STATUSES)})"),
    Rule("valid_plan", f"plan_id IN ({_sql_list(SUBSCRIPTION_PLANS)})"),
    Rule("valid_price", "price > 0"),
    Rule("user_id_not_null", "user_id IS NOT NULL"),
    Rule("valid_start_date", "start_date IS NOT NULL", DROP),
    Rule("end_after_start", "end_date IS NULL OR end_date >= start_date"),
]


def cast_subscriptions(bronze: DataFrame) -> DataFrame:
    return bronze.withColumns(
        {
            "start_date": parse_date(F.col("start_date")),
            "end_date": parse_date(F.col("end_date")),
            "created_at": F.try_to_timestamp("created_at"),
            "price": parse_double(F.col("price")),
        }
    )


def deduplicate_subscriptions(subscriptions: DataFrame) -> DataFrame:
    """The latest created row per subscription; other columns break ties."""
    ties = [
        "status",
        "plan_id",
        "price",
        "start_date",
        "end_date",
        "user_id",
        "currency",
        "_ingest_timestamp",
    ]
    return keep_first(
        subscriptions,
        ["subscription_id"],
        [F.desc_nulls_last("created_at")] + [F.asc_nulls_first(name) for name in ties],
    )


def flag_history(subscriptions: DataFrame) -> DataFrame:
    """Add ``is_overlapping`` and ``is_reactivation`` from the user's previous row."""
    rows = with_previous(
        subscriptions,
        key="user_id",
        day="start_date",
        row_id="subscription_id",
        previous={"_previous_end": "end_date", "_previous_status": "status"},
    )
    overlapping = F.col("start_date") <= F.col("_previous_end")
    reactivated = (F.col("_previous_status") == "canceled") & (F.col("status") == "active")
    return rows.withColumns(
        {
            "is_overlapping": F.coalesce(overlapping, F.lit(False)),
            "is_reactivation": F.coalesce(reactivated, F.lit(False)),
        }
    )


def checked_subscriptions(bronze: DataFrame) -> DataFrame:
    """The subscriptions table before the drop rule, for counting violations."""
    return flag_history(deduplicate_subscriptions(cast_subscriptions(bronze))).select(
        "subscription_id",
        "user_id",
        "plan_id",
        "price",
        "currency",
        "start_date",
        "end_date",
        "status",
        "created_at",
        "is_overlapping",
        "is_reactivation",
        "_ingest_timestamp",
    )


def subscriptions_silver(bronze: DataFrame) -> DataFrame:
    """Latest state per subscription, flagged.

    Rows without a start date still count as a previous row before they are
    dropped.
    """
    return drop_violations(checked_subscriptions(bronze), SUBSCRIPTION_RULES)
