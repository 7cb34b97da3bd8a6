"""Revenue per day and lifetime value per user, from cleaned events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.money import exact_sums


def is_sale() -> Column:
    """A purchase that counts as revenue; negative amounts do not."""
    return (F.col("event_type") == "purchase") & (F.col("amount") > 0)


def is_refund() -> Column:
    return F.col("event_type") == "refund"


def daily_revenue_gross(events: DataFrame) -> DataFrame:
    """Sales per day; sales without a user count, but not as a paying user."""
    return exact_sums(
        events.filter(is_sale()).select("event_date", "event_id", "user_id", "amount"),
        ["event_date"],
        F.col("amount"),
        {"gross_revenue": None},
        {
            "purchase_count": (F.count("event_id"), F.sum),
            "paying_users": (F.countDistinct("user_id"), F.sum),
        },
        apart=True,
    )


def daily_revenue_net(events: DataFrame) -> DataFrame:
    """Sales minus refunds per day, refunds counted on the day they were made.

    One pass over the events. Only days with sales appear, and the null day of
    unparsed timestamps takes no refunds, as a null matches no other null.
    """
    refunded = F.when(F.col("event_date").isNotNull(), F.col("_refunds"))
    return (
        exact_sums(
            events.filter(is_sale() | is_refund()).select("event_date", "event_type", "amount"),
            ["event_date"],
            F.when(is_refund(), F.abs("amount")).otherwise(F.col("amount")),
            {"gross_revenue": is_sale(), "_refunds": is_refund()},
            {},
        )
        .filter(F.col("gross_revenue").isNotNull())
        .select(
            "event_date",
            "gross_revenue",
            F.coalesce(refunded, F.lit(0.0)).alias("total_refunds"),
        )
        .withColumn("net_revenue", F.col("gross_revenue") - F.col("total_refunds"))
    )


def ltv_per_user(events: DataFrame) -> DataFrame:
    """First and last sight, channel, purchases, refunds and value of each user.

    The channel is that of the earliest signup naming one (unparsed times last, then
    event id). ``purchase_count`` is null, not zero, for users who never bought.

    A text can't live in a hash aggregate, so the channel is found apart, over the few
    columns of signups, and every event passes through a hash aggregate only. Both sides are
    then hashed by user already, and one row each.
    """
    known = events.filter(~F.col("_user_id_missing"))
    earliest = F.struct(F.col("_timestamp_utc").isNull(), "_timestamp_utc", "event_id")
    channels = (
        known.filter((F.col("event_type") == "signup") & F.col("acquisition_channel").isNotNull())
        .groupBy("user_id")
        .agg(F.min_by("acquisition_channel", earliest).alias("acquisition_channel"))
    )
    totals = exact_sums(
        known.select("user_id", "event_type", "amount", "_timestamp_utc"),
        ["user_id"],
        F.when(is_refund(), F.abs("amount")).when(is_sale(), F.col("amount")),
        {"total_purchases": is_sale(), "total_refunds": is_refund()},
        {
            "first_seen": (F.min("_timestamp_utc"), F.min),
            "last_seen": (F.max("_timestamp_utc"), F.max),
            "purchase_count": (F.count_if(is_sale()), F.sum),
        },
    )
    return (
        totals.withColumns(
            {
                "purchase_count": F.nullif("purchase_count", F.lit(0)),
                "total_purchases": F.coalesce("total_purchases", F.lit(0.0)),
                "total_refunds": F.coalesce("total_refunds", F.lit(0.0)),
            }
        )
        .join(channels, "user_id", "left")
        .select(
            "user_id",
            "acquisition_channel",
            "first_seen",
            "last_seen",
            F.datediff("last_seen", "first_seen").alias("customer_lifetime_days"),
            "purchase_count",
            "total_purchases",
            "total_refunds",
            F.round(F.col("total_purchases") - F.col("total_refunds"), 2).alias("ltv"),
        )
    )
