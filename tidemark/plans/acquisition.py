"""Acquisition cost per channel and its relation to lifetime value.

Both tables put rows of several kinds under one another, each kind with its own
columns filled, and group once: no joins, and a channel missing in one kind needs no
care of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.money import exact_sums

#: From this ratio on a channel is healthy (fixed value).
HEALTHY = 3.0


def cac_by_channel(events: DataFrame, spend: DataFrame) -> DataFrame:
    """Spend, new customers and cost per customer, by day and channel.

    Days with only spend or only signups stay; cost is null unless there are both.
    """
    named_signup = (F.col("event_type") == "signup") & F.col("acquisition_channel").isNotNull()
    signups = events.filter(named_signup & ~F.col("_user_id_missing")).select(
        F.col("event_date").alias("date"), F.col("acquisition_channel").alias("channel"), "user_id"
    )
    rows = spend.select("date", "channel", "spend").unionByName(signups, allowMissingColumns=True)
    totals = exact_sums(
        rows,
        ["date", "channel"],
        F.col("spend"),
        {"total_spend": None},
        {"new_customers": (F.countDistinct("user_id"), F.sum)},  # signups spend nothing: one bin has them all
    ).withColumn("total_spend", F.coalesce("total_spend", F.lit(0.0)))
    per_customer = F.round(F.try_divide("total_spend", "new_customers"), 2)
    return totals.withColumn("cac", F.when(F.col("total_spend") > 0, per_customer))


def ltv_cac_ratio(ltv: DataFrame, spend: DataFrame, cac: DataFrame) -> DataFrame:
    """Average lifetime value against average acquisition cost, per channel of a user.

    Takes the tables ``ltv_per_user``, ``marketing_spend_silver`` and
    ``cac_by_channel``. A channel without acquired customers shows no spend; one
    without users isn't listed. 3.0 and more is healthy; null means it cannot be told.
    """
    users = ltv.select(F.col("acquisition_channel").alias("channel"), "user_id", "ltv", F.lit(True).alias("user"))
    acquired = cac.filter(F.col("new_customers") > 0).select("channel", F.col("new_customers").alias("acquired"))
    rows = users.unionByName(acquired, allowMissingColumns=True).unionByName(
        spend.select("channel", "spend"), allowMissingColumns=True
    )
    is_user = F.coalesce(F.col("user"), F.lit(False))
    totals = exact_sums(
        rows.filter(F.col("channel").isNotNull()),
        ["channel"],
        F.coalesce("ltv", "spend"),
        {"total_ltv": is_user, "spent": ~is_user},
        {
            "users": (F.count("user"), F.sum),
            "total_customers": (F.count("user_id"), F.sum),
            "values": (F.count("ltv"), F.sum),
            "acquired": (F.sum("acquired"), F.sum),
        },
    ).filter(F.col("users") > 0)
    average_value = F.try_divide("total_ltv", "values")
    shown_spend = F.when(F.col("acquired").isNotNull(), F.col("spent"))
    average_cost = F.round(F.try_divide("total_spend", "acquired"), 2)
    ratio = F.when(F.col("avg_cac") > 0, F.round(F.try_divide("avg_ltv", "avg_cac"), 2))
    return (
        totals.withColumns({"avg_ltv": average_value, "total_spend": shown_spend})
        .withColumn("avg_cac", average_cost)
        .withColumn("ltv_cac_ratio", ratio)
        .select(
            F.col("channel").alias("acquisition_channel"),
            "total_customers",
            "avg_ltv",
            "total_ltv",
            "avg_cac",
            "total_spend",
            "ltv_cac_ratio",
            (F.col("ltv_cac_ratio") >= HEALTHY).alias("is_healthy"),
        )
    )
