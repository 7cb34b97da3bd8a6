"""Activity: daily active users and weekly cohort retention."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def daily_active_users(events: DataFrame) -> DataFrame:
    """Distinct users and events per day; events without a user are left out.

    Days that could not be parsed form a null day. The distinct count groups by
    (day, user) first, so a busy day is spread over many tasks.
    """
    return (
        events.filter(~F.col("_user_id_missing"))
        .groupBy("event_date")
        .agg(
            F.countDistinct("user_id").alias("dau"),
            F.count("event_id").alias("total_events"),
        )
    )


def _monday(date: Column) -> Column:
    """First day of the week a date belongs to."""
    return F.date_sub(date, F.weekday(date))


def weekly_cohort_retention(events: DataFrame) -> DataFrame:
    """Share of each signup week's users active 0, 1, 2… weeks later.

    One scan: rows shrink to (user, active week) before anything is gathered by
    user, so a user costs one row per week however many events they made. A
    user's signup falls in their own week 0, hence the cohort size is the number
    of users active in week 0. Rows without a date belong to no week.
    """
    signed_up = F.when(F.col("event_type") == "signup", F.col("event_date"))
    user_weeks = (
        events.filter(~F.col("_user_id_missing") & F.col("event_date").isNotNull())
        .groupBy("user_id", _monday(F.col("event_date")).alias("activity_week"))
        .agg(F.min(signed_up).alias("_signup"))
    )
    signup = F.min("_signup").over(Window.partitionBy("user_id"))
    weeks = (F.datediff("activity_week", "cohort_week") / 7).cast("int")
    active = (
        user_weeks.withColumn("cohort_week", _monday(signup))
        .withColumn("weeks_since_signup", weeks)
        .filter(F.col("weeks_since_signup") >= 0)
        .groupBy("cohort_week", "weeks_since_signup")
        .agg(F.count(F.lit(1)).alias("active_users"))
    )
    in_week_0 = F.when(F.col("weeks_since_signup") == 0, F.col("active_users"))
    return active.withColumn(
        "cohort_size", F.max(in_week_0).over(Window.partitionBy("cohort_week"))
    ).withColumn("retention_rate", F.round(F.col("active_users") / F.col("cohort_size"), 4))
