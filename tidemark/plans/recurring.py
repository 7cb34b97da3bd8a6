"""Recurring revenue per day."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.money import PARTS, bin_of, parts_of, total
from tidemark.sources.tables import date_spine

SPINE_START = dt.date(2020, 1, 1)
_PARTS = tuple(f"_{name}" for name in PARTS)
#: The bin of counts; no exponent.
_COUNTS = -5000


def mrr_daily(
    subscriptions: DataFrame, as_of: dt.date, start: dt.date = SPINE_START
) -> DataFrame:
    """Recurring revenue, active subscriptions and subscribed users on each day.

    A subscription counts from its start to its end, both inclusive, or to
    ``as_of`` when open. Expects one row per subscription.

    Instead of matching days with subscriptions, each subscription adds its
    price on its first day and takes it back on the day after its last; running
    sums over the days give the totals. The work is linear in subscriptions, and
    only day totals are gathered in one place. Prices are summed exactly, in bins, so that
    what was added is taken back without a trace, whatever its size; prices that are infinite
    or no number show in the days they are active, as they would in a sum of prices.

    Users may hold overlapping subscriptions. Per user and first day only the
    longest reach matters, so rows are first combined to that; each then adds
    the user from the first day not covered before.
    """
    spark = subscriptions.sparkSession
    low, high = F.lit(start), F.lit(as_of)
    reach = F.coalesce("end_date", high)
    active = (
        subscriptions.filter(
            (F.col("status") == "active")
            & (F.col("start_date") <= high)
            & (reach >= low)
            & (reach >= F.col("start_date"))
        )
        .withColumn("first", F.greatest("start_date", low))
        .withColumn("last", F.least(reach, high))
    )

    edges = F.explode(
        F.array(
            F.struct(F.col("first").alias("date"), F.lit(1).alias("sign")),
            F.struct(F.date_add("last", 1).alias("date"), F.lit(-1).alias("sign")),
        )
    )
    # Each edge is a row for its price, in the price's bin, and one for what it counts.
    price, sign = F.col("price"), F.col("edge.sign").cast("bigint")
    nothing = F.lit(0).cast("bigint")
    counted = lambda column: F.when(F.col(column).isNotNull(), sign).otherwise(nothing)
    money = F.struct(bin_of(price).alias("_bin"), *[(part * sign).alias(f"_{name}") for name, part in parts_of(price).items()])
    counts = _counts(counted("price"), counted("subscription_id"), nothing)
    by_subscription = (
        active.select("price", "subscription_id", edges.alias("edge"))
        .select("edge.date", F.explode(F.array(money, counts)).alias("x"))
        .filter(F.col("x._p0").isNotNull())
        .select("date", "x.*")
    )

    spans = (
        active.filter(F.col("user_id").isNotNull())
        .groupBy("user_id", "first")
        .agg(F.max("last").alias("last"))
    )
    earlier = (
        Window.partitionBy("user_id").orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    )
    new_days = spans.withColumn(
        "first", F.greatest("first", F.date_add(F.max("last").over(earlier), 1))
    ).filter(F.col("first") <= F.col("last"))
    by_user = new_days.select(edges.alias("edge")).select("edge.date", _counts(nothing, nothing, sign).alias("x"))
    spine = date_spine(spark, start, as_of).select(F.col("spine_date").alias("date"), _counts(nothing, nothing, nothing).alias("x"))
    days = (
        by_subscription.unionByName(by_user.select("date", "x.*"))
        .unionByName(spine.select("date", "x.*"))
        .groupBy("date", "_bin")
        .agg(*[F.sum(name).alias(name) for name in _PARTS])
    )
    # What each bin holds on each day: running sums over a row for each day it changes.
    of_bin = Window.partitionBy("_bin").orderBy("date")
    until_now = of_bin.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    held = days.select(
        "_bin",
        "date",
        F.date_sub(F.lead("date", 1, as_of + dt.timedelta(days=1)).over(of_bin), 1).alias("last"),
        *[F.sum(name).over(until_now).alias(name) for name in _PARTS],
    ).filter(F.col("date") <= F.col("last"))
    daily = held.select(F.explode(F.sequence("date", "last", F.expr("INTERVAL 1 DAY"))).alias("date"), "_bin", *_PARTS)
    is_count = F.coalesce(F.col("_bin") == _COUNTS, F.lit(False))
    of_money = daily.withColumns({f"_money{name}": F.when(~is_count, F.col(name)) for name in _PARTS})
    names = ("priced", "active_subscriptions", "subscribed_users")
    return (
        of_money.groupBy("date")
        .agg(
            total("_money_").alias("mrr"),
            *[F.max(F.when(is_count, F.col(part))).alias(name) for name, part in zip(names, _PARTS)],
        )
        .select("date", F.when(F.col("priced") > 0, F.col("mrr")).alias("mrr"), *names[1:])
    )


def _counts(*numbers: Column) -> Column:
    """What an edge adds to the priced, to all subscriptions and to the users, in a bin of their own."""
    return F.struct(F.lit(_COUNTS).alias("_bin"), *[n.alias(name) for n, name in zip(numbers, _PARTS)])
