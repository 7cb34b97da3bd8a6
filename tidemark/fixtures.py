"""The three feeds and a user directory, derived from the given tables.

Deterministic stand-ins for raw files: one scan per source table, faults placed
by the remainders of the row ids (see FIXTURES.md).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

INGESTED = dt.datetime(2024, 2, 1, tzinfo=dt.timezone.utc)
# The days covered by the order dates.
MRR_START = dt.date(1995, 1, 1)
MRR_AS_OF = dt.date(2001, 8, 1)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _every(key: Column, n: int) -> Column:
    return key % n == 0


def _copies(*copies: tuple[int, Column | None]) -> Column:
    """Explode into the original (copy 0) and the copies whose condition holds."""
    made = [F.lit(0)] + [F.when(condition, F.lit(number)) for number, condition in copies]
    return F.explode(F.array_compact(F.array(*made)))


def _ingested(copy: Column) -> Column:
    return F.lit(INGESTED).cast("timestamp") + F.make_dt_interval(copy)


def _thousandth(price: Column) -> Column:
    """A thousandth, rounded to cents in decimals, where ties are exact."""
    return F.round(price.cast("decimal(18,4)") * F.lit("0.001").cast("decimal(4,3)"), 2).cast(
        "double"
    )


def _channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "customer").select(
        F.col("c_custkey"), F.lower("c_mktsegment").alias("channel")
    )


def events_bronze(spark: SparkSession, sf_dir: str, keep_key: bool = False) -> DataFrame:
    key, value = F.col("event_id"), F.col("value")
    raw = _table(spark, sf_dir, "events")
    signup = F.col("event_type") == "signup"
    rows = raw.join(
        _channels(spark, sf_dir), (F.col("c_custkey") == F.col("user_id")) & signup, "left"
    ).withColumn("copy", _copies((1, _every(key, 20)), (2, _every(key, 21))))

    event_type = F.col("event_type")
    ts = F.col("ts").cast("timestamp")
    amount = (
        F.when(_every(key, 67), F.lit(None)).when(_every(key, 61), -value).otherwise(value)
    )
    version_2 = _every(key, 2)
    return rows.select(
        F.when(~_every(key, 71), key.cast("string")).alias("event_id"),
        F.when(~_every(key, 29), F.col("user_id").cast("string")).alias("user_id"),
        F.when(_every(key, 43), F.lit("bogus"))
        .when(_every(key, 47), F.lit(None))
        .when(event_type == "click", F.lit("page_view"))
        .when(event_type == "view", F.lit("login"))
        .when(event_type == "error", F.lit("refund"))
        .otherwise(event_type)
        .alias("event_type"),
        F.when(_every(key, 53), F.lit("not-a-time"))
        .when(_every(key, 59), F.lit(None))
        .when(key % 3 == 0, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(
            key % 3 == 1,
            F.date_format(ts + F.expr("INTERVAL 330 MINUTES"), "yyyy-MM-dd'T'HH:mm:ss'+05:30'"),
        )
        .otherwise(F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
        .alias("timestamp"),
        F.when(~_every(key, 83), F.when(version_2, F.lit("v2")).otherwise(F.lit("v1"))).alias(
            "schema_version"
        ),
        F.when(F.col("copy") == 2, amount + 10).otherwise(amount).alias("amount"),
        F.when(version_2, F.lit("USD")).alias("currency"),
        F.when(
            version_2,
            F.round(value.cast("decimal(18,4)") * F.lit("0.1").cast("decimal(2,1)"), 2).cast(
                "double"
            ),
        ).alias("tax"),
        F.lit(None).cast("string").alias("refers_to_event_id"),
        F.col("channel").alias("acquisition_channel"),
        F.when(_every(key, 73), F.concat(F.lit('{"event_id": "'), key.cast("string"))).alias(
            "_rescued_data"
        ),
        _ingested(F.col("copy")).alias("_ingest_timestamp"),
        *([key.alias("_key")] if keep_key else []),
    )


def event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as NDJSON lines in ``value``; rescued rows are lines cut short.

    Some lines have keys the schema does not know (a text, a nested object), some an
    earlier schema version under the same key.
    """
    events = events_bronze(spark, sf_dir, keep_key=True).drop("_ingest_timestamp")
    key = F.col("_key")
    line = F.to_json(F.struct(*[c for c in events.columns if c not in ("_rescued_data", "_key")]))
    number = (key % 7).cast("string")
    more = F.concat(
        F.when(_every(key, 37) & F.col("schema_version").isNotNull(), F.lit('{"schema_version":"v0",')).otherwise(F.lit("{")),
        F.substr(line, F.lit(2), F.length(line) - 2),
        F.when(_every(key, 31), F.concat(F.lit(',"campaign":"c'), number, F.lit('"'))).otherwise(F.lit("")),
        F.when(_every(key, 41), F.concat(F.lit(',"device":{"os":"x","v":'), number, F.lit("}"))).otherwise(F.lit("")),
        F.lit("}"),
    )
    return events.select(F.coalesce("_rescued_data", more).alias("value"))


def marketing_spend_bronze(spark: SparkSession, sf_dir: str, keep_key: bool = False) -> DataFrame:
    key = F.col("o_orderkey")
    rows = (
        _table(spark, sf_dir, "orders")
        .join(_channels(spark, sf_dir), F.col("c_custkey") == F.col("o_custkey"), "left")
        .withColumn("copy", _copies((1, _every(key, 50))))
    )
    # Spend of one channel on three days stands a day earlier or later, which leaves gaps.
    offset = key % 30
    moved = F.when(offset.isin(4, 11), offset - 1).when(offset == 5, offset + 1)
    shown = F.when(F.col("channel") == "building", F.coalesce(moved, offset)).otherwise(offset)
    day = F.date_add(F.lit(dt.date(2024, 1, 1)), shown.cast("int"))
    spend = _thousandth(F.col("o_totalprice"))
    return rows.select(
        F.when(_every(key, 103), F.lit(None))
        .when(_every(key, 109), F.lit("soon"))
        .otherwise(day.cast("string"))
        .alias("date"),
        F.when(_every(key, 101), F.lit("")).otherwise(F.col("channel")).alias("channel"),
        F.when(_every(key, 107), F.lit(None))
        .when(_every(key, 97), -spend)
        .otherwise(spend)
        .alias("spend"),
        _ingested(F.col("copy")).alias("_ingest_timestamp"),
        *([key.alias("_key")] if keep_key else []),
    )


def write_marketing_files(spark: SparkSession, sf_dir: str, folder: str) -> None:
    """The spend as CSV files of three kinds: plain; columns moved; a column added, one missing."""
    feed = marketing_spend_bronze(spark, sf_dir, keep_key=True)
    kind = F.col("_key") % 3
    note = F.concat(F.lit("n, "), (F.col("_key") % 7).cast("string")).alias("note")
    kinds = [
        feed.filter((kind == 0) | ((kind == 2) & F.col("spend").isNotNull())).select("date", "channel", "spend"),
        feed.filter(kind == 1).select("spend", note, "date", "channel"),
        feed.filter((kind == 2) & F.col("spend").isNull()).select("channel", "date"),
    ]
    for rows in kinds:
        rows.write.mode("append").option("header", True).csv(folder)


def subscriptions_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    rows = _table(spark, sf_dir, "orders").withColumn("copy", _copies((1, _every(key, 25))))
    start = F.col("o_orderdate").cast("date")
    canceled = (F.col("o_orderstatus") == "F") != (F.col("copy") == 1)
    created = F.col("o_orderdate").cast("timestamp") + F.make_dt_interval(F.col("copy"))
    days = F.when(_every(key, 139), F.lit(-3)).otherwise((key % 90).cast("int"))
    return rows.select(
        key.cast("string").alias("subscription_id"),
        F.when(~_every(key, 137), F.col("o_custkey").cast("string")).alias("user_id"),
        F.when(_every(key, 127), F.lit("gold"))
        .when(key % 3 == 0, F.lit("basic"))
        .when(key % 3 == 1, F.lit("pro"))
        .otherwise(F.lit("team"))
        .alias("plan_id"),
        F.when(~_every(key, 131), _thousandth(F.col("o_totalprice"))).alias("price"),
        F.lit("USD").alias("currency"),
        F.when(~_every(key, 113), start.cast("string")).alias("start_date"),
        F.when(~_every(key, 10), F.date_add(start, days).cast("string")).alias("end_date"),
        F.when(canceled, F.lit("canceled")).otherwise(F.lit("active")).alias("status"),
        F.date_format(created, "yyyy-MM-dd HH:mm:ss").alias("created_at"),
        _ingested(F.lit(0)).alias("_ingest_timestamp"),
    )


def write_subscription_files(spark: SparkSession, sf_dir: str, folder: str) -> None:
    """The subscriptions as multi-line JSON; some have a nested key, beside some stands a damaged copy."""
    feed = subscriptions_bronze(spark, sf_dir).drop("_ingest_timestamp")
    key = F.col("subscription_id").cast("long")
    referrer = F.when(_every(key, 151), F.struct((key % 5).alias("k")))
    record = F.to_json(F.struct(*feed.columns, referrer.alias("referrer")), {"pretty": "true"})
    cut = F.concat(F.lit('{"subscription_id": "'), "subscription_id", F.lit('", "pri'))
    lines = F.array_compact(F.array(record, F.when(_every(key, 149), cut)))
    feed.select(F.explode(lines).alias("line")).select(F.concat("line", F.lit(",")).alias("value")).write.text(folder)


def user_directory(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    mailbox = F.lower(F.replace("c_name", F.lit("#"), F.lit(".")))
    return _table(spark, sf_dir, "customer").select(
        key.alias("user_id"),
        F.when(_every(key, 11), F.lit(None))
        .when(_every(key, 7), mailbox)
        .otherwise(F.concat(mailbox, F.lit("@example.com")))
        .alias("email"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("user_type"),
    )
