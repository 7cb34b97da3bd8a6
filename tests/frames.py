"""Small hand-made and random inputs."""

from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import DataFrame, SparkSession

from tidemark.schemas import EVENTS_BRONZE

NOON = dt.datetime(2024, 2, 1, 12)

EVENTS_SILVER = (
    "event_id string, user_id string, _user_id_missing boolean, event_type string,"
    " timestamp string, _timestamp_utc timestamp, event_date date, schema_version string,"
    " amount double, currency string, tax double, refers_to_event_id string,"
    " acquisition_channel string, _ingest_timestamp timestamp"
)
MARKETING_BRONZE = "date string, channel string, spend string, _ingest_timestamp timestamp"
MARKETING_SILVER = (
    "date date, channel string, spend double, has_gap_before boolean, _ingest_timestamp timestamp"
)
SUBSCRIPTIONS_BRONZE = (
    "subscription_id string, user_id string, plan_id string, price string, currency string,"
    " start_date string, end_date string, status string, created_at string,"
    " _ingest_timestamp timestamp"
)
SUBSCRIPTIONS_SILVER = (
    "subscription_id string, user_id string, plan_id string, price double, currency string,"
    " start_date date, end_date date, status string, created_at timestamp,"
    " is_overlapping boolean, is_reactivation boolean, _ingest_timestamp timestamp"
)


def frame(spark: SparkSession, schema, rows: list[dict]) -> DataFrame:
    """A DataFrame of dicts; absent keys are null."""
    empty = spark.createDataFrame([], schema)
    return spark.createDataFrame(
        [tuple(row.get(name) for name in empty.columns) for row in rows], empty.schema
    )


def bronze_event(**values) -> dict:
    return {
        "event_id": "e1",
        "user_id": "u1",
        "event_type": "purchase",
        "timestamp": "2024-01-15T10:30:00Z",
        "schema_version": "v2",
        "amount": 10.0,
        "_ingest_timestamp": NOON,
    } | values


def events_bronze(spark: SparkSession, *rows: dict) -> DataFrame:
    return frame(spark, EVENTS_BRONZE, [bronze_event(**row) for row in rows])


def silver_event(number: int, **values) -> dict:
    row = {
        "event_id": f"e{number}",
        "user_id": "u1",
        "event_type": "purchase",
        "_timestamp_utc": dt.datetime(2024, 1, 15, 10),
        "amount": 10.0,
        "_ingest_timestamp": NOON,
    } | values
    row["_user_id_missing"] = row["user_id"] is None
    ts = row["_timestamp_utc"]
    row["event_date"] = ts.date() if ts else None
    return row


def events_silver(spark: SparkSession, *rows: dict) -> DataFrame:
    made = [silver_event(number, **row) for number, row in enumerate(rows)]
    return frame(spark, EVENTS_SILVER, made)


def subscription(number: int, **values) -> dict:
    return {
        "subscription_id": f"s{number}",
        "user_id": "u1",
        "plan_id": "pro",
        "price": 10.0,
        "currency": "USD",
        "start_date": dt.date(2024, 1, 10),
        "end_date": dt.date(2024, 1, 20),
        "status": "active",
        "is_overlapping": False,
        "is_reactivation": False,
    } | values


def subscriptions_silver(spark: SparkSession, *rows: dict) -> DataFrame:
    made = [subscription(number, **row) for number, row in enumerate(rows)]
    return frame(spark, SUBSCRIPTIONS_SILVER, made)


def by(df: DataFrame, key: str) -> dict:
    """Rows as dicts under the value of one column."""
    rows = [row.asDict() for row in df.collect()]
    found = {row[key]: row for row in rows}
    assert len(found) == len(rows)
    return found


def random_events(seed: int, count: int = 150) -> list[dict]:
    rng = random.Random(seed)
    start = dt.datetime(2024, 1, 1)
    rows = []
    for _ in range(count):
        kind = rng.choice(["signup", "login", "purchase", "purchase", "refund"])
        at = start + dt.timedelta(minutes=rng.randrange(50 * 24 * 60))
        rows.append(
            {
                "event_type": kind,
                "user_id": rng.choice([None] + [f"u{i}" for i in range(12)]),
                "_timestamp_utc": rng.choice([at] * 9 + [None]),
                "amount": rng.choice([None, -5.0, 0.0] + [round(rng.uniform(1, 90), 2)] * 5),
                "acquisition_channel": rng.choice([None, "ads", "mail"])
                if kind == "signup"
                else None,
            }
        )
    return rows


def random_spend(seed: int, count: int = 80) -> list[dict]:
    rng = random.Random(seed)
    rows = {
        (
            dt.date(2024, 1, 1) + dt.timedelta(days=rng.randrange(50)),
            rng.choice(["ads", "mail", "tv"]),
            rng.choice([0.0, 12.5, 99.99, 7.35]),
        )
        for _ in range(count)
    }
    return [{"date": d, "channel": c, "spend": s} for d, c, s in sorted(rows)]


def random_subscriptions(seed: int, count: int = 120) -> list[dict]:
    rng = random.Random(seed)
    base = dt.date(2024, 1, 1)
    rows = []
    for number in range(count):
        start = base + dt.timedelta(days=rng.randrange(-40, 100))
        end = start + dt.timedelta(days=rng.randrange(-4, 60))
        rows.append(
            {
                "subscription_id": rng.choice([f"s{number}"] * 30 + [None]),
                "user_id": rng.choice([None] + [f"u{i}" for i in range(8)]),
                "price": rng.choice([None, 0.1, 0.2, 19.99, 49.0]),
                "start_date": rng.choice([start] * 9 + [None]),
                "end_date": rng.choice([end] * 3 + [None]),
                "status": rng.choice(["active", "active", "canceled"]),
            }
        )
    # An unknown id is unique too after de-duplication.
    unknown = [row for row in rows if row["subscription_id"] is None]
    return [row for row in rows if row["subscription_id"]] + unknown[:1]
