import datetime as dt
import random

import pytest
from frames import NOON, SUBSCRIPTIONS_BRONZE, by, frame
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators import subscriptions
from tidemark.operators.previous_row import with_previous


def bronze_of(spark, *rows):
    default = {
        "subscription_id": "s1",
        "user_id": "u1",
        "plan_id": "pro",
        "price": "19.99",
        "currency": "USD",
        "start_date": "2024-01-01",
        "end_date": "2024-01-31",
        "status": "active",
        "created_at": "2024-01-01 08:00:00",
        "_ingest_timestamp": NOON,
    }
    return frame(spark, SUBSCRIPTIONS_BRONZE, [default | row for row in rows])


def silver_of(spark, *rows):
    return by(subscriptions.subscriptions_silver(bronze_of(spark, *rows)), "subscription_id")


def test_casts(spark):
    row = silver_of(spark, {}, {"subscription_id": "bad", "price": "x", "end_date": "soon"})
    assert row["s1"]["price"] == 19.99
    assert row["s1"]["start_date"] == dt.date(2024, 1, 1)
    assert row["s1"]["created_at"] == dt.datetime(2024, 1, 1, 8)
    assert row["bad"]["price"] is None and row["bad"]["end_date"] is None


def test_latest_created_wins(spark):
    rows = [
        {"status": "active", "created_at": "2024-01-01"},
        {"status": "canceled", "created_at": "2024-02-01"},
        {"status": "active", "created_at": None},
    ]
    for order in (rows, rows[::-1]):
        assert silver_of(spark, *order)["s1"]["status"] == "canceled"


def test_rows_without_id_collapse_to_one(spark):
    rows = [{"subscription_id": None, "user_id": f"u{i}"} for i in range(3)]
    assert set(silver_of(spark, {}, *rows)) == {"s1", None}


def history(*rows):
    return [{"subscription_id": f"s{number}"} | row for number, row in enumerate(rows)]


@pytest.mark.parametrize(
    "previous_end, start, overlapping",
    [
        ("2024-01-31", "2024-01-15", True),
        ("2024-01-31", "2024-01-31", True),
        ("2024-01-31", "2024-02-01", False),
        (None, "2024-01-15", False),
    ],
)
def test_overlap_looks_at_the_previous_end(spark, previous_end, start, overlapping):
    rows = history({"end_date": previous_end}, {"start_date": start, "end_date": "2024-12-31"})
    silver = silver_of(spark, *rows)
    assert not silver["s0"]["is_overlapping"]
    assert silver["s1"]["is_overlapping"] is overlapping


def test_overlap_looks_one_row_back_only(spark):
    rows = history(
        {"start_date": "2024-01-01", "end_date": "2024-12-31"},
        {"start_date": "2024-02-01", "end_date": "2024-02-02"},
        {"start_date": "2024-03-01", "end_date": "2024-03-02"},
    )
    flags = [silver_of(spark, *rows)[f"s{n}"]["is_overlapping"] for n in range(3)]
    assert flags == [False, True, False]


def test_reactivation(spark):
    rows = history(
        {"start_date": "2024-01-01", "status": "canceled"},
        {"start_date": "2024-02-01", "status": "active"},
        {"start_date": "2024-03-01", "status": "active"},
        {"start_date": "2024-04-01", "status": "canceled"},
    ) + [{"subscription_id": "other", "user_id": "u2", "start_date": "2024-05-01"}]
    silver = silver_of(spark, *rows)
    assert {key for key, row in silver.items() if row["is_reactivation"]} == {"s1"}


def test_row_without_start_counts_as_previous_then_is_dropped(spark):
    rows = history(
        {"start_date": None, "end_date": "2024-06-30", "status": "canceled"},
        {"start_date": "2024-02-01"},
    )
    silver = silver_of(spark, *rows)
    assert set(silver) == {"s1"}
    assert silver["s1"]["is_overlapping"] and silver["s1"]["is_reactivation"]


def test_inverted_dates_and_unknown_values_stay(spark):
    rows = [{"start_date": "2024-02-01", "end_date": "2024-01-01", "plan_id": "gold",
             "status": "paused", "price": "-1"}]
    assert set(silver_of(spark, *rows)) == {"s1"}


@pytest.mark.parametrize("seed", range(3))
def test_histories_cut_into_segments_get_the_flags_of_whole_ones(spark, seed):
    rng = random.Random(seed)
    days = [None] + [f"2024-01-{day:02d}" for day in range(1, 9)]
    rows = [
        {
            "subscription_id": f"s{number}",
            "user_id": rng.choice([None, None, "u1", "u1", "u2"]),
            "start_date": rng.choice(days),
            "end_date": rng.choice(days),
            "status": rng.choice(["active", "canceled"]),
        }
        for number in range(300)
    ] + [{"subscription_id": None, "user_id": "u1"}]
    bronze = bronze_of(spark, *rows).repartition(3)
    latest = subscriptions.deduplicate_subscriptions(subscriptions.cast_subscriptions(bronze))
    whole = Window.partitionBy("user_id").orderBy(
        F.asc_nulls_first("start_date"), F.asc_nulls_first("subscription_id")
    )
    columns = {"before_end": "end_date", "before_status": "status"}
    plain = latest.withColumns({k: F.lag(v).over(whole) for k, v in columns.items()})
    split = with_previous(latest, "user_id", "start_date", "subscription_id", columns)
    assert split.columns == plain.columns
    expected = sorted(plain.collect(), key=str)
    assert sum(row["before_end"] is not None for row in expected) > 100
    assert sorted(split.collect(), key=str) == expected


def test_previous_row_crosses_empty_days(spark):
    rows = [("k", dt.date(2024, 1, 1), "a", 1), ("k", dt.date(2024, 3, 1), "b", None),
            ("k", dt.date(2024, 3, 2), "c", 3)]
    df = spark.createDataFrame(rows, "key string, day date, id string, value int")
    found = by(with_previous(df, "key", "day", "id", {"before": "value"}), "id")
    assert [found[i]["before"] for i in "abc"] == [None, 1, None]


def test_users_never_meet_in_one_task(spark):
    days = [{"subscription_id": f"s{n}", "start_date": f"2024-01-{n % 9 + 1:02d}"} for n in range(50)]
    bronze = bronze_of(spark, *days)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    split = subscriptions.checked_subscriptions(bronze)
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(None) == jobs  # built without a job
    plan = split._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(user_id" not in plan
    assert split.filter(F.col("is_overlapping")).count() == 49


@pytest.fixture
def many_segments(spark):
    """As many segments as on a cluster; small ones are not merged."""
    changed = {
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {name: spark.conf.get(name) for name in changed}
    for name, value in changed.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def crowded(spark, count):
    """One key with two thirds of all rows on one day, the null key with most of the rest."""
    number = F.col("id")
    hot = number % 3 > 0
    return spark.range(count).select(
        F.when(hot, "hot").when(number % 9 > 0, F.lit(None)).otherwise(number.cast("string")).alias("key"),
        F.when(hot, "2024-01-05").otherwise(F.format_string("2024-01-%02d", number % 7 + 1)).cast("date").alias("day"),
        F.format_string("s%07d", number * 7919 % count).alias("row"),
        number.alias("value"),
    )


def test_a_crowded_day_spreads_over_tasks(spark, many_segments):
    count = 20_000
    df = crowded(spark, count)
    split = with_previous(df, "key", "day", "row", {"before": "value"})
    sizes = [r["count"] for r in split.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == count and max(sizes) < count / 3  # a plain lag: 2 / 3 in one task
    whole = Window.partitionBy("key").orderBy(F.asc_nulls_first("day"), F.asc_nulls_first("row"))
    plain = df.withColumn("before", F.lag("value").over(whole))
    assert split.exceptAll(plain).count() == 0


@pytest.mark.parametrize("rows", [0, 1, 40])
def test_segments_of_few_rows(spark, many_segments, rows):
    df = crowded(spark, 40).limit(rows)
    whole = Window.partitionBy("key").orderBy(F.asc_nulls_first("day"), F.asc_nulls_first("row"))
    expected = df.withColumn("before", F.lag("value").over(whole)).collect()
    found = with_previous(df, "key", "day", "row", {"before": "value"}).collect()
    assert sorted(found, key=str) == sorted(expected, key=str) and len(found) == rows


def test_equal_rows_across_segments(spark, many_segments):
    df = spark.range(100).select(F.lit("k").alias("key"), F.lit("d").alias("day"), F.lit("r").alias("row"), "id")
    found = with_previous(df, "key", "day", "row", {"before": "id"}).collect()
    befores = [row["before"] for row in found]
    assert befores.count(None) == 1 and len(set(befores)) == 100  # each row once, and one has none
    assert all(row["before"] != row["id"] for row in found)
