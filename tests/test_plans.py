"""What the physical plans of stored tables look like."""

import re

import pytest
from frames import MARKETING_BRONZE, SUBSCRIPTIONS_BRONZE, events_silver, frame, subscriptions_silver

from tidemark.fixtures import MRR_AS_OF, MRR_START
from tidemark.operators.marketing import marketing_spend_silver
from tidemark.operators.subscriptions import subscriptions_silver as cleaned_subscriptions
from tidemark.plans.activity import daily_active_users, weekly_cohort_retention
from tidemark.plans.recurring import mrr_daily
from tidemark.plans.revenue import daily_revenue_gross, daily_revenue_net, ltv_per_user


@pytest.fixture(scope="module")
def events(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "events")
    events_silver(spark, {}).write.parquet(path)
    return spark.read.parquet(path)


def plan_of(df):
    # The formatted text spells out lists that the tree shortens.
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def columns_read(plan):
    return [
        set(re.findall(r"(\w+):", schema)) for schema in re.findall(r"ReadSchema: struct<(.*)>", plan)
    ]


@pytest.mark.parametrize(
    "table, columns, shuffles",
    [
        (daily_active_users, {"event_id", "user_id", "_user_id_missing", "event_date"}, 2),
        (
            weekly_cohort_retention,
            {"user_id", "_user_id_missing", "event_type", "event_date"},
            4,
        ),
        (
            daily_revenue_gross,
            {"event_id", "user_id", "event_type", "event_date", "amount"},
            3,  # the last of a row for each day and bin of amounts
        ),
        (daily_revenue_net, {"event_type", "event_date", "amount"}, 2),  # likewise
    ],
)
def test_one_scan_of_the_needed_columns(events, table, columns, shuffles):
    plan = plan_of(table(events))
    assert columns_read(plan) == [columns]
    assert plan.count("hashpartitioning(") == shuffles
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" not in plan


def test_lifetime_value_sorts_signups_only(events):
    plan = plan_of(ltv_per_user(events))
    every, signups = sorted(columns_read(plan), key=lambda c: "acquisition_channel" in c)
    assert every == {"user_id", "_user_id_missing", "event_type", "_timestamp_utc", "amount"}
    assert "acquisition_channel" in signups and "amount" not in signups
    assert "EqualTo(event_type,signup)" in plan
    sorting = re.findall(r"\(\d+\) SortAggregate\n(.*?)\n\n", plan, re.DOTALL)
    assert sorting and all("min_by" in text and "amount" not in text for text in sorting)


def test_event_type_reaches_the_scan(events):
    assert "EqualTo(event_type,purchase), GreaterThan(amount,0.0)" in plan_of(
        daily_revenue_gross(events)
    )
    assert "EqualTo(event_type,refund)" in plan_of(daily_revenue_net(events))


def test_mrr_has_no_join(spark, tmp_path):
    subscriptions_silver(spark, {}).write.parquet(str(tmp_path / "subscriptions"))
    stored = spark.read.parquet(str(tmp_path / "subscriptions"))
    plan = plan_of(mrr_daily(stored, MRR_AS_OF, MRR_START))
    assert "Join" not in plan
    assert "EqualTo(status,active)" in plan and "LessThanOrEqual(start_date" in plan
    assert columns_read(plan) == [
        {"subscription_id", "price", "start_date", "end_date", "status"},
        {"user_id", "start_date", "end_date", "status"},
    ]


@pytest.mark.parametrize(
    "table, schema",
    [(marketing_spend_silver, MARKETING_BRONZE), (cleaned_subscriptions, SUBSCRIPTIONS_BRONZE)],
)
def test_previous_rows_come_from_one_scan(spark, tmp_path, table, schema):
    frame(spark, schema, []).write.parquet(str(tmp_path / "bronze"))
    plan = plan_of(table(spark.read.parquet(str(tmp_path / "bronze"))))
    assert len(columns_read(plan)) == 1 and "Join" not in plan
    # Copies, segments, rows within a segment, first and last rows; none by channel or user alone.
    assert plan.count("hashpartitioning(") == 3 and plan.count("rangepartitioning(") == 1
    assert not re.search(r"hashpartitioning\((channel|user_id)#\d+, \d+", plan)
