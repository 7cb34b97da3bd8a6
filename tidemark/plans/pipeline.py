"""The whole run: files to bronze, bronze to silver, silver to gold."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tidemark.operators.events import EVENT_RULES
from tidemark.operators.marketing import (
    MARKETING_RULES,
    checked_spend,
    marketing_spend_quarantine,
)
from tidemark.operators.quality import Rule, drop_violations, expectation_report, observe_rules
from tidemark.operators.subscriptions import SUBSCRIPTION_RULES, checked_subscriptions
from tidemark.plans.acquisition import cac_by_channel, ltv_cac_ratio
from tidemark.plans.activity import weekly_cohort_retention
from tidemark.plans.incremental import refresh_daily, refresh_events, refresh_ltv
from tidemark.plans.recurring import SPINE_START, mrr_daily
from tidemark.session import pin_utc
from tidemark.sources.files import read_subscriptions
from tidemark.sources.tables import BRONZE, GOLD, SILVER, Warehouse
from tidemark.streaming.ingest import ingest_events, ingest_marketing

EXPECTATIONS_SCHEMA = StructType(
    [
        StructField("dataset", StringType()),
        StructField("rule", StringType()),
        StructField("action", StringType()),
        StructField("passed", LongType()),
        StructField("failed", LongType()),
    ]
)


def run_all(
    spark: SparkSession,
    src: str,
    out: str,
    as_of: dt.date,
    mrr_start: dt.date = SPINE_START,
    subscriptions_path: str | None = None,
    subscriptions_multiline: bool = True,
    ingest_ts: dt.datetime | None = None,
    full_refresh: bool = False,
) -> Warehouse:
    """Bring every table under ``out`` up to date with the files in ``src``.

    Event and marketing files are appended incrementally. Of the events, only the days and
    users that new rows touch are computed again, unless ``full_refresh`` is set; the tables
    of subscriptions and spend, and what joins them, are recomputed. Each table is replaced
    at once, by a version of its own: a run that was cut short can be repeated, and readers
    see one whole version at any time. A feed without files is an empty table.
    """
    pin_utc(spark)
    tables = Warehouse(spark, out)

    ingest_events(tables, src, ingest_ts)
    marketing_bronze = ingest_marketing(tables, src, ingest_ts)
    subscriptions_bronze = tables.save(
        read_subscriptions(
            spark,
            subscriptions_path or f"{src.rstrip('/')}/subscriptions.json",
            subscriptions_multiline,
            ingest_ts,
        ),
        BRONZE,
        "subscriptions_bronze",
    )

    changes = refresh_events(tables, full_refresh)
    events = tables.read(SILVER, "events_silver")
    report = [tuple(row) for row in expectation_report(events, "events_silver", EVENT_RULES).collect()]
    tables.save(
        marketing_spend_quarantine(marketing_bronze), SILVER, "marketing_spend_quarantine"
    )
    spend = _save_checked(
        tables, checked_spend(marketing_bronze), "marketing_spend_silver", MARKETING_RULES, report
    )
    subscriptions = _save_checked(
        tables,
        checked_subscriptions(subscriptions_bronze),
        "subscriptions_silver",
        SUBSCRIPTION_RULES,
        report,
    )
    tables.save(spark.createDataFrame(report, EXPECTATIONS_SCHEMA), SILVER, "expectations")

    refresh_daily(tables, changes)
    ltv = refresh_ltv(tables, changes)
    tables.save(weekly_cohort_retention(events), GOLD, "weekly_cohort_retention")
    cac = tables.save(cac_by_channel(events, spend), GOLD, "cac_by_channel")
    tables.save(mrr_daily(subscriptions, as_of, mrr_start), GOLD, "mrr_daily")
    tables.save(ltv_cac_ratio(ltv, spend, cac), GOLD, "ltv_cac_ratio")
    return tables


def _save_checked(
    tables: Warehouse, df: DataFrame, name: str, rules: list[Rule], report: list[tuple]
) -> DataFrame:
    """Store a silver table without its dropped rows, counting violations on the way."""
    observation = Observation(name)
    stored = tables.save(
        drop_violations(observe_rules(df, rules, observation), rules), SILVER, name
    )
    counts = observation.get
    for rule in rules:
        failed = counts[rule.name]
        report.append((name, rule.name, rule.action, counts["rows"] - failed, failed))
    return stored
