import datetime as dt

import pytest
from frames import MARKETING_BRONZE, NOON, by, frame
from pyspark.sql import functions as F

from tidemark.operators import marketing


def bronze_of(spark, *rows):
    default = {"date": "2024-01-01", "channel": "ads", "spend": "10.5", "_ingest_timestamp": NOON}
    return frame(spark, MARKETING_BRONZE, [default | row for row in rows])


@pytest.mark.parametrize(
    "row, reason",
    [
        ({"date": None, "channel": None}, "missing_date"),
        ({"date": "01/02/2024"}, "missing_date"),
        ({"channel": None, "spend": None}, "missing_channel"),
        ({"channel": ""}, "missing_channel"),
        ({"spend": None}, "null_spend"),
        ({"spend": "abc"}, "null_spend"),
        ({"spend": "-1"}, "negative_spend"),
        ({"spend": "0"}, None),
        ({}, None),
    ],
)
def test_quarantine_reasons(spark, row, reason):
    bronze = bronze_of(spark, row)
    bad = [r["_quarantine_reason"] for r in marketing.marketing_spend_quarantine(bronze).collect()]
    assert bad == ([reason] if reason else [])
    assert marketing.valid_spend(bronze).count() == (0 if reason else 1)


def test_exact_copies_keep_the_earliest_ingest(spark):
    later = NOON + dt.timedelta(days=1)
    bronze = bronze_of(spark, {"_ingest_timestamp": later}, {}, {"spend": "11"})
    silver = by(marketing.marketing_spend_silver(bronze), "spend")
    assert set(silver) == {10.5, 11.0}
    assert silver[10.5]["_ingest_timestamp"] == NOON


def test_gap_flags(spark):
    rows = [
        ("ads", "2024-01-01", "1"),
        ("ads", "2024-01-02", "1"),
        ("ads", "2024-01-04", "5"),
        ("ads", "2024-01-04", "3"),
        ("ads", "2024-01-05", "1"),
        ("tv", "2024-01-09", "1"),
        ("tv", "2024-03-01", "1"),
    ]
    bronze = bronze_of(spark, *[dict(channel=c, date=d, spend=s) for c, d, s in rows])
    flagged = {
        (row["channel"], str(row["date"]), row["spend"])
        for row in marketing.marketing_spend_silver(bronze).collect()
        if row["has_gap_before"]
    }
    # Of two rows on the day after a gap, the one with the smaller spend comes first.
    assert flagged == {("ads", "2024-01-04", 3.0), ("tv", "2024-03-01", 1.0)}


def test_accepts_numeric_spend(spark):
    bronze = bronze_of(spark, {"spend": "2"}).withColumn("spend", F.col("spend").cast("double"))
    assert marketing.marketing_spend_silver(bronze).first()["spend"] == 2.0
