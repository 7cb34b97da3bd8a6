import datetime as dt

import pytest
from frames import bronze_event, by, events_bronze, frame
from pyspark.sql import functions as F

from tidemark.operators import events
from tidemark.schemas import EVENTS_BRONZE, ensure_columns

FAULTS = [
    (dict(event_id="a", _rescued_data="{", event_type=None), "corrupted_json"),
    (dict(event_id=None, event_type=None), "null_event_id"),
    (dict(event_id="c", event_type=None, timestamp=None), "null_event_type"),
    (dict(event_id="d", timestamp=None, event_type="bogus"), "null_timestamp"),
    (dict(event_id="e", event_type="bogus"), "invalid_event_type"),
    (dict(event_id="f", event_type=""), "invalid_event_type"),
]


def test_quarantine_names_the_first_fault(spark):
    bronze = events_bronze(spark, {"event_id": "fine"}, *[row for row, _ in FAULTS])
    found = by(events.events_quarantine(bronze), "event_id")
    assert {key: row["_quarantine_reason"] for key, row in found.items()} == {
        row["event_id"]: reason for row, reason in FAULTS
    }


def test_quarantine_keeps_the_bronze_columns(spark):
    bronze = events_bronze(spark, {})
    assert events.events_quarantine(bronze).columns == bronze.columns + ["_quarantine_reason"]


def test_valid_rows_and_quarantine_are_complements(spark):
    bronze = events_bronze(spark, {}, {"user_id": None}, *[row for row, _ in FAULTS])
    valid, bad = events.valid_events(bronze), events.events_quarantine(bronze)
    assert (valid.count(), bad.count()) == (2, len(FAULTS))


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2024-01-15T10:30:00Z", dt.datetime(2024, 1, 15, 10, 30)),
        ("2024-01-15T10:30:00+05:30", dt.datetime(2024, 1, 15, 5)),
        ("2024-01-15T20:30:00-08:00", dt.datetime(2024, 1, 16, 4, 30)),
        ("2024-01-15 10:30:00", dt.datetime(2024, 1, 15, 10, 30)),
        ("2024-01-15T10:30:00", None),
        ("2024-02-30 10:30:00", None),
        ("junk", None),
        ("", None),
    ],
)
def test_timestamp_formats(spark, text, expected):
    row = events.normalize_timestamps(events_bronze(spark, {"timestamp": text})).first()
    assert row["_timestamp_utc"] == expected
    assert row["event_date"] == (expected.date() if expected else None)


def test_unparsed_timestamp_stays_in_silver(spark):
    row = events.events_silver(events_bronze(spark, {"timestamp": "junk"})).first()
    assert row["timestamp"] == "junk"
    assert row["_timestamp_utc"] is None and row["event_date"] is None


@pytest.mark.parametrize("present", [[], ["currency"], ["tax"], ["currency", "tax"]])
def test_missing_columns_are_added_as_typed_nulls(spark, present):
    bronze = frame(
        spark, EVENTS_BRONZE, [bronze_event(currency="EUR", tax=1.5)]
    ).drop(*{"currency", "tax"} - set(present))
    unified = ensure_columns(bronze, EVENTS_BRONZE)
    assert unified.schema["currency"].dataType.typeName() == "string"
    assert unified.schema["tax"].dataType.typeName() == "double"
    row = events.events_silver(bronze).first()
    assert row["currency"] == ("EUR" if "currency" in present else None)
    assert row["tax"] == (1.5 if "tax" in present else None)


def test_rows_without_user_are_flagged_and_kept(spark):
    silver = by(
        events.events_silver(
            events_bronze(spark, {"event_id": "a"}, {"event_id": "b", "user_id": None})
        ),
        "event_id",
    )
    assert not silver["a"]["_user_id_missing"] and silver["b"]["_user_id_missing"]


EARLY, LATE = dt.datetime(2024, 2, 1), dt.datetime(2024, 2, 2)


@pytest.mark.parametrize(
    "copies, winner",
    [
        ([dict(amount=9.5), dict(amount=100.0)], dict(amount=100.0)),
        ([dict(amount=None), dict(amount=-3.0)], dict(amount=-3.0)),
        ([dict(amount=5.0), dict(amount=5.0)], dict(amount=5.0)),
        (
            [
                dict(amount=5.0, currency="A", _ingest_timestamp=EARLY),
                dict(amount=5.0, currency="B", _ingest_timestamp=LATE),
            ],
            dict(currency="B"),
        ),
        (
            [
                dict(amount=7.0, currency="A", _ingest_timestamp=EARLY),
                dict(amount=5.0, currency="B", _ingest_timestamp=LATE),
            ],
            dict(currency="A"),
        ),
        ([dict(currency="B"), dict(currency="A")], dict(currency="A")),
    ],
)
def test_conflicting_copies(spark, copies, winner):
    for order in (copies, copies[::-1]):
        rows = events.events_silver(events_bronze(spark, *order)).collect()
        assert len(rows) == 1
        assert {key: rows[0][key] for key in winner} == winner


def test_deduplication_is_idempotent(spark):
    bronze = events_bronze(
        spark, *[{"event_id": f"e{i % 7}", "amount": float(i % 3)} for i in range(40)]
    )
    once = events.deduplicate_events(bronze)
    assert once.count() == once.select("event_id").distinct().count() == 7
    assert sorted(events.deduplicate_events(once).collect()) == sorted(once.collect())


def test_silver_columns(spark):
    silver = events.events_silver(events_bronze(spark, {}))
    assert silver.columns == events.EVENTS_SILVER_COLUMNS


def test_empty_input(spark):
    bronze = events_bronze(spark, {}).filter(F.lit(False))
    assert events.events_silver(bronze).count() == 0
    assert events.events_quarantine(bronze).count() == 0


def test_copies_are_reduced_before_the_shuffle(spark, tmp_path):
    events_bronze(spark, {}).write.parquet(str(tmp_path / "bronze"))
    bronze = spark.read.parquet(str(tmp_path / "bronze"))
    plan = events.events_silver(bronze)._jdf.queryExecution().executedPlan().toString()
    limits = plan.count("WindowGroupLimit")
    before_shuffle = plan[plan.index("Exchange hashpartitioning"):].count("WindowGroupLimit")
    assert (limits, before_shuffle) == (2, 1)
    assert "PushedFilters: [IsNull(_rescued_data), IsNotNull(event_id)" in plan
