"""The whole run on files."""

import datetime as dt
import json
import random

import pytest

from tidemark.plans import pipeline
from tidemark.plans.pipeline import run_all
from tidemark.schemas import BRONZE_TABLES
from tidemark.sources.tables import BRONZE, GOLD, SILVER, Warehouse

EVENTS = [
    dict(event_id="1", user_id="a", event_type="signup", timestamp="2024-01-01T10:00:00Z",
         acquisition_channel="ads"),
    dict(event_id="2", user_id="a", event_type="purchase", timestamp="2024-01-01 11:00:00",
         amount=30.0),
    dict(event_id="2", user_id="a", event_type="purchase", timestamp="2024-01-01 11:00:00",
         amount=40.0),
    dict(event_id="3", user_id="a", event_type="refund", timestamp="2024-01-09T01:00:00+05:30",
         amount=-5),
    dict(event_id="4", user_id=None, event_type="purchase", timestamp="2024-01-01 12:00:00",
         amount=2.0),
    dict(event_id="5", user_id="a", event_type="bogus", timestamp="2024-01-01 12:00:00"),
]
SUBSCRIPTIONS = [
    dict(subscription_id="s1", user_id="a", plan_id="pro", price=10, start_date="2024-01-01",
         end_date=None, status="active", created_at="2024-01-01"),
    dict(subscription_id="s2", user_id="b", plan_id="pro", price=10, start_date=None,
         status="active", created_at="2024-01-01"),
]


@pytest.fixture(scope="module")
def src(tmp_path_factory):
    folder = tmp_path_factory.mktemp("src")
    lines = [json.dumps(event) for event in EVENTS] + ['{"event_id": "cut']
    (folder / "events.ndjson").write_text("\n".join(lines))
    (folder / "marketing_spend.csv").write_text(
        "date,channel,spend\n2024-01-01,ads,10\n2024-01-01,ads,10\n2024-01-03,ads,5\nx,ads,1\n"
    )
    (folder / "subscriptions.json").write_text(json.dumps(SUBSCRIPTIONS, indent=1))
    return folder


def rows(tables, layer, name):
    return [tuple(row) for row in tables.read(layer, name).collect()]


def test_run_twice(spark, src, tmp_path):
    def run():
        return run_all(spark, str(src), str(tmp_path), dt.date(2024, 1, 2), dt.date(2024, 1, 1))

    tables = run()
    day, other = dt.date(2024, 1, 1), dt.date(2024, 1, 8)
    assert tables.read(BRONZE, "events_bronze").count() == 7
    reasons = {row["_quarantine_reason"] for row in
               tables.read(SILVER, "events_quarantine").collect()}
    assert reasons == {"invalid_event_type", "corrupted_json"}
    assert tables.read(SILVER, "marketing_spend_quarantine").count() == 1
    assert tables.read(SILVER, "subscriptions_silver").count() == 1
    assert sorted(rows(tables, GOLD, "daily_active_users")) == [(day, 1, 2), (other, 1, 1)]
    assert rows(tables, GOLD, "daily_revenue_gross") == [(day, 42.0, 2, 1)]
    assert rows(tables, GOLD, "daily_revenue_net") == [(day, 42.0, 0.0, 42.0)]
    assert sorted(rows(tables, GOLD, "weekly_cohort_retention")) == [
        (day, 0, 1, 1, 1.0), (day, 1, 1, 1, 1.0),
    ]
    assert tables.read(GOLD, "ltv_per_user").first()["ltv"] == 35.0
    assert sorted(rows(tables, GOLD, "cac_by_channel")) == [
        (day, "ads", 10.0, 1, 10.0), (dt.date(2024, 1, 3), "ads", 5.0, 0, None),
    ]
    assert sorted(rows(tables, GOLD, "mrr_daily")) == [
        (day, 10.0, 1, 1), (dt.date(2024, 1, 2), 10.0, 1, 1),
    ]
    assert rows(tables, GOLD, "ltv_cac_ratio") == [
        ("ads", 1, 35.0, 35.0, 15.0, 15.0, 2.33, False),
    ]
    failed = {row["rule"]: (row["passed"], row["failed"])
              for row in tables.read(SILVER, "expectations").collect()}
    assert failed["valid_start_date"] == (1, 1)
    assert failed["non_negative_amount"] == (3, 1)
    assert len(failed) == 14

    (src / "events_late.ndjson").write_text(json.dumps(
        dict(event_id="9", user_id="z", event_type="login", timestamp="2024-01-01 01:00:00")))
    tables = run()
    assert tables.read(BRONZE, "events_bronze").count() == 8
    assert sorted(rows(tables, GOLD, "daily_active_users"))[0] == (day, 2, 3)


def random_lines(rng, count):
    """Events of few ids, so that later files change earlier events, also their day and user."""
    day = lambda: rng.choice([None, "junk", *(f"2024-01-{d:02} 10:00:00" for d in range(1, 8))])
    for _ in range(count):
        yield json.dumps(
            dict(
                event_id=rng.choice([None, *map(str, range(60))]),
                user_id=rng.choice([None, "a", "b", "c", "d"]),
                event_type=rng.choice(["signup", "purchase", "purchase", "refund", "bogus"]),
                timestamp=day(),
                amount=rng.choice([None, 1.5, 2.5, 20.0, -3.0]),
                acquisition_channel=rng.choice([None, "ads", "tv"]),
            )
        )


EVENT_TABLES = [
    (SILVER, "events_silver"),
    (SILVER, "events_quarantine"),
    (SILVER, "expectations"),
    (GOLD, "daily_active_users"),
    (GOLD, "daily_revenue_gross"),
    (GOLD, "daily_revenue_net"),
    (GOLD, "weekly_cohort_retention"),
    (GOLD, "ltv_per_user"),
    (GOLD, "cac_by_channel"),
    (GOLD, "ltv_cac_ratio"),
]


def test_incremental_runs_equal_a_full_one(spark, tmp_path):
    rng = random.Random(4)
    src = tmp_path / "src"
    src.mkdir()
    at = dt.datetime(2024, 2, 1, tzinfo=dt.timezone.utc)
    run = lambda out, **more: run_all(spark, str(src), str(tmp_path / out), dt.date(2024, 1, 2), dt.date(2024, 1, 1), ingest_ts=at, **more)
    versions = []
    for number, size in enumerate((40, 25, 3)):
        (src / f"events_{number}.ndjson").write_text("\n".join(random_lines(rng, size)))
        tables = run("steps")
        versions.append(tables.snapshot(SILVER, "events_silver"))
    once = run("once")
    content = lambda t: {name: sorted(map(str, rows(t, layer, name))) for layer, name in EVENT_TABLES}
    assert content(tables) == content(once)
    kept = set(versions[1].parts) & set(versions[2].parts)
    assert kept  # days without changes keep their files
    assert all(p.startswith(f"_version={versions[2].version}/") for p in set(versions[2].parts) - kept)
    again = run("steps")
    assert again.snapshot(SILVER, "events_silver") == versions[2]  # nothing new, nothing written
    assert content(run("steps", full_refresh=True)) == content(once)


def test_only_touched_days_are_written(spark, tmp_path):
    src = tmp_path / "src"
    src.mkdir()
    login = lambda i, day: json.dumps(dict(event_id=i, user_id="u", event_type="login", timestamp=f"2024-01-{day:02} 08:00:00"))
    (src / "events_1.ndjson").write_text("\n".join(login(str(d), d) for d in range(1, 10)))
    run = lambda: run_all(spark, str(src), str(tmp_path / "out"), dt.date(2024, 1, 2), dt.date(2024, 1, 1))
    before = run().snapshot(SILVER, "events_silver")
    # A new event on the 3rd; the event of the 5th moves to the 20th (later ingest wins).
    (src / "events_2.ndjson").write_text("\n".join([login("new", 3), login("5", 20)]))
    tables = run()
    after = tables.snapshot(SILVER, "events_silver")
    day = lambda parts: sorted(p[-2:] for p in parts)
    assert day(set(before.parts) - set(after.parts)) == ["03", "05"]
    assert day(set(after.parts) - set(before.parts)) == ["03", "20"]
    assert sorted((r["event_date"].day, r["dau"]) for r in tables.read(GOLD, "daily_active_users").collect()) == [
        (d, 1) for d in (1, 2, 3, 4, 6, 7, 8, 9, 20)
    ]


def test_a_run_cut_short_is_repeated(spark, tmp_path, monkeypatch):
    src = tmp_path / "src"
    src.mkdir()
    rng = random.Random(5)
    run = lambda out: run_all(spark, str(src), str(tmp_path / out), dt.date(2024, 1, 2), dt.date(2024, 1, 1), ingest_ts=dt.datetime(2024, 2, 1))
    (src / "events_1.ndjson").write_text("\n".join(random_lines(rng, 20)))
    run("steps")
    (src / "events_2.ndjson").write_text("\n".join(random_lines(rng, 20)))
    with monkeypatch.context() as before_the_days_are_replaced:
        before_the_days_are_replaced.setattr(Warehouse, "replace_days", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run("steps")
    with monkeypatch.context() as before_gold:
        before_gold.setattr(pipeline, "refresh_daily", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run("steps")
    tables, once = run("steps"), run("once")
    for layer, name in EVENT_TABLES:
        assert sorted(map(str, rows(tables, layer, name))) == sorted(map(str, rows(once, layer, name))), name


def test_each_feed_may_be_absent(spark, src, tmp_path):
    feeds = {p.name: p.read_text() for p in src.iterdir() if "late" not in p.name}
    for absent in feeds:
        folder = tmp_path / absent.split(".")[0]
        (folder / "src").mkdir(parents=True)
        for name, text in feeds.items():
            if name != absent:
                (folder / "src" / name).write_text(text)
        tables = run_all(spark, str(folder / "src"), str(folder / "out"), dt.date(2024, 1, 2), dt.date(2024, 1, 1))
        sizes = {name: tables.read(BRONZE, name).count() for name in BRONZE_TABLES}
        assert [name for name, n in sizes.items() if n == 0] == [f"{absent.split('.')[0]}_bronze"]
        assert tables.read(GOLD, "mrr_daily").count() == 2
        assert tables.read(BRONZE, "events_bronze").schema == BRONZE_TABLES["events_bronze"]
