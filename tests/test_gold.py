"""Hand-made cases of the business tables."""

import datetime as dt
import random
from decimal import Decimal
from fractions import Fraction

import pytest
from frames import (
    EVENTS_SILVER,
    MARKETING_SILVER,
    SUBSCRIPTIONS_SILVER,
    by,
    events_silver,
    frame,
    subscriptions_silver,
)
from pyspark.sql import functions as F

from tidemark.functions.money import exact_sums
from tidemark.plans.acquisition import cac_by_channel, ltv_cac_ratio
from tidemark.plans.activity import daily_active_users, weekly_cohort_retention
from tidemark.plans.recurring import mrr_daily
from tidemark.plans.revenue import daily_revenue_gross, daily_revenue_net, ltv_per_user

DAY = dt.date(2024, 1, 15)
NEXT = dt.datetime(2024, 1, 16, 9)


def spend_of(spark, *rows):
    return frame(spark, MARKETING_SILVER, [{"date": DAY, "channel": "ads"} | r for r in rows])


def test_daily_active_users(spark):
    events = events_silver(
        spark,
        {"user_id": "a"},
        {"user_id": "a"},
        {"user_id": "b"},
        {"user_id": None},
        {"user_id": "a", "_timestamp_utc": None},
    )
    found = by(daily_active_users(events), "event_date")
    assert found == {
        DAY: {"event_date": DAY, "dau": 2, "total_events": 3},
        None: {"event_date": None, "dau": 1, "total_events": 1},
    }


def test_gross_revenue(spark):
    events = events_silver(
        spark,
        {"amount": 10.0},
        {"amount": 2.5, "user_id": None},
        {"amount": -4.0},
        {"amount": 0.0},
        {"amount": None},
        {"event_type": "refund", "amount": 9.0},
        {"amount": 7.0, "_timestamp_utc": None},
    )
    found = by(daily_revenue_gross(events), "event_date")
    assert found[DAY] == {
        "event_date": DAY,
        "gross_revenue": 12.5,
        "purchase_count": 2,
        "paying_users": 1,
    }
    assert found[None]["gross_revenue"] == 7.0


def test_net_revenue(spark):
    events = events_silver(
        spark,
        {"amount": 10.0},
        {"event_type": "refund", "amount": -3.0},
        {"event_type": "refund", "amount": 2.0},
        {"event_type": "refund", "amount": None},
        {"amount": 5.0, "_timestamp_utc": NEXT},
        {"event_type": "refund", "amount": 1.0, "_timestamp_utc": dt.datetime(2024, 1, 17)},
        {"amount": 7.0, "_timestamp_utc": None},
        {"event_type": "refund", "amount": 1.0, "_timestamp_utc": None},
    )
    found = by(daily_revenue_net(events), "event_date")
    assert {
        day: (row["gross_revenue"], row["total_refunds"], row["net_revenue"])
        for day, row in found.items()
    } == {DAY: (10.0, 5.0, 5.0), NEXT.date(): (5.0, 0.0, 5.0), None: (7.0, 0.0, 7.0)}


def test_money_that_is_no_money_is_not_lost(spark):
    events = events_silver(spark, {"amount": 1e300}, {"amount": 1.0}, {"amount": 1e300})
    assert daily_revenue_gross(events).first()["gross_revenue"] == 2e300
    # Finer than a millionth, beside an amount that is not.
    events = events_silver(spark, {"amount": 2.0**-30}, {"amount": 0.5})
    assert daily_revenue_gross(events).first()["gross_revenue"] == 0.5 + 2.0**-30
    events = events_silver(spark, {"amount": float("nan")}, {"amount": 1.0})
    gross = daily_revenue_gross(events).first()["gross_revenue"]
    assert gross != gross


def test_retention(spark):
    sunday, monday = dt.datetime(2024, 1, 14, 23, 59), dt.datetime(2024, 1, 15)
    events = events_silver(
        spark,
        {"user_id": "a", "event_type": "signup", "_timestamp_utc": sunday},
        {"user_id": "a", "event_type": "signup", "_timestamp_utc": monday},
        {"user_id": "a", "_timestamp_utc": dt.datetime(2023, 12, 1)},
        {"user_id": "a", "_timestamp_utc": dt.datetime(2024, 1, 29)},
        {"user_id": "b", "event_type": "signup", "_timestamp_utc": sunday},
        {"user_id": "c", "event_type": "signup", "_timestamp_utc": monday},
        {"user_id": "d", "_timestamp_utc": monday},
        {"user_id": "e", "event_type": "signup", "_timestamp_utc": None},
        {"user_id": "e", "_timestamp_utc": monday},
        {"user_id": None, "event_type": "signup", "_timestamp_utc": monday},
    )
    first, second = dt.date(2024, 1, 8), dt.date(2024, 1, 15)
    assert sorted(tuple(row) for row in weekly_cohort_retention(events).collect()) == [
        (first, 0, 2, 2, 1.0),
        (first, 1, 1, 2, 0.5),
        (first, 3, 1, 2, 0.5),
        (second, 0, 1, 1, 1.0),
    ]
    assert dict(weekly_cohort_retention(events).dtypes)["weeks_since_signup"] == "int"


def test_ltv(spark):
    morning, evening = dt.datetime(2024, 1, 15, 6), dt.datetime(2024, 1, 15, 23)
    signup = {"event_type": "signup", "amount": None}
    events = events_silver(
        spark,
        signup | {"acquisition_channel": "late", "_timestamp_utc": evening},
        signup | {"acquisition_channel": None, "_timestamp_utc": dt.datetime(2024, 1, 1)},
        signup | {"acquisition_channel": "early", "_timestamp_utc": morning},
        signup | {"acquisition_channel": "unknown time", "_timestamp_utc": None},
        {"event_type": "login", "acquisition_channel": "no signup", "_timestamp_utc": None},
        {"amount": 10.25},
        {"amount": -3.0},
        {"event_type": "refund", "amount": -4.0, "_timestamp_utc": dt.datetime(2024, 1, 20)},
        {"user_id": "b", "event_type": "refund", "amount": 2.0},
        {"user_id": "c", "event_type": "login", "_timestamp_utc": None},
        {"user_id": None, "amount": 99.0},
    )
    found = by(ltv_per_user(events), "user_id")
    assert set(found) == {"u1", "b", "c"}
    assert found["u1"] == {
        "user_id": "u1",
        "acquisition_channel": "early",
        "first_seen": dt.datetime(2024, 1, 1),
        "last_seen": dt.datetime(2024, 1, 20),
        "customer_lifetime_days": 19,
        "purchase_count": 1,
        "total_purchases": 10.25,
        "total_refunds": 4.0,
        "ltv": 6.25,
    }
    assert (found["b"]["purchase_count"], found["b"]["total_purchases"]) == (None, 0.0)
    assert found["b"]["ltv"] == -2.0
    assert found["c"]["first_seen"] is None and found["c"]["customer_lifetime_days"] is None


def test_cac(spark):
    signup = {"event_type": "signup", "acquisition_channel": "ads"}
    events = events_silver(
        spark,
        signup | {"user_id": "a"},
        signup | {"user_id": "a"},
        signup | {"user_id": "b"},
        signup | {"user_id": None},
        signup | {"user_id": "c", "acquisition_channel": None},
        signup | {"user_id": "d", "acquisition_channel": "free"},
        signup | {"user_id": "e", "acquisition_channel": "zero"},
        signup | {"user_id": "f", "_timestamp_utc": None},
    )
    spend = spend_of(
        spark,
        {"spend": 10.0},
        {"spend": 15.01},
        {"spend": 8.0, "channel": "tv"},
        {"spend": 0.0, "channel": "zero"},
    )
    found = {
        (row["date"], row["channel"]): (row["total_spend"], row["new_customers"], row["cac"])
        for row in cac_by_channel(events, spend).collect()
    }
    assert found == {
        (DAY, "ads"): (25.01, 2, 12.51),
        (DAY, "tv"): (8.0, 0, None),
        (DAY, "free"): (0.0, 1, None),
        (DAY, "zero"): (0.0, 1, None),
        (None, "ads"): (0.0, 1, None),
    }


def test_ltv_cac_ratio(spark):
    ltv = spark.createDataFrame(
        [("a", "ads", 20.0), ("b", "ads", 40.0), ("c", "tv", 9.0), ("d", "free", 5.0),
         ("e", None, 99.0), ("f", "zero", 1.0), ("g", "poor", 29.99)],
        "user_id string, acquisition_channel string, ltv double",
    )
    spend = spend_of(
        spark,
        {"spend": 20.0},
        {"spend": 7.0, "channel": "tv"},
        {"spend": 0.0, "channel": "zero"},
        {"spend": 10.0, "channel": "poor"},
    )
    cac = spark.createDataFrame(
        [(DAY, "ads", 2), (None, "ads", 0), (DAY, "tv", 0), (DAY, "free", 3), (DAY, "zero", 1),
         (DAY, "poor", 1)],
        "date date, channel string, new_customers long",
    )
    found = by(ltv_cac_ratio(ltv, spend, cac), "acquisition_channel")
    assert found["ads"] == {
        "acquisition_channel": "ads",
        "total_customers": 2,
        "avg_ltv": 30.0,
        "total_ltv": 60.0,
        "avg_cac": 10.0,
        "total_spend": 20.0,
        "ltv_cac_ratio": 3.0,
        "is_healthy": True,
    }
    # Spend without acquired customers is not shown.
    assert (found["tv"]["avg_cac"], found["tv"]["total_spend"]) == (None, None)
    assert found["free"]["is_healthy"] is None and found["zero"]["ltv_cac_ratio"] is None
    assert found["zero"]["avg_cac"] == 0.0
    assert (found["poor"]["ltv_cac_ratio"], found["poor"]["is_healthy"]) == (3.0, True)
    assert set(found) == {"ads", "tv", "free", "zero", "poor"}


def mrr_of(subscriptions, first, last):
    rows = mrr_daily(subscriptions, dt.date(2024, 1, last), dt.date(2024, 1, first)).collect()
    return {row["date"].day: tuple(row)[1:] for row in rows}


def jan(day):
    return dt.date(2024, 1, day)


def test_mrr_first_and_last_day_count(spark):
    subs = subscriptions_silver(spark, {"start_date": jan(3), "end_date": jan(4), "price": 5.0})
    nothing, one = (None, 0, 0), (5.0, 1, 1)
    assert mrr_of(subs, 2, 5) == {2: nothing, 3: one, 4: one, 5: nothing}


@pytest.mark.parametrize(
    "row, days",
    [
        ({"end_date": None}, range(10, 13)),
        ({"start_date": dt.date(2023, 1, 1), "end_date": jan(9)}, range(8, 10)),
        ({"end_date": jan(31)}, range(10, 13)),
        ({"start_date": jan(13), "end_date": None}, []),
        ({"start_date": jan(1), "end_date": jan(7)}, []),
        ({"start_date": jan(11), "end_date": jan(10)}, []),
        ({"start_date": None}, []),
        ({"status": "canceled"}, []),
        ({"status": None}, []),
    ],
)
def test_mrr_ranges(spark, row, days):
    found = mrr_of(subscriptions_silver(spark, row), 8, 12)
    assert sorted(day for day, values in found.items() if values == (10.0, 1, 1)) == list(days)
    assert set(found) == set(range(8, 13))


def test_mrr_counts_a_user_once(spark):
    subs = subscriptions_silver(
        spark,
        {"start_date": jan(8), "end_date": jan(20)},
        {"start_date": jan(9), "end_date": jan(10)},
        {"start_date": jan(9), "end_date": jan(10), "user_id": None},
        {"start_date": jan(9), "end_date": jan(9), "price": None, "user_id": "b"},
    )
    assert mrr_of(subs, 8, 11) == {
        8: (10.0, 1, 1),
        9: (30.0, 4, 2),
        10: (30.0, 3, 1),
        11: (10.0, 1, 1),
    }


def test_mrr_leaves_no_residue(spark):
    rows = [{"start_date": jan(2), "end_date": jan(n), "price": 0.1} for n in range(2, 12)]
    found = mrr_of(subscriptions_silver(spark, *rows), 1, 12)
    assert found[11][0] == 0.1 and found[12][0] is None and found[2][0] == 1.0


def exact_sum(spark, amounts, partitions=3):
    rows = spark.createDataFrame([(1, a) for a in amounts], "k int, a double").repartition(partitions)
    found = exact_sums(rows, ["k"], F.col("a"), {"total": None}, {"rows": (F.count("*"), F.sum)}).collect()
    assert [r["rows"] for r in found] == ([len(amounts)] if amounts else [])
    return found[0]["total"] if found else None


def test_ordinary_money_is_added_as_it_is_written(spark):
    amounts = [0.1, 0.2, 999_999_999.999999, -0.3, 0.000001, -987_654.321] * 7
    assert exact_sum(spark, amounts) == float(sum(Decimal(str(a)) for a in amounts))
    assert exact_sum(spark, [0.1, None, 0.2]) == 0.3
    assert exact_sum(spark, [None]) is None and exact_sum(spark, [0.0, -0.0]) == 0.0


@pytest.mark.parametrize("seed", range(4))
def test_sums_of_any_doubles_are_exact(spark, seed):
    rng = random.Random(seed)
    wide = [rng.choice([-1, 1]) * rng.random() * 2.0 ** rng.randint(*rng.choice([(-1074, 1000), (28, 110), (-60, 0)])) for _ in range(200)]
    amounts = wide + [-x for x in rng.sample(wide, 150)] + [5e-324, 1e300, -1e300, 2.0**1000, 8.0, 1 / 3, 1e9, 2.0**53 + 2]
    rng.shuffle(amounts)
    binary = [a for a in amounts if not (abs(a) < 1e9 and a == round(a, 6))]
    expected = float(sum(map(Fraction, binary), Fraction(0))) + float(sum(Decimal(str(a)) for a in amounts if a not in binary))
    assert exact_sum(spark, amounts) == expected
    assert exact_sum(spark, amounts[::-1], 1) == exact_sum(spark, amounts, 7) == expected


def test_sums_at_every_size(spark):
    assert exact_sum(spark, [9e31, 9e31]) == 1.8e32
    assert exact_sum(spark, [1e9 + 0.01, 1e300, 1e32, -1e300, -1e32]) == 1e9 + 0.01
    assert exact_sum(spark, [1e308, 1e308]) == float("inf")
    assert exact_sum(spark, [1e308, 1e308, -1e308]) == 1e308
    inf, nan = float("inf"), float("nan")
    assert exact_sum(spark, [1.0, inf]) == inf and exact_sum(spark, [-inf, 1e300]) == -inf
    assert all(x != x for x in (exact_sum(spark, [inf, -inf]), exact_sum(spark, [nan, 1.0])))
    powers = [2.0**n for n in range(-1074, 1024)]  # each is added to its own bin
    assert exact_sum(spark, powers + [-x for x in powers if x != 4.0]) == 4.0


def test_revenue_of_large_and_uneven_amounts(spark):
    amounts = [1e10 + 0.05, 1 / 3, 7e25, 12.5, 1 / 3]
    rows = [{"amount": a, "user_id": f"u{i % 2}"} for i, a in enumerate(amounts)]
    rows += [{"amount": 9e31, "user_id": "u0", "event_type": "refund"}]
    events = events_silver(spark, *rows)
    (gross,) = daily_revenue_gross(events).collect()
    expected = float(sum(map(Fraction, [a for a in amounts if a != 12.5])) + Fraction(12.5))
    assert (gross["gross_revenue"], gross["purchase_count"], gross["paying_users"]) == (expected, 5, 2)
    (net,) = daily_revenue_net(events).collect()
    assert (net["gross_revenue"], net["total_refunds"]) == (expected, 9e31)
    users = by(ltv_per_user(events), "user_id")
    assert users["u1"]["total_purchases"] == 1 / 3 + 12.5 and users["u1"]["purchase_count"] == 2
    assert users["u0"]["total_refunds"] == 9e31 and users["u0"]["purchase_count"] == 3


def test_mrr_of_prices_beyond_decimals(spark):
    rows = [{"price": p, "start_date": jan(3), "end_date": jan(d)} for p, d in ((9e31, 5), (9e31, 4), (1e300, 4), (1 / 3, 6))]
    found = mrr_of(subscriptions_silver(spark, *rows), 1, 8)
    shown = {day: found[day][0] for day in found}
    assert shown == {1: None, 2: None, 3: 1e300, 4: 1e300, 5: 9e31, 6: 1 / 3, 7: None, 8: None}
    twice = [{"price": 9e31, "start_date": jan(1), "end_date": jan(1)}] * 2
    assert mrr_of(subscriptions_silver(spark, *twice), 1, 2)[1][0] == 1.8e32


def test_mrr_with_prices_that_are_no_prices(spark):
    """Each shows on its day, as a sum of the day's prices would, and leaves no trace."""
    inf, nan = float("inf"), float("nan")
    odd = {2: [1e20], 4: [nan], 6: [inf], 8: [-inf, 5.0], 10: [inf, -inf], 12: [1e300, 1e300], 14: [1e308]}
    rows = [{"price": 10.5, "start_date": jan(1)}] + [
        {"price": price, "start_date": jan(day), "end_date": jan(day)}
        for day, prices in odd.items()
        for price in prices
    ]
    found = mrr_of(subscriptions_silver(spark, *rows), 1, 15)
    shown = {2: 1e20, 4: nan, 6: inf, 8: -inf, 10: nan, 12: 2e300, 14: 1e308}
    for day in range(1, 16):
        expected = shown.get(day, 10.5)
        assert found[day][0] == pytest.approx(expected, rel=1e-12, nan_ok=True), day
        assert found[day][1] == 1 + len(odd.get(day, []))


def test_empty_inputs(spark):
    events = frame(spark, EVENTS_SILVER, [])
    spend = frame(spark, MARKETING_SILVER, [])
    for table in (
        daily_active_users(events),
        daily_revenue_gross(events),
        daily_revenue_net(events),
        weekly_cohort_retention(events),
        ltv_per_user(events),
        cac_by_channel(events, spend),
        ltv_cac_ratio(ltv_per_user(events), spend, cac_by_channel(events, spend)),
    ):
        assert table.collect() == []
    assert len(mrr_of(frame(spark, SUBSCRIPTIONS_SILVER, []), 1, 3)) == 3


def test_spine_must_not_end_before_it_starts(spark):
    with pytest.raises(ValueError):
        mrr_daily(subscriptions_silver(spark), jan(1), jan(2))
