import pytest
from pyspark.sql import Observation

from tidemark.operators.quality import (
    DROP,
    Rule,
    drop_violations,
    expectation_report,
    observe_rules,
)

RULES = [Rule("positive", "n > 0"), Rule("named", "name IS NOT NULL", DROP)]


@pytest.fixture
def numbers(spark):
    return spark.createDataFrame(
        [(1, "a"), (-1, "b"), (None, "c"), (2, None)], "n int, name string"
    )


def test_report_counts_null_as_failed(numbers):
    report = expectation_report(numbers, "numbers", RULES)
    assert report.columns == ["dataset", "rule", "action", "passed", "failed"]
    assert [tuple(row) for row in report.collect()] == [
        ("numbers", "positive", "warn", 2, 2),
        ("numbers", "named", "drop", 3, 1),
    ]


def test_report_of_no_rows(numbers):
    counts = [tuple(row)[3:] for row in expectation_report(numbers.limit(0), "n", RULES).collect()]
    assert counts == [(0, 0), (0, 0)]


def test_only_drop_rules_drop(numbers):
    assert sorted(row["name"] for row in drop_violations(numbers, RULES).collect()) == [
        "a",
        "b",
        "c",
    ]


def test_observed_counts_come_with_the_data(numbers):
    observation = Observation("numbers")
    kept = drop_violations(observe_rules(numbers, RULES, observation), RULES)
    assert len(kept.collect()) == 3
    assert observation.get == {"rows": 4, "positive": 2, "named": 1}
