"""Every registered query: against its SQL, and the shape of its plan."""

import runpy
import sys

import oracles
import pytest
from compare import compare, connect

import __spark_entry__ as entry_points

NAMES = list(entry_points.CORE)
INGEST = {"events_bronze", "marketing_spend_bronze", "subscriptions_bronze", "table_roundtrip"}


@pytest.fixture(scope="module")
def connection(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(NAMES) <= set(entry_points.queries())
    assert set(NAMES) == set(oracles.oracle_sql())
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_without_an_optional_library(monkeypatch):
    """The library's own queries stay when one that only training data needs is missing."""
    monkeypatch.setitem(sys.modules, "tidemark.llm", None)
    found = runpy.run_path(entry_points.__file__)
    assert set(found["queries"]()) == set(NAMES)
    assert set(found["oracle_sql"]()) == set(NAMES)


@pytest.mark.parametrize("name", NAMES)
def test_against_sql(spark, connection, sf_dir, name):
    assert compare(spark, connection, sf_dir, name) == ""


@pytest.mark.parametrize("name", [name for name in NAMES if name not in INGEST])
def test_plan(spark, sf_dir, name):
    """No pair-wise joins, no Python workers, no whole table in one task."""
    plan = entry_points.queries()[name](spark, sf_dir)._jdf.queryExecution().executedPlan()
    text = plan.toString()
    for operator in ("NestedLoop", "CartesianProduct", "Python", "Arrow", "CollectLimit"):
        assert operator not in text
    # One task gathers only the counts of a report or the ends of a spine.
    gathered = {"expectation_report": 3, "date_spine": 1}
    assert text.count("SinglePartition") == gathered.get(name, 0)


def test_entry(spark):
    assert entry_points.entry(spark).columns[0] == "acquisition_channel"
