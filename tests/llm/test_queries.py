"""The registered queries on training data: against their SQL, and the shape of their plans."""

import re

import pytest
from compare import connect, rows_of

import __spark_entry__ as entry_points
from tidemark.llm import queries

SF = "/root/testdata/sf0.001"
#: Queries that Spark plans without running jobs of its own, so that the plan is the whole work.
ONE_PLAN = ["op2_decontamination", "op3_sentencepiece", "op4_line_dedup", "op6_quality_rules", "op10_html_extraction"]


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_against_sql(spark, name):
    df = entry_points.queries()[name](spark, SF)
    cursor = connect(SF).execute(entry_points.oracle_sql()[name])
    columns = [item[0] for item in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(df.columns, [tuple(row) for row in df.collect()]) == rows_of(columns, cursor.fetchall())


@pytest.mark.parametrize("name", ONE_PLAN)
def test_plan(spark, name):
    """No pair-wise joins, no whole table in one task, and no Python worker where built-in functions do."""
    text = queries.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for operator in ("NestedLoop", "CartesianProduct", "SinglePartition", "CollectLimit"):
        assert operator not in text
    if name in ("op4_line_dedup", "op6_quality_rules"):
        assert not re.search("Python|Arrow|Pandas", text)


def test_each_operator_has_its_query():
    numbers = sorted(int(re.match(r"op(\d+)_", name)[1]) for name in queries.QUERIES)
    assert numbers == list(range(1, len(numbers) + 1))
    assert set(queries.ORACLES) <= set(queries.QUERIES) <= set(entry_points.queries())
    assert "pipeline" in entry_points.queries()
