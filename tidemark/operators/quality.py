"""Named data-quality rules: count violations, optionally drop them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

WARN = "warn"
DROP = "drop"


@dataclass(frozen=True)
class Rule:
    """A SQL predicate every row should satisfy. NULL counts as a violation."""

    name: str
    predicate: str
    action: str = WARN

    def passes(self) -> Column:
        return F.coalesce(F.expr(self.predicate), F.lit(False))


def drop_violations(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Keep the rows that pass every rule whose action is drop."""
    for rule in rules:
        if rule.action == DROP:
            df = df.filter(rule.passes())
    return df


def observe_rules(df: DataFrame, rules: list[Rule], observation: Observation) -> DataFrame:
    """Count violations while the data passes by; costs no extra job.

    ``observation.get`` gives {rule name: violations, "rows": rows} once an
    action has run. Only for the frame that is written: the counting node keeps
    filters from moving below it.
    """
    violations = [F.count_if(~rule.passes()).alias(rule.name) for rule in rules]
    return df.observe(observation, F.count(F.lit(1)).alias("rows"), *violations)


def expectation_report(df: DataFrame, dataset: str, rules: list[Rule]) -> DataFrame:
    """One row per rule: (dataset, rule, action, passed, failed), in one pass."""
    counts = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(rule.passes()).alias(rule.name) for rule in rules],
    )
    lines = [
        F.struct(
            F.lit(rule.name).alias("rule"),
            F.lit(rule.action).alias("action"),
            F.col(rule.name).alias("passed"),
            (F.col("rows") - F.col(rule.name)).alias("failed"),
        )
        for rule in rules
    ]
    return counts.select(F.explode(F.array(*lines)).alias("line")).select(
        F.lit(dataset).alias("dataset"), "line.*"
    )
