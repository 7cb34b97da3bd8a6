"""Ordered rules that name what is wrong with a row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# (reason, condition under which a row is bad). A condition may be null only for
# rows that an earlier rule catches.
Rules = list[tuple[str, Column]]


def first_reason(rules: Rules) -> Column:
    """Name of the first rule whose condition holds, null for a clean row."""
    return F.coalesce(*[F.when(bad, F.lit(name)) for name, bad in rules])


def is_clean(rules: Rules) -> Column:
    """True for exactly the rows without a reason.

    A plain conjunction, unlike "reason is null", reaches the parquet scan.
    """
    return reduce(lambda left, right: left & right, [~bad for _, bad in rules])
