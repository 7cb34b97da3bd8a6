"""Sums of doubles that are exact, and so do not depend on the order of the rows.

Doubles added in another order give another last digit, which then shows after rounding or
division. Here every amount is a whole number in a bin, and whole numbers are added:

* Amounts that are whole millionths, below a billion, are added as millionths: the bin of
  money as it is usually written, null.
* Any other finite amount is its 53 binary digits at its exponent; a bin for each exponent.
* What is not finite is counted: not a number, plus infinite, minus infinite.

A number is added in three parts of 19 bits, so 2^44 rows fit a bigint. Sums can be merged
and taken back; taking back what was added leaves nothing. Grouping by key and bin first
leaves a row per key for ordinary amounts, and at most one more for each of 2,100 exponents;
``total`` then puts a key's bins together, largest first, in twice the precision of doubles.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_UNITS = 1e6
_LIMIT = 1e9
_BITS = 19
_MASK = (1 << _BITS) - 1
#: The bin of counts of what is not finite; behind all exponents.
_NOT_FINITE = 5000
#: Numbers in a bin have their point this many bits behind the exponent's.
_POINT = 54
PARTS = ("p0", "p1", "p2")


def _is_finite(value: Column) -> Column:
    return F.abs(value) < float("inf")  # NaN is above all


def _is_ordinary(value: Column) -> Column:
    """Whether an amount is whole millionths, below a billion."""
    return (F.abs(value) < _LIMIT) & (F.rint(value * _UNITS) / _UNITS == value)


def _times_two_to(value: Column, power: Column) -> Column:
    """Exact unless it overflows: in two steps, as 2 to the full power may be no double."""
    half = F.floor(power / 2)
    return value * F.pow(F.lit(2.0), half) * F.pow(F.lit(2.0), power - half)


def bin_of(value: Column) -> Column:
    """Where an amount is added up; null for ordinary ones, and for null.

    The logarithm may be off by one: any exponent next to the right one will do.
    """
    exponent = F.floor(F.log2(F.abs(value))).cast("int")
    return F.when(_is_finite(value) & ~_is_ordinary(value), exponent).when(~_is_finite(value), F.lit(_NOT_FINITE))


def parts_of(value: Column) -> dict[str, Column]:
    """The amount's whole number in its bin, in parts to be summed; null for null."""
    of_bin = _times_two_to(value, F.lit(_POINT) - F.floor(F.log2(F.abs(value))))
    number = F.when(_is_ordinary(value), F.rint(value * _UNITS)).otherwise(of_bin).try_cast("bigint")
    infinity = F.lit(float("inf"))
    counts = (F.isnan(value), value == infinity, value == -infinity)
    numbers = (
        number.bitwiseAND(F.lit(_MASK)),
        F.shiftright(number, _BITS).bitwiseAND(F.lit(_MASK)),
        F.shiftright(number, 2 * _BITS),
    )
    return {
        name: F.when(_is_finite(value), whole).when(~_is_finite(value), count.cast("bigint"))
        for name, whole, count in zip(PARTS, numbers, counts)
    }


def _carried(x: Column) -> tuple[Column, Column]:
    """High and low half of a bin's number: the low one has 38 bits, the high one the sign."""
    middle = x["p1"] + F.shiftright(x["p0"], _BITS)
    low = F.shiftleft(middle.bitwiseAND(F.lit(_MASK)), _BITS) + x["p0"].bitwiseAND(F.lit(_MASK))
    return x["p2"] + F.shiftright(middle, _BITS), low


def _millionths(x: Column) -> Column:
    high, low = _carried(x)
    whole = high.cast("decimal(20,0)") * F.lit(1 << 2 * _BITS).cast("decimal(12,0)") + low
    return (whole.cast("decimal(32,0)") * F.lit("0.000001").cast("decimal(6,6)")).cast("double")


def _terms(x: Column) -> Column:
    """A bin's number as doubles that hold it exactly, the largest first."""
    high, low = _carried(x)
    point = x["bin"] - _POINT
    halves = (F.shiftright(high, 31), 31 + 2 * _BITS), (high.bitwiseAND(F.lit((1 << 31) - 1)), 2 * _BITS), (low, 0)
    return F.array(*[_times_two_to(part.cast("double"), point + shift) for part, shift in halves])


def _sum_of_terms(terms: Column) -> Column:
    """Sum of doubles in their order, with what each addition rounds off added in the end."""

    def add(total: Column, x: Column) -> Column:
        s = total["s"] + x
        kept = s - total["s"]
        lost = (total["s"] - (s - kept)) + (x - kept)
        return F.struct(s.alias("s"), (total["c"] + lost).alias("c"))

    zero = F.struct(F.lit(0.0).alias("s"), F.lit(0.0).alias("c"))
    finish = lambda total: F.when(_is_finite(total["s"]), total["s"] + total["c"]).otherwise(total["s"])
    return F.aggregate(terms, zero, add, finish)


def fold(bins: Column) -> Column:
    """The double nearest to what an array of (bin, p0, p1, p2) holds; null if it is empty."""
    ordered = F.reverse(F.array_sort(bins))  # by bin: not finite, exponents from the largest
    ordinary = F.filter(ordered, lambda x: x["bin"].isNull())
    binary = F.filter(ordered, lambda x: x["bin"] < _NOT_FINITE)
    others = F.filter(ordered, lambda x: x["bin"] == _NOT_FINITE)
    found = lambda name: F.coalesce(F.get(others, F.lit(0))[name] > 0, F.lit(False))
    finite = F.coalesce(_millionths(F.get(ordinary, F.lit(0))), F.lit(0.0))
    finite += F.when(F.size(binary) > 0, _sum_of_terms(F.flatten(F.transform(binary, _terms)))).otherwise(0.0)
    return (
        F.when(F.size(bins) == 0, F.lit(None))
        .when(found("p0") | (found("p1") & found("p2")), float("nan"))
        .when(found("p1"), float("inf"))
        .when(found("p2"), -float("inf"))
        .otherwise(finite)
        .cast("double")
    )


def total(prefix: str = "_", bin_column: str = "_bin") -> Column:
    """Sum of a key's bins: an aggregate over the rows of (key, bin) with their summed parts."""
    parts = [F.col(f"{prefix}{name}").alias(name) for name in PARTS]
    entry = F.struct(F.col(bin_column).alias("bin"), *parts)
    return fold(F.collect_list(F.when(F.col(f"{prefix}p0").isNotNull(), entry)))


def exact_sums(
    rows: DataFrame,
    keys: list[str],
    value: Column,
    sums: dict[str, Column | None],
    others: dict[str, tuple[Column, Callable[[Column], Column]]],
    apart: bool = False,
) -> DataFrame:
    """Sums of ``value`` by key, exact whatever the order of the rows, with other aggregates.

    ``sums`` maps names to the condition of the rows that count, None for all; a sum without
    amounts is null. ``others`` maps names to an aggregate over a key's rows of one bin and
    one that puts those of its bins together. Aggregates that can't be put together, such as
    distinct counts, need ``apart``: amounts outside the ordinary bin then go on in rows of
    their own, without any other column but the keys.

    Rows shrink to one per key and bin before the shuffle; the second grouping has about one
    row per key.
    """
    binned = rows.withColumns({"_value": value}).withColumns({"_bin": bin_of(F.col("_value"))})
    flags = {f"_{name}_counts": F.lit(True) if condition is None else condition for name, condition in sums.items()}
    binned = binned.withColumns(flags)
    if apart:
        copies = F.when(F.col("_bin").isNull(), F.array(F.lit(False))).otherwise(F.array(F.lit(False), F.lit(True)))
        own = ["_value", "_bin", *flags]
        split = binned.withColumn("_apart", F.explode(copies))
        usual = {c: F.when(~F.col("_apart"), F.col(c)) for c in rows.columns if c not in keys}
        amounts = {c: F.when(F.col("_bin").isNull() | F.col("_apart"), F.col(c)) for c in own}
        binned = split.withColumns(usual | amounts)
    parts = parts_of(F.col("_value"))
    first = binned.withColumns({f"_{n}": p for n, p in parts.items()}).groupBy(*keys, "_bin").agg(
        *[
            F.sum(F.when(F.col(f"_{name}_counts"), F.col(f"_{n}"))).alias(f"_{name}_{n}")
            for name in sums
            for n in PARTS
        ],
        *[of_bin.alias(name) for name, (of_bin, _) in others.items()],
    )
    return first.groupBy(*keys).agg(
        *[total(f"_{name}_").alias(name) for name in sums],
        *[together(F.col(name)).alias(name) for name, (_, together) in others.items()],
    )
