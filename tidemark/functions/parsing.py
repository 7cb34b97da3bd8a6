"""Parsing that yields null instead of failing the job under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructType

# The timestamp formats of the events feed, tried in this order.
# XXX reads a literal Z as offset zero, so it covers both ISO forms.
TIMESTAMP_FORMATS = ["yyyy-MM-dd'T'HH:mm:ssXXX", "yyyy-MM-dd HH:mm:ss"]
DATE_FORMAT = "yyyy-MM-dd"


def parse_timestamp(text: Column) -> Column:
    """First format that fits; null when none does."""
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(fmt)) for fmt in TIMESTAMP_FORMATS])


def parse_date(text: Column) -> Column:
    return F.try_to_date(text, DATE_FORMAT)


def parse_double(value: Column) -> Column:
    return value.try_cast("double")


def json_fields(line: Column) -> Column:
    """The fields of a JSON object as a map of texts, repeated keys included; null for anything else.

    Nested values stay JSON text. Select it under a name before using it, so that each line
    is parsed once.
    """
    return F.from_json(line, "map<string,string>")


def columns_of_fields(entries: str, line: Column, fields: StructType) -> list[Column]:
    """Columns of ``fields`` from the map ``entries``, plus ``_rescued_data`` and ``_extra_fields``.

    ``_rescued_data`` holds the whole line when it is no JSON object or when a number field
    holds something that is no number; quoted numbers are numbers. ``_extra_fields`` holds
    every key and value that no column took, in their order: keys the schema does not know,
    and all but the last value of a repeated key.
    """
    found, keys = F.col(entries), F.map_keys(entries)
    repeated = F.size(F.array_distinct(keys)) < F.size(keys)

    def last(name: str) -> Column:
        same = F.filter(F.map_entries(found), lambda e: e["key"] == name)
        return F.when(repeated, F.try_element_at(same, F.lit(-1))["value"]).otherwise(found[name])

    columns, mismatch = [], F.lit(False)
    for field in fields:
        value = last(field.name)
        if isinstance(field.dataType, DoubleType):
            number = parse_double(value)
            mismatch = mismatch | (value.isNotNull() & number.isNull())
            value = number
        columns.append(value.alias(field.name))

    known = F.array(*[F.lit(name) for name in fields.fieldNames()])
    is_last = lambda key, i: F.size(keys) - F.array_position(F.reverse(keys), key) == i
    extra = F.filter(
        F.map_entries(found),
        lambda e, i: ~(F.array_contains(known, e["key"]) & is_last(e["key"], i)),
    )
    unusual = repeated | (F.size(F.array_except(keys, known)) > 0)
    return columns + [
        F.when(found.isNull() | mismatch, line).alias("_rescued_data"),
        F.when(unusual, extra).alias("_extra_fields"),
    ]


#: Cells of a CSV row that are told apart; a longer row is rescued whole.
CELLS = 32
_END = "\x01end"


def with_cells(df: DataFrame, line: str, cells: str) -> DataFrame:
    """Add the cells of the CSV line in ``line`` as an array, empty ones null; null if it is none.

    A mark is put behind the line before it is parsed: where it comes out tells a row with
    empty cells from a shorter one, and quotes left open swallow it. Each line is parsed once.
    """
    schema = ", ".join(f"c{i} string" for i in range(CELLS + 1))
    parsed = F.from_csv(F.concat(F.col(line), F.lit("," + _END)), F.lit(schema))
    found = F.array(*[F.col("_csv")[f"c{i}"] for i in range(CELLS + 1)])
    length = F.array_position(cells, _END).cast("int") - 1
    kept = F.when(length > 0, F.slice(cells, F.lit(1), length))
    return df.withColumn("_csv", parsed).withColumn(cells, found).withColumn(cells, kept).drop("_csv")


def columns_by_header(cells: str, header: str, line: Column, fields: StructType) -> list[Column]:
    """Columns of ``fields`` by their place in the ``header`` cells, plus what no column took.

    ``_rescued_data`` holds the line of a row with more or fewer cells than the header, or of
    one that is no CSV; ``_extra_fields`` the cells under other names, or beyond the header
    (``_c`` and their number from 1), in their order, empty ones apart.
    """
    row, names = F.col(cells), F.col(header)
    at = {field.name: F.array_position(names, field.name).cast("int") for field in fields}
    columns = [
        F.when(at[field.name] > 0, F.try_element_at(row, F.nullif(at[field.name], F.lit(0)))).alias(field.name)
        for field in fields
    ]
    named = F.transform(
        row,
        lambda cell, i: F.struct(
            F.coalesce(F.get(names, i), F.concat(F.lit("_c"), (i + 1).cast("string"))).alias("key"), cell.alias("value")
        ),
    )
    first = lambda key, i: F.array_position(names, key) == i + 1
    known = F.array(*[F.lit(field.name) for field in fields])
    extra = F.filter(
        named, lambda e, i: e["value"].isNotNull() & ~(F.array_contains(known, e["key"]) & first(e["key"], i))
    )
    return columns + [
        F.when(row.isNull() | (F.size(row) != F.size(names)), line).alias("_rescued_data"),
        F.when(F.size(extra) > 0, extra).alias("_extra_fields"),
    ]
