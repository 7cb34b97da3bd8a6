"""Values of the previous row within a key, without gathering a key in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def with_previous(
    df: DataFrame, key: str, day: str, row_id: str, previous: dict[str, str]
) -> DataFrame:
    """Add, per row, columns of the row before it within ``key``.

    Rows are ordered by ``day``, then by ``row_id``, nulls first; ``previous`` maps
    new names to source columns. Null keys are one key. The order of rows equal in
    all three is not defined.

    A plain ``lag`` would send all rows of a key to one task. Here the rows are laid
    out in segments of about equal size, by bounds that Spark samples over (key, day,
    row_id): a crowded key spreads over many, even if all its rows have one day.
    ``lag`` runs within a segment; the first row of a key in a segment then takes its
    values from the key's last row before it, among first and last rows only. One task
    holds a segment, or two rows of each segment of a key. There is no join: the input
    is computed once.
    """
    order = [F.asc_nulls_first(day), F.asc_nulls_first(row_id)]
    segments = df.repartitionByRange(F.asc_nulls_first(key), *order).withColumn(
        "_segment", F.spark_partition_id()
    )
    within = Window.partitionBy("_segment", key).orderBy(*order)
    rows = segments.withColumns(
        {
            "_first": F.row_number().over(within) == 1,
            "_last": F.lead(F.lit(True)).over(within).isNull(),
        }
        | {name: F.lag(source).over(within) for name, source in previous.items()}
    ).withColumn("_place", F.when(F.col("_first") | F.col("_last"), -1).otherwise(F.col("_segment")))
    # Of a segment there are at most two such rows, the first and the last.
    edges = Window.partitionBy("_place", key).orderBy("_segment", F.desc("_first"))
    return rows.withColumns(
        {
            name: F.when(F.col("_first"), F.lag(source).over(edges)).otherwise(F.col(name))
            for name, source in previous.items()
        }
    ).drop("_segment", "_first", "_last", "_place")
