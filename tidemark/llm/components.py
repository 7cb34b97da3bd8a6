"""Connected components of stored edges, by hooking to smaller neighbours and contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import shared_folder


def stored(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read again: its lineage ends there."""
    folder = shared_folder(df.sparkSession)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def components(edges: DataFrame) -> DataFrame:
    """(vertex, label) of every vertex in ``edges`` (a, b): the least vertex it reaches.

    In each round every vertex with a smaller neighbour hooks to the least one, takes one
    step further along what that one hooks to, and edges are carried over to where their ends
    went. Edges whose ends meet vanish; when none is left, each component has one name.
    Rounds grow with the logarithm of a component's width. Each is stored: no lineage grows.
    """
    both = edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct()
    left = stored(both)
    labels = left.select(F.col("a").alias("vertex"), F.col("a").alias("label")).distinct()
    while not left.isEmpty():
        hooks = stored(left.groupBy("a").agg(F.min("b").alias("to")).where("to < a"))
        next_hook = hooks.select(F.col("a").alias("to"), F.col("to").alias("further"))
        jumps = hooks.join(next_hook, "to", "left").select("a", F.coalesce("further", "to").alias("to"))
        moved_b = left.join(jumps.withColumnRenamed("a", "b"), "b", "left").select(
            "a", F.coalesce("to", "b").alias("b")
        )
        moved = moved_b.join(jumps, "a", "left").select(F.coalesce("to", "a").alias("a"), "b")
        labels = stored(
            labels.join(jumps.withColumnRenamed("a", "label"), "label", "left").select(
                "vertex", F.coalesce("to", "label").alias("label")
            )
        )
        left = stored(moved.where("a <> b").distinct())
    return labels
