"""Labelled documents: which teach, and a bounded sample of them with their texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import id_and_text


def held_out(doc_id: Column) -> Column:
    """Whether a row is kept from training: crc32 of its id as text is a multiple of 5."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def sample(
    docs: DataFrame, labels: DataFrame, label: str, most: int, id_col: str = "doc_id", text_col: str = "text"
) -> tuple[DataFrame, float]:
    """(doc_id, label, text) of at most ``most`` documents of each label, and the share of label 1.

    Documents are taken in the order of a hash of their ids, none of them held out. Rows
    without an id, without a label of 0 or 1, or with contradicting labels teach nothing. Of
    several texts under one id the one with the least hash teaches. The share is that of all
    labelled documents that could teach.
    """
    key, value = F.col("doc_id"), F.col(f"`{label}`")
    known = (
        labels.where(key.isNotNull() & value.isin(0, 1) & ~held_out(key))
        .groupBy("doc_id")
        .agg(F.min(value).alias("label"), F.max(value).alias("other"))
        .where("label = other")
        .select(key.cast("long").alias("doc_id"), F.col("label").cast("int").alias("label"))
    )
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    first = [known.where(F.col("label") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most) for y in (0, 1)]
    chosen = first[0].union(first[1])
    texts = (
        id_and_text(docs, id_col, text_col)
        .join(F.broadcast(chosen), "doc_id")  # at most 2 x most ids
        .groupBy("doc_id", "label")
        .agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
    )
    return texts, counts.get(1, 0) / max(1, sum(counts.values()))
