"""Bronze ingest: each file is read once, however often the ingest runs."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.parsing import (
    columns_by_header,
    columns_of_fields,
    json_fields,
    with_cells,
)
from tidemark.schemas import BRONZE_TABLES, EVENT_FIELDS, MARKETING_FIELDS
from tidemark.sources.files import stamp
from tidemark.sources.tables import BRONZE, Warehouse

EVENTS_GLOB = "events*.ndjson"
MARKETING_GLOB = "marketing_spend*.csv"
# A large backlog is taken in several batches, each committed on its own.
FILES_PER_BATCH = 10_000


def stream_lines(
    spark: SparkSession, src: str, glob: str, files_per_batch: int = FILES_PER_BATCH
) -> DataFrame:
    """Stream of the lines in the files of ``src`` whose names match, with file and place."""
    reader = spark.readStream.option("pathGlobFilter", glob).option(
        "maxFilesPerTrigger", files_per_batch
    )
    return reader.text(src).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        (F.col("_metadata.file_block_start") == 0).alias("in_first_block"),
    )


def parse_event_lines(lines: DataFrame) -> DataFrame:
    """Typed events from text lines in ``value``; unusable lines are rescued."""
    parsed = lines.filter(F.trim("value") != "").select(
        "value", json_fields(F.col("value")).alias("_fields")
    )
    return parsed.select(*columns_of_fields("_fields", F.col("value"), EVENT_FIELDS))


def parse_marketing_lines(lines: DataFrame) -> DataFrame:
    """Spend rows from the lines of CSV files in ``value``, each file by its own header.

    The header is the first line of a file; its names may stand in any order, some may be
    missing, others added. A file whose first line holds none of the known names has no
    header: its columns are taken by position. Lines equal to the header are no rows.

    The headers, a line for each file of a batch (``FILES_PER_BATCH`` at most), are
    broadcast to the rows, so that a large file stays as split as it was read.
    """
    lines = lines.filter(F.trim("value") != "")
    names = F.array(*[F.lit(field.name) for field in MARKETING_FIELDS])
    clean = F.transform("found", lambda cell: F.lower(F.trim(cell)))
    first_lines = (
        lines.filter("in_first_block")
        .withColumn("at", F.monotonically_increasing_id())  # ascending within a block
        .groupBy("file")
        .agg(F.min_by("value", "at").alias("line"))
        .withColumn("text", F.ltrim(F.col("line"), F.lit("\ufeff")))
    )
    named = F.coalesce(F.arrays_overlap("found", names), F.lit(False))
    headers = (
        with_cells(first_lines, "text", "found")
        .withColumn("found", clean)
        .select("file", F.when(named, F.col("line")).alias("line"), F.when(named, F.col("found")).otherwise(names).alias("header"))
    )
    is_row = F.col("line").isNull() | (F.col("value") != F.col("line"))
    rows = lines.join(F.broadcast(headers), "file").filter(is_row).select("value", "header")
    return with_cells(rows, "value", "cells").select(*columns_by_header("cells", "header", F.col("value"), MARKETING_FIELDS))


def ingest_events(
    tables: Warehouse,
    src: str,
    ingest_ts: dt.datetime | None = None,
    files_per_batch: int = FILES_PER_BATCH,
    glob: str = EVENTS_GLOB,
) -> DataFrame:
    """Append the new event files in ``src`` to the bronze table and return it."""
    lines = stream_lines(tables.spark, src, glob, files_per_batch)
    return append_new(lines, tables, "events_bronze", lambda new: stamp(parse_event_lines(new), ingest_ts))


def ingest_marketing(
    tables: Warehouse,
    src: str,
    ingest_ts: dt.datetime | None = None,
    files_per_batch: int = FILES_PER_BATCH,
    glob: str = MARKETING_GLOB,
) -> DataFrame:
    """Append the new marketing spend files in ``src`` to the bronze table and return it."""
    lines = stream_lines(tables.spark, src, glob, files_per_batch)
    return append_new(lines, tables, "marketing_spend_bronze", lambda new: stamp(parse_marketing_lines(new), ingest_ts))


def append_new(
    stream: DataFrame, tables: Warehouse, name: str, shape: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """Append what the stream has not delivered yet to a bronze table, then stop.

    A checkpoint beside the tables remembers the files already taken. Each batch is one
    version of the table, whose notes name the batch: one that is run again after an
    interruption finds itself there and adds nothing. Without any file the table is empty.
    """
    tables.declare(BRONZE, name, BRONZE_TABLES[name])

    def add(batch: DataFrame, number: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        notes = tables.snapshot(BRONZE, name).notes
        if notes.get("query") != query or notes.get("batch", -1) < number:
            tables.append(shape(batch), BRONZE, name, {"query": query, "batch": number})

    query = (
        stream.writeStream.foreachBatch(add)
        .option("checkpointLocation", tables.path("_checkpoints", name))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return tables.read(BRONZE, name)
