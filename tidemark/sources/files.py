"""Batch file reads."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.parsing import columns_of_fields, json_fields
from tidemark.schemas import BRONZE_TABLES, SUBSCRIPTION_FIELDS
from tidemark.sources.tables import _Files


def stamp(df: DataFrame, ingest_ts: dt.datetime | None = None) -> DataFrame:
    """Add ``_ingest_timestamp``: now, or the given time for repeatable runs."""
    now = F.current_timestamp() if ingest_ts is None else F.lit(ingest_ts).cast("timestamp")
    return df.withColumn("_ingest_timestamp", now)


def read_subscriptions(
    spark: SparkSession,
    path: str,
    multiline: bool = True,
    ingest_ts: dt.datetime | None = None,
) -> DataFrame:
    """Subscriptions from a JSON file, or a directory of such files.

    With ``multiline`` a file is one JSON document, usually an array of records over many
    lines; its records are told apart by ``json_records``, so a large file is many tasks
    and a damaged record costs no other. Else each line is a record. ``_rescued_data`` holds
    what is no record, ``_extra_fields`` the keys no column took. No file, no rows.
    """
    if not _Files(spark, path).exists(path):
        return stamp(spark.createDataFrame([], BRONZE_TABLES["subscriptions_bronze"]).drop("_ingest_timestamp"), ingest_ts)
    if multiline:
        parsed = json_records(spark, path)
    else:
        lines = spark.read.text(path).filter(F.trim("value") != "")
        parsed = lines.select("value", json_fields(F.col("value")).alias("_fields"))
    return stamp(parsed.select(*columns_of_fields("_fields", F.col("value"), SUBSCRIPTION_FIELDS)), ingest_ts)


_TAIL = r"[\s,\]]*$"


def json_records(spark: SparkSession, path: str) -> DataFrame:
    """The records of multi-line JSON documents in ``value``, one a row; also pieces that are none.

    ``_fields`` has a record's fields as ``json_fields`` does, null for a piece that is none.

    Files are cut in front of every opening brace, by many tasks at once; in a feed of flat
    records, as this one is, a piece is a whole record. Of the pieces that aren't (a brace
    inside a text, a nested object, damage), neighbours are put together in the order of the
    file: only these few rows are gathered, by stretch of neighbours, and a brace that is
    never closed stands apart. What then is one record or more is taken; anything else, such
    as the end of a file that was cut short, is a row as it stands, and the records around it
    are not touched. An array of objects inside
    a record is beyond this: its objects count as records.
    """
    text = F.col("text")
    body = F.regexp_replace(text, _TAIL, "")
    closings = F.length(text) - F.length(F.replace(text, F.lit("}")))
    pieces = (
        spark.read.option("lineSep", "{")
        .text(path)
        .select(
            F.col("value").alias("text"),
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("at"),
        )
        .withColumn("closings", closings)
        .withColumn("value", F.concat(F.lit("{"), body))
        .withColumn(
            "_fields",
            F.when((F.col("closings") == 1) & body.endswith("}") & body.rlike(r'^\s*["}]'), json_fields(F.col("value"))),
        )
        .withColumn("whole", F.col("_fields").isNotNull())
    )
    # Rows are in order within a block; counting them by block numbers those of a file.
    blocks = pieces.groupBy("file", "block").agg(F.count("*").alias("rows"), F.min("at").alias("first"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select("file", "block", (F.coalesce(F.sum("rows").over(before), F.lit(0)) - F.col("first")).alias("offset"))
    others = (
        pieces.filter(~F.col("whole"))
        .join(offsets, ["file", "block"])
        .select("file", (F.col("at") + F.col("offset")).alias("number"), "text", "closings")
        # Before the first record of a file there is no brace.
        .filter(~((F.col("number") == 0) & text.rlike(r"^[\ufeff\s\[\]]*$")))
    )
    nth = F.row_number().over(Window.partitionBy("file").orderBy("number"))
    # A brace that is never closed is damage of its own piece; the others belong together.
    neighbours = Window.partitionBy("file", "stretch").orderBy("number")
    depth = F.sum(1 - F.col("closings")).over(neighbours)
    later = F.min("depth").over(neighbours.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    open_for_good = (later > F.col("depth") - 1 + F.col("closings")).cast("int")
    stretches = (
        others.withColumn("stretch", F.col("number") - nth)
        .withColumn("depth", depth)
        .withColumn("open", open_for_good)
        .withColumn("group", 2 * F.sum("open").over(neighbours) - F.col("open"))
        .groupBy("file", "stretch", "group")
        .agg(F.sort_array(F.collect_list(F.struct("number", "text"))).alias("parts"))
        .select(F.concat_ws("", F.transform("parts", lambda x: F.concat(F.lit("{"), x["text"]))).alias("text"))
        .select(F.regexp_replace("text", _TAIL, "").alias("text"))
        .select("text", F.from_json(F.format_string("[%s]", "text"), "array<map<string,string>>").alias("found"))
    )
    good = (F.size("found") > 0) & F.forall("found", lambda x: x.isNotNull())
    entry = lambda value, fields: F.struct(value.alias("value"), fields.alias("_fields"))
    none = F.array(entry(F.col("text"), F.lit(None).cast("map<string,string>")))
    taken = F.when(good, F.transform("found", lambda x: entry(F.to_json(x), x))).otherwise(none)
    rest = stretches.select(F.explode(taken).alias("x")).select("x.value", "x._fields")
    return pieces.filter("whole").select("value", "_fields").unionByName(rest)
