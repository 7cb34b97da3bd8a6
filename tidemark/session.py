"""Session settings the datasets rely on."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# For SparkSession.builder.config(map=SETTINGS). The last one stops PySpark from
# recording the call site of every column, which takes longer than planning.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def pin_utc(spark: SparkSession) -> SparkSession:
    """Make dates and weeks mean UTC dates and weeks.

    ``to_date``, ``date_trunc`` and zone-less timestamp texts all read the
    session zone, so it has to be set before a DataFrame is built.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder that every executor can reach.

    The cluster names its shared folder in ``spark.checkpoint.dir``; where that
    is unset, the session's warehouse, which executors share as well, takes its place.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/tidemark-{uuid.uuid4().hex}"
