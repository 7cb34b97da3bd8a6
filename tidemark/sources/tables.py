"""Stored tables in three layers, and generated dimensions.

A table is a folder of numbered versions and, beside them, a manifest for each version that
names the folders it consists of. Rows are written first and the manifest last, by a rename
that never replaces a file, so a reader sees a whole version or the one before. A writer that
was cut short leaves a folder nobody names; the next one writes over it. Readers that have
resolved a version keep its files until ``expire``. One writer at a time is assumed.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

BRONZE, SILVER, GOLD = "bronze", "silver", "gold"
_NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class Snapshot:
    """One version of a table: its columns, the folders it consists of, and notes of its writer."""

    version: int
    schema: StructType
    partition_by: tuple[str, ...] = ()
    parts: tuple[str, ...] = ()
    notes: dict = field(default_factory=dict)

    def text(self) -> str:
        return json.dumps(
            {
                "version": self.version,
                "schema": self.schema.jsonValue(),
                "partition_by": self.partition_by,
                "parts": self.parts,
                "notes": self.notes,
            }
        )

    @staticmethod
    def parse(text: str) -> Snapshot:
        found = json.loads(text)
        return Snapshot(
            found["version"],
            StructType.fromJson(found["schema"]),
            tuple(found["partition_by"]),
            tuple(found["parts"]),
            found["notes"],
        )


class _Files:
    """What tables need of the file system that a path lies on, whichever Hadoop client serves it."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.jvm, self.gateway = spark._jvm, spark.sparkContext._gateway
        self.hadoop = self.jvm.org.apache.hadoop.fs
        self.configuration = spark._jsc.hadoopConfiguration()
        self.system = self.hadoop.Path(path).getFileSystem(self.configuration)

    def names(self, path: str) -> list[str]:
        if not self.exists(path):
            return []
        return sorted(status.getPath().getName() for status in self.system.listStatus(self.hadoop.Path(path)))

    def exists(self, path: str) -> bool:
        return self.system.exists(self.hadoop.Path(path))

    def read(self, path: str) -> str:
        stream = self.system.open(self.hadoop.Path(path))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, path: str, text: str) -> None:
        """Make a file at once with all its text; fails if it is there."""
        made, wanted = self.hadoop.Path(f"{path}.writing"), self.hadoop.Path(path)
        stream = self.system.create(made, True)
        stream.write(bytearray(text.encode()))
        stream.close()
        context = self.hadoop.FileContext.getFileContext(self.system.getUri(), self.configuration)
        never_replace = self.gateway.new_array(self.hadoop.Options.Rename, 0)
        context.rename(context.makeQualified(made), context.makeQualified(wanted), never_replace)

    def delete(self, path: str) -> None:
        self.system.delete(self.hadoop.Path(path), True)


@dataclass(frozen=True)
class Warehouse:
    """Tables ``<root>/<layer>/<name>`` in Parquet, on storage all executors share."""

    spark: SparkSession
    root: str

    def path(self, layer: str, name: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{name}"

    # ── versions ─────────────────────────────────────────────────────────────

    def snapshot(self, layer: str, name: str, version: int | None = None) -> Snapshot | None:
        """The table's latest version, or the given one; None before the first."""
        table = self.path(layer, name)
        files = _Files(self.spark, table)
        found = [int(n.removesuffix(".json")) for n in files.names(f"{table}/_manifests") if n.endswith(".json")]
        if version is None:
            version = max(found, default=0)
        if version not in found:
            return None
        return Snapshot.parse(files.read(f"{table}/_manifests/{version:08d}.json"))

    def _write(self, df: DataFrame, layer: str, name: str, partition_by: tuple[str, ...]) -> tuple[int, list[str]]:
        """Write rows as the folder of the next version; its number, and its parts."""
        latest = self.snapshot(layer, name)
        version = latest.version + 1 if latest else 1
        data = f"{self.path(layer, name)}/data"
        part = f"_version={version}"
        if partition_by:
            df = df.hint("rebalance", *partition_by)
        df.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{data}/{part}")
        files = _Files(self.spark, data)
        parts = [part]
        for _ in partition_by:
            parts = [f"{p}/{n}" for p in parts for n in files.names(f"{data}/{p}") if "=" in n]
        return version, parts

    def _commit(self, layer: str, name: str, snapshot: Snapshot) -> None:
        table = self.path(layer, name)
        _Files(self.spark, table).create(f"{table}/_manifests/{snapshot.version:08d}.json", snapshot.text())

    def declare(self, layer: str, name: str, schema: StructType) -> None:
        """Make the table exist, empty, or give the one there is these columns.

        Files of older versions are read under the new columns: by name, null where they lack one.
        """
        latest = self.snapshot(layer, name)
        if latest is None:
            self._commit(layer, name, Snapshot(1, schema))
        elif latest.schema != schema:
            changed = Snapshot(latest.version + 1, schema, latest.partition_by, latest.parts, latest.notes)
            self._commit(layer, name, changed)

    def save(
        self,
        df: DataFrame,
        layer: str,
        name: str,
        partition_by: tuple[str, ...] = (),
        notes: dict | None = None,
    ) -> DataFrame:
        """Replace the table and return it as stored; ``df`` may read the table itself.

        A partitioned write rebalances on the partition columns first: few files
        per partition, and a crowded partition still gets several writers.
        """
        version, parts = self._write(df, layer, name, partition_by)
        self._commit(layer, name, Snapshot(version, df.schema, partition_by, tuple(parts), notes or {}))
        return self.read(layer, name)

    def append(self, df: DataFrame, layer: str, name: str, notes: dict | None = None) -> None:
        """Add rows to the table, whose columns stay; it is made if need be."""
        latest = self.snapshot(layer, name) or Snapshot(0, df.schema)
        version, parts = self._write(df, layer, name, latest.partition_by)
        grown = (*latest.parts, *parts)
        self._commit(layer, name, Snapshot(version, latest.schema, latest.partition_by, grown, latest.notes | (notes or {})))

    def replace_days(self, df: DataFrame, layer: str, name: str, days: Iterable[dt.date | None], notes: dict | None = None) -> None:
        """Put ``df`` in the place of the partitions of ``days``; all others stay as they are.

        For tables partitioned by one date column. ``df`` has rows of these days only.
        """
        latest = self.snapshot(layer, name)
        (column,) = latest.partition_by
        gone = {f"{column}={day or _NULL_PARTITION}" for day in days}
        version, parts = self._write(df, layer, name, latest.partition_by)
        kept = [p for p in latest.parts if p.rsplit("/", 1)[-1] not in gone]
        new = Snapshot(version, latest.schema, latest.partition_by, (*kept, *parts), latest.notes | (notes or {}))
        self._commit(layer, name, new)

    def expire(self, layer: str, name: str, keep: int = 2) -> None:
        """Delete the files that none of the latest ``keep`` versions names, and older manifests."""
        table = self.path(layer, name)
        latest = self.snapshot(layer, name)
        if latest is None:
            return
        files = _Files(self.spark, table)
        numbers = sorted(int(n.removesuffix(".json")) for n in files.names(f"{table}/_manifests") if n.endswith(".json"))
        kept = [self.snapshot(layer, name, n) for n in numbers[-keep:]]
        named = {p for s in kept for p in s.parts}
        for folder in files.names(f"{table}/data"):
            inside = {p for p in named if p.split("/")[0] == folder}
            if not inside:
                files.delete(f"{table}/data/{folder}")
            elif folder not in inside:
                for leaf in files.names(f"{table}/data/{folder}"):
                    if "=" in leaf and not any(f"{p}/".startswith(f"{folder}/{leaf}/") for p in inside):
                        files.delete(f"{table}/data/{folder}/{leaf}")
        for number in numbers[:-keep]:
            files.delete(f"{table}/_manifests/{number:08d}.json")

    # ── reading ──────────────────────────────────────────────────────────────

    def read(self, layer: str, name: str) -> DataFrame:
        """The table as of now; a version committed later does not change the frame."""
        latest = self.snapshot(layer, name)
        if latest is None:
            raise FileNotFoundError(f"there is no table {layer}.{name} in {self.root}")
        return self._read(layer, name, latest, latest.parts)

    def added_since(self, layer: str, name: str, version: int) -> DataFrame | None:
        """Rows appended after a version; None where rows were replaced since, or it is gone."""
        old, latest = self.snapshot(layer, name, version), self.snapshot(layer, name)
        if old is None or latest is None or latest.parts[: len(old.parts)] != old.parts:
            return None
        return self._read(layer, name, latest, latest.parts[len(old.parts) :])

    def _read(self, layer: str, name: str, snapshot: Snapshot, parts: tuple[str, ...]) -> DataFrame:
        if not parts:
            return self.spark.createDataFrame([], snapshot.schema)
        data = f"{self.path(layer, name)}/data"
        reader = self.spark.read.schema(snapshot.schema)
        if snapshot.partition_by:  # so that their values are read from the folders' names
            reader = reader.option("basePath", data)
        return reader.parquet(*[f"{data}/{part}" for part in parts]).select(*[f"`{c}`" for c in snapshot.schema.names])

    def register_view(self, layer: str, name: str) -> None:
        """Make a stored table available to ``spark.sql`` under its own name."""
        self.read(layer, name).createOrReplaceTempView(name)

    def register_table(
        self, layer: str, name: str, comment: str = "", properties: dict[str, str] | None = None
    ) -> None:
        """Enter the table's version of now in the catalog as ``layer.name``.

        A table of several versions' parts is stored as one first. Register it again after a
        write; files the catalog names go with ``expire``.
        """
        latest = self.snapshot(layer, name)
        if len({part.split("/")[0] for part in latest.parts}) != 1:
            self.save(self.read(layer, name), layer, name, latest.partition_by, latest.notes)
            latest = self.snapshot(layer, name)
        folder = f"{self.path(layer, name)}/data/{latest.parts[0].split('/')[0]}"
        full_name = f"`{layer}`.`{name}`"
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{layer}`")
        self.spark.sql(f"DROP TABLE IF EXISTS {full_name}")
        self.spark.catalog.createTable(full_name, path=folder, source="parquet", description=comment)
        for key, value in (properties or {}).items():
            self.spark.sql(
                f"ALTER TABLE {full_name} SET TBLPROPERTIES (:key = :value)",
                args={"key": key, "value": value},
            )
        if any(column.isPartition for column in self.spark.catalog.listColumns(full_name)):
            self.spark.catalog.recoverPartitions(full_name)


def date_spine(spark: SparkSession, start: dt.date, as_of: dt.date) -> DataFrame:
    """Every day from ``start`` to ``as_of`` in ``spine_date``."""
    if start > as_of:
        raise ValueError(f"the spine starts on {start}, after its end {as_of}")
    days = F.sequence(F.lit(start), F.lit(as_of), F.expr("INTERVAL 1 DAY"))
    return spark.range(1).select(F.explode(days).alias("spine_date"))


def spine_of(df: DataFrame, first: Column, last: Column) -> DataFrame:
    """Every day from the least ``first`` to the greatest ``last`` of the rows, in ``spine_date``.

    One aggregate inside the plan feeds the generator: no trip to the driver. Without rows
    that have both, or where the ends are in the wrong order, there are no days.
    """
    ends = df.agg(F.min(first).alias("first"), F.max(last).alias("last"))
    days = F.explode(F.sequence("first", "last", F.expr("INTERVAL 1 DAY")))
    return ends.where("first <= last").select(days.alias("spine_date"))
