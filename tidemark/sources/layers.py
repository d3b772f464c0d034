"""Layer tables: read by name, replace as a whole, create or merge.

A replaced table is written to a location of its own and the catalog entry is
pointed at it once the write has succeeded.  Readers see the old rows or the
new ones, a plan may read the table it replaces, and a failed or repeated write
leaves nothing half done.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.quality import FLAG
from tidemark.operators.upsert import upsert
from tidemark.session import file_system
from tidemark.sources.keyed import KeyedLayer


@dataclass(frozen=True)
class Buckets:
    """Files hashed by ``column`` into ``number`` buckets; tables bucketed alike
    join on the column without a shuffle."""

    column: str
    number: int


class LayerStore:
    """Tables of the layers ``bronze``, ``silver``, ``gold`` and ``control``.

    ``root`` is a folder every executor can reach; ``namespace`` prefixes the
    database names; ``fmt`` is any file format Spark can write.
    """

    def __init__(self, spark: SparkSession, root: str, namespace: str, fmt: str = "parquet"):
        self.spark = spark
        self.root = root.rstrip("/")
        self.namespace = namespace
        self.fmt = fmt
        self._databases: set[str] = set()

    def name(self, layer: str, table: str) -> str:
        return f"`{self.namespace}_{layer}`.`{table}`"

    def keyed(self, layer: str) -> KeyedLayer:
        """The layer's merged tables, which have no catalog entry."""
        return KeyedLayer(self.spark, f"{self.root}/{layer}/_keyed", self.fmt, buckets=16)

    def read(self, layer: str, table: str) -> DataFrame:
        if not self.cataloged(layer, table):
            keyed = self.keyed(layer).state().tables.get(table)
            if keyed:
                return self.keyed(layer).read(table)
        return self.spark.table(self.name(layer, table))

    def cataloged(self, layer: str, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(layer, table))

    def exists(self, layer: str, table: str) -> bool:
        return self.cataloged(layer, table) or self.keyed(layer).exists(table)

    def count(self, layer: str, table: str) -> int:
        """Row count from the written files, so retried tasks cannot inflate it."""
        return self.read(layer, table).count()

    def stage(self, df: DataFrame, layer: str, table: str,
              partition_by: Sequence[str] = ()) -> str:
        """Write to a new location without touching the catalog.

        Partitioned output is rebalanced on the partition columns first: small
        partitions share a task and a partition with a third of all rows is
        split over many.
        """
        location = f"{self.root}/{layer}/{table}/{uuid.uuid4().hex}"
        if partition_by:
            df = df.hint("rebalance", *[F.col(c) for c in partition_by])
        df.write.format(self.fmt).partitionBy(*partition_by).save(location)
        return location

    def switch(self, layer: str, table: str, schema: T.StructType, location: str,
               partition_by: Sequence[str] = (), buckets: Buckets | None = None) -> None:
        """Point the table at a written location, whatever its schema was before."""
        self._create_database(layer)
        name = self.name(layer, table)
        if not partition_by and not buckets and self._is_plain(layer, table, schema):
            self.spark.sql(f"ALTER TABLE {name} SET LOCATION '{location}'")
            return
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        layout = ""
        if partition_by:
            layout = "PARTITIONED BY (" + ", ".join(f"`{c}`" for c in partition_by) + ")"
        if buckets:
            layout += f" CLUSTERED BY (`{buckets.column}`) INTO {buckets.number} BUCKETS"
        self.spark.sql(
            f"CREATE TABLE {name} ({columns}) USING {self.fmt} {layout} LOCATION '{location}'")
        if partition_by:
            self.spark.sql(f"MSCK REPAIR TABLE {name}")

    def replace(self, df: DataFrame, layer: str, table: str,
                partition_by: Sequence[str] = ()) -> DataFrame:
        location = self.stage(df, layer, table, partition_by)
        self.switch(layer, table, df.schema, location, partition_by)
        return self.read(layer, table)

    def stage_flagged(self, df: DataFrame, layer: str, table: str,
                      buckets: Buckets | None = None, sort_by: str | None = None,
                      by_range: bool = False) -> str:
        """Write valid and quarantined rows in one pass, told apart by folder.

        Files are sorted by ``sort_by`` within each task (no shuffle), so that a
        date range later skips most pages of every file by their statistics.
        ``by_range`` deals the rows to tasks by ranges of ``sort_by`` first, so that a
        date range later has rows in few files and all others are left after their
        footers; it costs a shuffle and a sample.
        Bucketed rows should already be partitioned by the bucket column into as
        many partitions as there are buckets, so that a task writes whole
        buckets and not a piece of each.
        """
        version = uuid.uuid4().hex
        location = f"{self.root}/{layer}/{table}/{version}"
        if not buckets:
            order = [FLAG, sort_by] if sort_by else [FLAG]
            if by_range and sort_by:
                df = df.repartitionByRange(F.col(sort_by))
            df.sortWithinPartitions(*order).write.format(self.fmt).partitionBy(FLAG).save(location)
            return location
        # Spark writes buckets for catalog tables only; the entry goes, the files stay.
        self._create_database(layer)
        entry = self.name(layer, f"staged_{table}_{version}")
        writer = df.write.format(self.fmt).partitionBy(FLAG).bucketBy(
            buckets.number, buckets.column)
        if sort_by:
            writer = writer.sortBy(sort_by)
        writer.option("path", location).saveAsTable(entry)
        self.spark.sql(f"DROP TABLE {entry}")
        return location

    @staticmethod
    def half(location: str, valid: bool) -> str:
        return f"{location}/{FLAG}={str(valid).lower()}"

    def merge(self, changes: DataFrame, layer: str, table: str,
              keys: Sequence[str], check: bool = True, fold_after: int = 16) -> DataFrame:
        """Create the table from the changes, or upsert them by key.

        The changes are written and nothing else; after ``fold_after`` of them the
        buckets they touch are rewritten.  A table made by ``replace`` is replaced.
        """
        if self.cataloged(layer, table):
            return self.replace(upsert(self.read(layer, table), changes, keys, check), layer, table)
        keyed = self.keyed(layer)
        merged = keyed.upsert(table, changes, keys, check)
        if len(keyed.state().tables[table].changes) > fold_after:
            keyed.fold(table)
            merged = keyed.read(table)
        return merged

    def append(self, rows: DataFrame, layer: str, table: str) -> None:
        """Add rows as files of their own.  No writer touches another's folder, so any
        number of them may append at once."""
        rows.write.format(self.fmt).save(f"{self.root}/{layer}/{table}/{time.time_ns():020d}-{uuid.uuid4().hex}")

    def appended(self, layer: str, table: str, schema: T.StructType) -> DataFrame:
        """All appended rows; none if nothing was appended yet."""
        files, folder = file_system(self.spark, f"{self.root}/{layer}/{table}")
        if not files.exists(folder):
            return self.spark.createDataFrame([], schema)
        return (self.spark.read.schema(schema).format(self.fmt).option("recursiveFileLookup", True)
                .load(f"{self.root}/{layer}/{table}"))

    def compact(self, layer: str, table: str, schema: T.StructType) -> int:
        """Put the appended folders there are into one; returns how many there were.  Until
        the old ones are gone a reader may see rows twice, which a reader of the latest row
        per key does not notice; rows appended meanwhile stay where they are."""
        files, folder = file_system(self.spark, f"{self.root}/{layer}/{table}")
        old = [s.getPath() for s in files.listStatus(folder)] if files.exists(folder) else []
        if len(old) < 2:
            return len(old)
        rows = self.spark.read.schema(schema).format(self.fmt).load([p.toString() for p in old])
        self.append(rows.coalesce(1), layer, table)
        for path in old:
            files.delete(path, True)
        return len(old)

    def remove_superseded(self, layer: str, table: str, keep: int = 1) -> int:
        """Delete written locations the table no longer points at.

        Keeps the current one and the ``keep`` newest before it, for readers that
        are still on them; returns the number of folders deleted.
        """
        files, folder = file_system(self.spark, f"{self.root}/{layer}/{table}")
        if not files.exists(folder):
            return 0
        detail = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name(layer, table)}")
        current = detail.filter(F.col("col_name") == "Location").first()["data_type"]
        old = sorted((s for s in files.listStatus(folder)
                      if s.getPath().getName() not in current.split("/")),
                     key=lambda s: s.getModificationTime(), reverse=True)
        for status in old[keep:]:
            files.delete(status.getPath(), True)
        return len(old[keep:])

    def _is_plain(self, layer: str, table: str, schema: T.StructType) -> bool:
        """Whether the table has this schema and neither partitions nor buckets."""
        if not self.exists(layer, table):
            return False
        columns = self.spark.catalog.listColumns(self.name(layer, table))
        if any(c.isPartition or c.isBucket for c in columns):
            return False
        now = self.read(layer, table).schema
        return [(f.name, f.dataType) for f in now] == [(f.name, f.dataType) for f in schema]

    def _create_database(self, layer: str) -> None:
        if layer in self._databases:
            return
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.namespace}_{layer}` "
                       f"LOCATION '{self.root}/{layer}'")
        self._databases.add(layer)
