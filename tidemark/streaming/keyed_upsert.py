"""Continuous keyed upsert of arriving loads.

Arriving files are streamed into a change log by Spark's own file sink, whose
write cost follows the arriving rows and not the table; a file is taken exactly
once per checkpoint.  The table is the latest row per key over the log, and
``fold`` brings a stored base up to date with the loads it has not seen.
Replaying a load is harmless: the same rows win again.  ``start_keyed_merge`` keeps no
log: it merges each micro-batch into a keyed table as a change set.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from tidemark.operators.conform import latest
from tidemark.operators.upsert import upsert_newest
from tidemark.session import materialise
from tidemark.sources.keyed import KeyedLayer
from tidemark.sources.layers import LayerStore

LOAD = "load"


def start_change_stream(spark: SparkSession, landing: str, schema: T.StructType, log: str,
                        checkpoint: str, files_per_trigger: int | None = None) -> StreamingQuery:
    """Stream ``landing/load=<n>/*.parquet`` into the change log and stop when done.

    The schema is fixed; the load number comes from the folder name.
    """
    reader = spark.readStream.schema(with_load(schema))
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return (reader.parquet(landing).writeStream.format("parquet").outputMode("append")
            .option("path", log).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def start_keyed_merge(spark: SparkSession, landing: str, schema: T.StructType, layer: KeyedLayer, table: str,
                      keys: Sequence[str], newest_first: Sequence[str], checkpoint: str,
                      files_per_trigger: int | None = None) -> StreamingQuery:
    """Stream ``landing/load=<n>/*.parquet`` into a keyed table and stop when done.

    Each micro-batch is reduced to its newest row per key, compared with the table's
    rows of these keys and added as a change set: files taken before are not read
    again, and the table is not rewritten.  The query's id and the batch's number go
    into the table's version with the rows, so a batch that Spark repeats after a
    failure changes nothing.  A row that arrives late never replaces a newer one.
    """

    def merge(batch: DataFrame, number: int) -> None:
        metadata = batch.sparkSession.read.text(f"{checkpoint}/metadata").first()[0]
        layer.upsert_newest(table, batch.drop(LOAD) if LOAD not in newest_first else batch, keys, newest_first,
                            stream=(json.loads(metadata)["id"], number))

    reader = spark.readStream.schema(with_load(schema))
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return (reader.parquet(landing).writeStream.foreachBatch(merge)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def with_load(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(LOAD, T.IntegerType())])


def read_log(spark: SparkSession, log: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(with_load(schema)).parquet(log)


def current_rows(log: DataFrame, keys: Sequence[str], event_time: str,
                 newest_event_wins: bool = False) -> DataFrame:
    """The table: by default the last load of a key wins; otherwise its newest
    event does, so that a late older row never replaces a newer one."""
    order = (event_time, LOAD) if newest_event_wins else (LOAD, event_time)
    return latest(log, keys, order)


def fold(store: LayerStore, log: DataFrame, layer: str, table: str, keys: Sequence[str],
         event_time: str, newest_event_wins: bool = False) -> DataFrame:
    """Apply the log files that the stored table has not taken yet.

    Which files it has taken is recorded by name beside it, after the table is
    replaced, so loads may arrive late, twice or in parts: every file is applied,
    and one applied again after a crash changes nothing.  Rows rank by the policy's
    order and not by when they are folded, so a late lower load never replaces a
    higher one unless its event is newer and events decide.
    """
    record = f"{table}__files"
    arrived = log.withColumn("_file", F.col("_metadata.file_path"))
    if store.exists(layer, table) and store.exists(layer, record):
        taken = store.read(layer, record)
        arrived = arrived.join(taken.withColumnRenamed("file", "_file"), "_file", "left_anti")
        if arrived.isEmpty():
            return store.read(layer, table)
    else:
        taken = None
    files = arrived.select(F.col("_file").alias("file")).distinct()
    if taken is not None:
        files = taken.union(files)
    order = (event_time, LOAD) if newest_event_wins else (LOAD, event_time)
    changes = arrived.drop("_file")
    if store.exists(layer, table):
        merged = upsert_newest(store.read(layer, table), changes, keys, order)
    else:
        merged = latest(changes, keys, order)
    files = materialise(files, "folded-files")
    folded = store.replace(merged, layer, table)
    store.replace(files, layer, record)
    return folded
