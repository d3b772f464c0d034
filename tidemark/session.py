"""Session settings and the shared working folder.

Everything the library materialises goes under one folder that all executors
can reach.  On a cluster that folder is named by ``spark.checkpoint.dir``; only
a local-mode session (tests, laptops) may fall back to a folder of its own.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

SHARED_FOLDER_SETTING = "spark.checkpoint.dir"

# Set on every session the library is handed: the time zone for right results,
# run-time planning so that joins with hot keys are split, and timestamps written
# as integers, since the default layout carries no statistics to skip by.
REQUIRED_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}

# Bytes of rows that go to a Python worker at once.  Spark's 64 MB are held by the executor
# in buffers that double, and by the worker, for each of its tasks, beside the heap.
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20


def prepare(spark: SparkSession) -> SparkSession:
    for name, value in REQUIRED_SETTINGS.items():
        if spark.conf.get(name) != value:
            spark.conf.set(name, value)
    return spark


def bound_batches(spark: SparkSession) -> SparkSession:
    """Lower the session's batches to ``BATCH_BYTES``; smaller ones stay as they are."""
    in_bytes = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    if in_bytes(spark.conf.get(BATCH_SETTING)) > BATCH_BYTES:
        spark.conf.set(BATCH_SETTING, BATCH_BYTES)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder for written intermediates, as the session names it."""
    named = spark.conf.get(SHARED_FOLDER_SETTING, None)
    if named:
        return named.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError(f"set {SHARED_FOLDER_SETTING} to a folder all executors can reach")
    own = tempfile.mkdtemp(prefix="tidemark-")
    spark.conf.set(SHARED_FOLDER_SETTING, own)
    return own


_locations: list[str] = []


def fresh_location(spark: SparkSession, name: str) -> str:
    """A location below the shared folder that nothing has written to."""
    location = f"{shared_folder(spark)}/tidemark/{name}-{uuid.uuid4().hex}"
    _locations.append(location)
    return location


def discard_intermediates(spark: SparkSession) -> int:
    """Delete what this process wrote to the shared folder; returns the number of
    locations.  Frames that read them can no longer be run."""
    deleted = 0
    while _locations:
        files, path = file_system(spark, _locations.pop())
        deleted += bool(files.delete(path, True))
    return deleted


def file_system(spark: SparkSession, location: str) -> tuple:
    """The file system of a location, as Spark itself reaches it, and its path."""
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(location)
    return path.getFileSystem(context._jsc.hadoopConfiguration()), path


def materialise(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` once and return a scan of what was written.

    Used where a result feeds several branches: lineage ends at the files, so a
    lost executor costs a re-read and not a recomputation, and each branch
    prunes columns and pushes filters into the scan.
    """
    spark = df.sparkSession
    location = fresh_location(spark, name)
    df.write.partitionBy(*partition_by).parquet(location)
    return spark.read.schema(df.schema).parquet(location)


def concurrently(tasks: dict[str, Callable[[], object]], workers: int = 4) -> dict[str, object]:
    """Run independent Spark actions side by side; the first error is raised.

    Small writes then share the cluster instead of queueing behind each other's
    last tasks.  The threads keep the caller's job group and pool.
    """
    keep = inheritable_thread_target(SparkSession.active())
    with ThreadPoolExecutor(max_workers=max(1, workers)) as pool:
        futures = {name: pool.submit(keep(task)) for name, task in tasks.items()}
        return {name: future.result() for name, future in futures.items()}
