"""What several operators share: written intermediates, text batches, components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import file_system, fresh_location


class Scratch:
    """Tables written to the shared folder during one call, dropped one by one.

    Lineage ends at the files.  Whatever the returned frame still reads stays until
    the session's owner clears the folder.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self._places: dict[int, str] = {}

    def write(self, df: DataFrame, name: str) -> DataFrame:
        place = fresh_location(self.spark, name)
        df.write.parquet(place)
        kept = self.spark.read.schema(df.schema).parquet(place)
        self._places[id(kept)] = place
        return kept

    def drop(self, kept: DataFrame) -> None:
        files, path = file_system(self.spark, self._places.pop(id(kept)))
        files.delete(path, True)


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def slices(batch: pa.RecordBatch, column: str, limit: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """``batch`` in slices of at most ``limit`` bytes of ``column`` (one row at least),
    so that what Python builds for a slice is bounded whatever the texts' lengths."""
    values = batch.column(column)
    first, held = 0, 0
    for row, size in enumerate(pc.fill_null(pc.binary_length(values), 0).to_pylist()):
        if held and held + size > limit:
            yield batch.slice(first, row - first)
            first, held = row, 0
        held += size
    if first < len(values):
        yield batch.slice(first)


def lists(flat: np.ndarray, lengths: list[int], kind: pa.DataType) -> pa.ListArray:
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, kind))


def held(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Adds a column that is computed once a row.  A plain column may be written into the
    lambdas that use it, and is then computed for each of their elements; a generator
    stays where it is."""
    return df.withColumn(name, F.explode(F.array(value)))


def likely_members(df: DataFrame, key: str, members: DataFrame, most_bits: int = 1 << 26) -> DataFrame:
    """Adds ``likely`` to the rows of ``df``: true wherever ``key`` is one of the keys in the
    only column of ``members``, and for few others; null keys are never members.

    Spark packs hashes of the keys into bitmaps of 4 kB, at most ``most_bits`` bits in all
    (8 MB), so what is broadcast has a fixed bound.  Rows that cannot be members then need
    not be shuffled to find that out; beyond the bound more rows pass, never fewer.
    """
    keys = members.select(F.col(members.columns[0]).alias("member")).where("member is not null")
    bits = min(most_bits, max(1 << 15, 1 << (32 * max(1, keys.count()) - 1).bit_length()))
    place = lambda column: F.pmod(F.xxhash64(F.col(column)), F.lit(bits))
    bitmaps = (keys.select(place("member").alias("place"))
               .groupBy(F.expr("bitmap_bucket_number(place)").alias("_bucket"))
               .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(place))").alias("_bitmap")))
    marked = df.withColumn("_place", place(key)).withColumn("_bucket", F.expr("bitmap_bucket_number(_place)"))
    joined = marked.join(F.broadcast(bitmaps), "_bucket", "left")
    byte = "conv(hex(substring(_bitmap, cast(bitmap_bit_position(_place) / 8 as int) + 1, 1)), 16, 10)"
    return joined.select(*df.columns, F.expr(
        f"coalesce(shiftright(cast({byte} as int), cast(bitmap_bit_position(_place) % 8 as int)) & 1, 0) = 1 and {key} is not null"
    ).alias("likely"))


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """Connected components of undirected ``edges`` (a, b): rows (node, root), root
    the smallest node reachable.  Nodes without edges are not in the result.

    Alternating large and small stars: each round every node passes its smallest
    neighbour on to the others, as joins on aggregated minima.  No node's
    neighbours are ever gathered, so a hub with a third of all edges costs only
    its join partition, which adaptive execution splits.  The number of rounds
    grows with the logarithm of the longest path.  Each round is written to the
    shared folder and the one before it deleted.
    """
    current = scratch.write(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    while True:
        both = current.union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = scratch.write(
            both.where("v > u").join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = scratch.write(
            large.join(least, "u")
            .select(F.explode(F.array(F.struct("u", F.col("m").alias("v")),
                                      F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v").where("u <> v").distinct(), "small-star")
        scratch.drop(large)
        settled = small.count() == current.count() and small.exceptAll(current).isEmpty()
        scratch.drop(current)
        current = small
        if settled:
            return current.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                current.select(F.col("v"), F.col("v"))).distinct()
