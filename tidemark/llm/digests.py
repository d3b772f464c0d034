"""Digests of operators' results, as the registered queries return them."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ids_crc32(pieces: DataFrame) -> DataFrame:
    """Adds ids_crc32: of the ids as little-endian unsigned 32-bit numbers; drops ids."""
    kept = [c for c in pieces.columns if c != "ids"]
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema if f.name != "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            flat, ends = ids.values.to_numpy().astype("<u4").tobytes(), ids.offsets.to_pylist()
            sums = [zlib.crc32(flat[4 * a:4 * b]) for a, b in zip(ends, ends[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(sums, pa.int64())],
                                             [*kept, "ids_crc32"])

    return pieces.mapInArrow(run, f"{fields}, ids_crc32 long")


def sha256(text: str) -> Column:
    return F.sha2(F.col(text).cast("binary"), 256)
