"""Bounded-space online packing of token sequences into windows of fixed length.

Each partition keeps a fixed number of open windows.  A document longer than a
window is cut into full windows first; what is left goes into the open window it
fits best.  When none fits, the fullest window is emitted, filled up with the head
of the document where the gap is worth a cut, and a new one opened.  At the end
of a partition its open windows are leftovers: the leftovers of a fixed number of
neighbouring partitions are merged in one group, whose size is bounded by the
window length, the number of open windows and that number of partitions.

Partitions are those of the scan, so texts are not shuffled; only leftovers are.
What the partitions gave is written to the shared folder before the merge, so
sequence ids do not change when a task is run again.

Null text counts as empty: such a document is its end token alone.  Rows that
repeat are packed one by one.  Of other columns none is read, whatever its name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bpe import Encoder, vocabulary
from tidemark.llm.common import Scratch, lists, slices

PIECE = "doc_id {kind}, start long, length long, doc_tokens long, sequence_id long, offset long, ids array<int>"
NAMES = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
MERGED_PARTITIONS = 16
# Bytes of text encoded at once: windows and pieces are held beside them.
SLICE = 1_000_000


class Window:
    def __init__(self, size: int) -> None:
        self.free, self.pieces = size, []

    def add(self, doc: object, start: int, total: int, ids: np.ndarray) -> None:
        self.pieces.append((doc, start, total, ids))
        self.free -= len(ids)


class Packer:
    """The open windows of one partition.  ``closed`` holds emitted windows."""

    def __init__(self, size: int, open_windows: int, least_cut: int) -> None:
        self.size, self.most, self.least_cut = size, open_windows, least_cut
        self.open: list[Window] = []
        self.closed: list[Window] = []

    def place(self, doc: object, ids: np.ndarray) -> None:
        start, total = 0, len(ids)
        while total - start > self.size:
            start = self._fill(Window(self.size), doc, start, ids)
        while start < total:
            need = total - start
            fitting = [w for w in self.open if w.free >= need]
            if fitting:
                window = min(fitting, key=lambda w: w.free)
                start = self._fill(window, doc, start, ids)
            elif len(self.open) < self.most:
                self.open.append(Window(self.size))
            else:
                fullest = min(self.open, key=lambda w: w.free)
                if fullest.free >= self.least_cut:
                    start = self._fill(fullest, doc, start, ids)
                else:
                    self.open.remove(fullest)
                    self.closed.append(fullest)

    def _fill(self, window: Window, doc: object, start: int, ids: np.ndarray) -> int:
        end = min(len(ids), start + window.free)
        window.add(doc, start, len(ids), ids[start:end])
        if not window.free:
            if window in self.open:
                self.open.remove(window)
            self.closed.append(window)
        return end


def merge(windows: list[Window], least_cut: int) -> list[Window]:
    """Pour the emptiest windows into the fullest until one is left to pour.  A piece
    is cut where the gap is worth it; other gaps stay."""
    order = sorted(windows, key=lambda w: w.free)
    done: list[Window] = []
    while len(order) > 1:
        fullest = order[0]
        if not fullest.free:
            done.append(order.pop(0))
            continue
        source = order[-1]
        doc, start, total, ids = source.pieces.pop()
        take = len(ids) if len(ids) <= fullest.free else fullest.free
        if take < len(ids) and take < least_cut:
            source.pieces.append((doc, start, total, ids))
            done.append(order.pop(0))
            continue
        fullest.add(doc, start, total, ids[:take])
        source.free += take
        if take < len(ids):
            source.pieces.append((doc, start + take, total, ids[take:]))
        elif not source.pieces:
            order.pop()
    return done + order


def batch_of(windows: list[Window], first_id: int, kind: pa.DataType) -> pa.RecordBatch:
    rows = [(doc, start, len(ids), total, first_id + i, sum(len(p[3]) for p in w.pieces[:k]) if k else 0, ids)
            for i, w in enumerate(windows) for k, (doc, start, total, ids) in enumerate(w.pieces)]
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 7
    flat = np.concatenate(columns[6]) if rows else np.array([], np.int32)
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[0], kind), *(pa.array(c, pa.int64()) for c in columns[1:6]),
         lists(flat, [len(i) for i in columns[6]], pa.int32())], NAMES)


def pack(docs: DataFrame, path: str, window: int = 2048, open_windows: int = 32, end_token: int = 1,
         least_cut: int = 64, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Rows, one per piece: doc_id, start and length (tokens of its document), doc_tokens,
    sequence_id, offset (in its sequence, gapless from 0), ids.

    ``path`` names the vocabulary file; ``end_token`` follows every document;
    ``least_cut`` is the smallest gap for which a document is cut.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    scratch = Scratch(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, packer = Encoder(vocabulary(path)), Packer(window, open_windows, least_cut)
        number = TaskContext.get().partitionId() << 32
        id_type = None
        for batch in batches:
            id_type = batch.schema.field("doc_id").type
            for part in slices(batch, "text", SLICE):
                flat, counts = encoder.encode(part.column("text"))
                at = 0
                for doc, count in zip(part.column("doc_id").to_pylist(), counts, strict=True):
                    packer.place(doc, np.append(flat[at:at + count], np.int32(end_token)))
                    at += count
                yield flagged(batch_of(packer.closed, number, id_type), False)
                number += len(packer.closed)
                packer.closed = []
        if id_type is not None:
            yield flagged(batch_of(packer.open, number, id_type), True)

    def flagged(batch: pa.RecordBatch, left: bool) -> pa.RecordBatch:
        return batch.append_column("left", pa.array([left] * batch.num_rows, pa.bool_()))

    def merge_group(table: pa.Table) -> pa.Table:
        windows: dict[int, Window] = {}
        for row in table.sort_by([("sequence_id", "ascending"), ("offset", "ascending")]).to_batches():
            for doc, start, total, sequence, ids in zip(
                    *(row.column(c).to_pylist() for c in ("doc_id", "start", "doc_tokens", "sequence_id")),
                    row.column("ids"), strict=True):
                windows.setdefault(sequence, Window(window)).add(doc, start, total, ids.values.to_numpy())
        merged = merge([windows[k] for k in sorted(windows)], least_cut)
        return pa.Table.from_batches([batch_of(merged, min(windows), table.schema.field("doc_id").type)])

    placed = scratch.write(
        docs.select(F.col(id_column).alias("doc_id"), F.coalesce(text_column, F.lit("")).alias("text"))
        .mapInArrow(run, PIECE.format(kind=kind) + ", left boolean"), "packed")
    leftovers = (placed.where("left").drop("left")
                 .groupBy(F.floor(F.shiftright("sequence_id", 32) / MERGED_PARTITIONS))
                 .applyInArrow(merge_group, PIECE.format(kind=kind)))
    return placed.where("not left").drop("left").unionByName(leftovers)
