"""Removal of repeated passages by fixed-block anchors.

A passage of ``window`` words contains, wherever it starts, one of a document's
non-overlapping blocks of (window + 1) / 2 words.  The blocks are indexed; every
rolling window of a block's length probes the index.  A block is an anchor if
another document's block equals it or any window that is no block does.  Each
anchor is extended in both directions to all windows of full length around it, and
windows equal in 96 bits of two independent hashes are grouped: where the group's
smallest document is smaller than the window's own, the window's words go.
Overlapping windows join into maximal repeats.  No pairs of documents are made, so a
passage that thousands share costs a row each.

Probes carry no document, only 32 bits of hash within a bucket, each once per task:
false anchors cost work, never words.  Blocks of hashes are packed by task and
bucket; the number of buckets follows the length of all texts, so a bucket's size
does not.  Texts travel by document, only those with anchors to be extended and only
those with repeats to be cut; a bitmap of fixed size tells most others in the scan.

Words are those between ASCII white space, unchanged.  Null text has no words.  A
document without an id neither removes nor loses any.  Rows with the same id are
documents of equal rank (told apart by 15 bits of a hash of their texts): they do not
remove each other's words, and one row each is
returned.  Other columns are dropped unless named in ``keep``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, likely_members
from tidemark.llm.shingles import mixed, window_hashes, word_hashes

BUCKET_BYTES = 6_000_000
FLUSH = 1_000_000
LOW = np.uint64(0xFFFFFFFF)


def _keys(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket and 32 bits of hash in one number."""
    return (((hashes >> np.uint64(32)) % np.uint64(buckets)) << np.uint64(32)) | (hashes & LOW)


def _starts(ordered: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(ordered) else np.zeros(0, np.int64)


def _cuts(sorted_buckets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    firsts = np.flatnonzero(np.concatenate([[True], sorted_buckets[1:] != sorted_buckets[:-1]]))
    return firsts, sorted_buckets[firsts]


def _distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    return values[np.concatenate([[True], values[1:] != values[:-1]])] if len(values) else values


def _distinct_pairs(keys: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs once each, sorted by key and then document."""
    order = np.lexsort((docs, keys))
    keys, docs = keys[order], docs[order]
    fresh = np.ones(len(keys), bool)
    fresh[1:] = (keys[1:] != keys[:-1]) | (docs[1:] != docs[:-1])
    return keys[fresh], docs[fresh]


def _packed(columns: list[np.ndarray], buckets: np.ndarray) -> dict[int, list[bytes]]:
    """Columns, sorted by bucket, as bytes per bucket."""
    if not len(buckets):
        return {}
    firsts, names = _cuts(buckets)
    parts = [[p.tobytes() for p in np.split(c, firsts[1:])] for c in columns]
    return dict(zip(names.tolist(), map(list, zip(*parts, strict=True)), strict=True))


def _index(source: DataFrame, block: int, buckets: int) -> DataFrame:
    def flush(probes: list, blocks: list, docs: list) -> pa.RecordBatch:
        probed = _distinct(np.concatenate(probes))
        keys, own = _distinct_pairs(np.concatenate(blocks), np.concatenate(docs))
        by_probe = _packed([(probed & LOW).astype(np.uint32)], probed >> np.uint64(32))
        by_block = _packed([(keys & LOW).astype(np.uint32), own], keys >> np.uint64(32))
        names = sorted(by_probe.keys() | by_block.keys())
        return pa.RecordBatch.from_arrays(
            [pa.array(names, pa.int64()), pa.array([by_probe.get(n, [b""])[0] for n in names], pa.binary()),
             *(pa.array([by_block.get(n, [b"", b""])[i] for n in names], pa.binary()) for i in (0, 1))],
            ["bucket", "probes", "blocks", "docs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        probes, blocks, docs, held = [], [], [], 0
        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                keys = _keys(window_hashes(word_hashes((text.as_py() or b"").split()), block), buckets)
                if not len(keys):
                    continue
                is_block = np.arange(len(keys)) % block == 0
                probes.append(keys[~is_block])
                blocks.append(keys[is_block])
                docs.append(np.full(len(blocks[-1]), doc, np.int64))
                held += len(keys)
                if held > FLUSH:
                    yield flush(probes, blocks, docs)
                    probes, blocks, docs, held = [], [], [], 0
        if held:
            yield flush(probes, blocks, docs)

    return source.mapInArrow(run, "bucket long, probes binary, blocks binary, docs binary")


def _joined(table: pa.Table, column: str, kind: type) -> np.ndarray:
    """The cells of a column of packed numbers, one after the other; those of a chunk
    lie so already."""
    parts = []
    for chunk in table.column(column).chunks:
        _, offsets, data = chunk.buffers()
        ends = np.frombuffer(offsets, np.int32)[chunk.offset:chunk.offset + len(chunk) + 1]
        if len(chunk) and ends[-1] > ends[0]:
            parts.append(np.frombuffer(data[int(ends[0]):int(ends[-1])], kind))
    return np.concatenate(parts) if parts else np.zeros(0, kind)


def _anchors(table: pa.Table) -> pa.Table:
    """Blocks of one bucket that another document's block or any other window equals."""
    probes = np.sort(_joined(table, "probes", np.uint32))
    keys, docs = _joined(table, "blocks", np.uint32), _joined(table, "docs", np.int64)
    order = np.argsort(keys)
    keys, docs = keys[order], docs[order]
    starts = _starts(keys)
    several = np.minimum.reduceat(docs, starts) != np.maximum.reduceat(docs, starts) if len(keys) else starts > 0
    if len(probes):
        at = np.minimum(np.searchsorted(probes, keys[starts]), len(probes) - 1)
        several |= probes[at] == keys[starts]
    shared = np.repeat(several, np.diff(np.append(starts, len(keys))))
    keys, docs = _distinct_pairs(keys[shared], docs[shared])
    bucket = np.uint64(table.column("bucket")[0].as_py())
    return pa.table({"doc_id": docs,
                     "anchor": ((bucket << np.uint64(32)) | keys.astype(np.uint64)).view(np.int64)})


def _extended(anchored: DataFrame, window: int, block: int, buckets: int) -> DataFrame:
    """All windows around anchors, packed by task and bucket."""

    def flush(parts: list[tuple]) -> pa.RecordBatch:
        first, second, docs, versions, places = map(np.concatenate, zip(*parts, strict=True))
        bucket = (mixed(first, 9) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        packed = _packed([c[order] for c in (first, second, docs, versions, places)], bucket[order])
        names = sorted(packed)
        return pa.RecordBatch.from_arrays(
            [pa.array(names, pa.int64()), *(pa.array([packed[n][i] for n in names], pa.binary()) for i in range(5))],
            ["bucket", "first", "second", "docs", "versions", "places"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            for doc, version, text, anchors in zip(
                    *(batch.column(c).to_pylist() for c in ("doc_id", "version")),
                    batch.column("text"), batch.column("anchors"), strict=True):
                hashes = word_hashes(text.as_py().split())
                if len(hashes) < window:
                    continue
                keys = _keys(window_hashes(hashes, block)[::block], buckets).view(np.int64)
                at = block * np.flatnonzero(np.isin(keys, anchors.values.to_numpy()))
                places = np.unique(np.clip(at[:, None] + np.arange(block - window, 1), 0, len(hashes) - window))
                parts.append((window_hashes(hashes, window, 1)[places], (window_hashes(hashes, window, 2)[places] & LOW).astype(np.uint32),
                              np.full(len(places), doc, np.int64), np.full(len(places), version, np.int16),
                              places.astype(np.int32)))
                held += len(places)
                if held > FLUSH:
                    yield flush(parts)
                    parts, held = [], 0
        if held:
            yield flush(parts)

    return anchored.mapInArrow(run, "bucket long, first binary, second binary, docs binary, versions binary, places binary")


def _repeats(table: pa.Table) -> pa.Table:
    """Of one bucket: windows of which a smaller document has an equal one."""
    first, second = _joined(table, "first", np.uint64), _joined(table, "second", np.uint32)
    docs, versions = _joined(table, "docs", np.int64), _joined(table, "versions", np.int16)
    places = _joined(table, "places", np.int32)
    order = np.lexsort((docs, second, first))
    first, second, docs, versions, places = (c[order] for c in (first, second, docs, versions, places))
    starts = np.flatnonzero(np.concatenate([[True], (first[1:] != first[:-1]) | (second[1:] != second[:-1])]))
    least = np.repeat(docs[starts], np.diff(np.append(starts, len(docs))))
    docs, versions, places = (c[docs > least] for c in (docs, versions, places))
    return pa.table({"doc_id": docs, "version": versions.astype(np.int64), "place": places})


def dedup_passages(docs: DataFrame, window: int = 13, id_column: str = "doc_id", text_column: str = "text",
                   keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows (doc_id, n_words, n_removed, kept_text, then ``keep``), one for each row of
    ``docs``; kept words are joined by one blank."""
    block = (window + 1) // 2
    scratch = Scratch(docs.sparkSession)
    source = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("binary").alias("text"),
                         F.pmod(F.xxhash64(text_column), F.lit(1 << 15)).alias("version"), *(F.col(c).alias(f"kept_{c}") for c in keep))
    length = source.agg(F.sum(F.length("text")).alias("length")).first()["length"] or 0
    buckets = max(8, -(-length // BUCKET_BYTES))
    named = source.where("doc_id is not null")
    anchors = scratch.write(
        _index(named.select("doc_id", "text"), block, buckets).groupBy("bucket")
        .applyInArrow(_anchors, "doc_id long, anchor long"), "anchors")
    by_doc = anchors.groupBy(F.col("doc_id").alias("anchored")).agg(F.collect_set("anchor").alias("anchors"))
    probable = likely_members(named, "doc_id", anchors.select("doc_id").distinct()).where("likely")
    anchored = probable.join(by_doc, F.col("doc_id") == F.col("anchored")).where("text is not null")
    repeats = scratch.write(
        _extended(anchored.select("doc_id", "version", "text", "anchors"), window, block, buckets).groupBy("bucket")
        .applyInArrow(_repeats, "doc_id long, version long, place int")
        .groupBy(F.col("doc_id").alias("repeating"), F.col("version").alias("repeating_version")).agg(F.collect_list("place").alias("places")), "repeats")
    scratch.drop(anchors)
    fields = "".join(f", {c} {docs.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            totals, gone, texts = [], [], []
            for text, places in zip(batch.column("text"), batch.column("places"), strict=True):
                words = (text.as_py() or b"").split()
                removed = 0
                totals.append(len(words))
                if places.is_valid:
                    edges = np.zeros(len(words) + 1, np.int64)
                    at = np.unique(places.values.to_numpy())
                    edges[at] += 1
                    edges[at + window] -= 1
                    covered = np.cumsum(edges[:-1]) > 0
                    removed = int(covered.sum())
                    words = [w for w, c in zip(words, covered.tolist(), strict=True) if not c]
                gone.append(removed)
                texts.append(b" ".join(words).decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(totals, pa.int64()), pa.array(gone, pa.int64()),
                 pa.array(texts, pa.string()), *(batch.column(f"kept_{c}") for c in keep)],
                ["doc_id", "n_words", "n_removed", "kept_text", *keep])

    marked = likely_members(source, "doc_id", repeats.select("repeating"))
    repeating = marked.where("likely").join(
        repeats, (F.col("doc_id") == F.col("repeating")) & (F.col("version") == F.col("repeating_version")), "left")
    joined = (repeating.drop("likely", "repeating", "repeating_version")
              .unionByName(marked.where("not likely").drop("likely").withColumn("places", F.lit(None).cast("array<int>"))))
    return joined.mapInArrow(
        run, f"doc_id long, n_words long, n_removed long, kept_text string{fields}")
