"""Similarity join of documents by Jaccard on word shingles, with prefix filters under
several global token orders.

Documents with the same set of shingles are one class.  Under any global order of
tokens, two sets of similarity t or more share a token among the first
n - ceil(t n) + 1 of each, so a pair must pass this filter under every order.  The
first order puts rare tokens first (by a sketch of fixed size) and finds candidates;
two orders by independent hashes must confirm them; what is left is verified on the
whole sets.

Groups of documents that share a prefix token are not paired off.  Each member is
first compared with one pivot of its group: the one whose tokens are the most frequent
on average, which among edited copies is the least edited.  Links make components,
and only pairs across components are still open; while those are many, a further pivot
is tried, then all that remain are compared, so no link that joins components is lost.
A token's place in a set bounds what two sets can share if it is the first they share,
so a pair is compared only at tokens whose places allow enough.  Before any set moves, a
pair must also pass 512 bits of parity kept for each class: where two of them differ, the
sets differ in a token, so more differing bits than the sets may differ in tokens rule
the pair out, and never a link.

A token that more members have than a task should hold is dealt to several tasks by
member; each picks a pivot of its own, and the pivots meet in the later steps.  Sets are
read again from the texts of the classes in question only, which a bitmap of fixed size
finds in the scan; they travel to the pivot, whose members are dealt to as many tasks as
they need, and are compared one by one as they come.

Words are those between ASCII white space, A to Z folded.  Null text and text without
words has no shingles and links with nothing; fewer words than a shingle has are one
shingle.  Rows that repeat are separate rows of one class.  Null ids never name a
component unless all its ids are null.  Sets are compared by 64-bit hashes of their
shingles, and whole sets are equal if 128 bits of hash are.  Other columns are dropped,
whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest, xxh3_128_digest

from tidemark.llm.common import Scratch, components, likely_members, lists
from tidemark.llm.shingles import mixed, window_hashes, word_hashes

SKETCH = 1 << 20
SLICES = 64
BUCKET_TOKENS = 400_000
FLUSH = 1_500_000
PARITY_BITS = 512
MEMBERS = 2_000  # that are compared with one pivot in one task, about
# Columns of a packed prefix token: of its set, the most that can be shared from it on
# (negative where the token is dealt to several tasks), the size, and the mean logarithm of
# the tokens' counts.
ENTRY = {"tokens": np.uint64, "classes": np.int64, "reach": np.int32, "sizes": np.int32, "density": np.float32}
OPEN_PAIRS = 20
PIVOT_ROUNDS = 2


def shingle_set(text: bytes | None, size: int) -> np.ndarray:
    """Distinct hashed shingles of a text, ascending."""
    words = (text or b"").lower().split()
    if 0 < len(words) < size:
        return np.array([xxh3_64_intdigest(b" ".join(words), seed=len(words))], np.uint64)
    return np.unique(window_hashes(word_hashes(words), size))


def class_id(tokens: np.ndarray) -> tuple[int, int]:
    """Two 64-bit hashes of a whole set."""
    first, second = np.frombuffer(xxh3_128_digest(tokens.tobytes()), np.int64).tolist()
    return first, second


def parity(tokens: np.ndarray) -> np.ndarray:
    """For each cell of a fixed number whether an odd number of tokens falls into it."""
    cells = (mixed(tokens, 11) % np.uint64(PARITY_BITS)).astype(np.int64)
    return np.packbits(np.bincount(cells, minlength=PARITY_BITS).astype(np.uint8) & 1).view(np.int64)


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def _prefix(tokens: np.ndarray, percent: int, seed: int) -> np.ndarray:
    """The first tokens of a set under the order ``seed`` gives."""
    length = prefix_length(len(tokens), percent)
    order = mixed(tokens, seed)
    return tokens[np.argpartition(order, length - 1)[:length]] if length < len(tokens) else tokens


def _sets(source: DataFrame, size: int, kind: str) -> DataFrame:
    """Class, size and parity of every document, and per task the sketch of its tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros(SKETCH, np.int64)
        id_type = None
        for batch in batches:
            id_type = batch.schema.field("doc_id").type
            sizes, classes, held, odd = [], [], [], []
            for text in batch.column("text"):
                tokens = shingle_set(text.as_py(), size)
                sizes.append(len(tokens))
                classes.append(class_id(tokens) if len(tokens) else (None, None))
                odd.append(parity(tokens))
                held.append((tokens % np.uint64(SKETCH)).astype(np.int64))
            for at in range(0, len(held), 256):
                cells, counts = np.unique(np.concatenate(held[at:at + 256]), return_counts=True)
                sketch[cells] += counts
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("version"), pa.array(sizes, pa.int64()),
                 *(pa.array(c, pa.int64()) for c in zip(*classes, strict=True)),
                 lists(np.concatenate(odd), [len(o) for o in odd], pa.int64()),
                 pa.nulls(len(sizes), pa.int64()), pa.nulls(len(sizes), pa.binary())], names)
        if id_type is not None:
            none = pa.nulls(SLICES, pa.int64())
            weights = pa.array([part.astype("<u4").tobytes() for part in np.split(sketch, SLICES)], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(SLICES, id_type), none, none, none, none, pa.nulls(SLICES, pa.list_(pa.int64())),
                 pa.array(range(SLICES), pa.int64()), weights], names)

    names = ["doc_id", "version", "n", "cid", "second", "parity", "slice", "weights"]
    return source.mapInArrow(
        run, f"doc_id {kind}, version long, n long, cid long, second long, parity array<long>, slice long, weights binary")


def _total(table: pa.Table) -> pa.Table:
    """One slice of the sketch, summed over tasks; counts stop at the largest 32-bit number."""
    total = np.zeros(SKETCH // SLICES, np.int64)
    for part in table.column("weights"):
        total += np.frombuffer(part.as_py(), "<u4")
    return pa.table({"slice": table.column("slice")[:1],
                     "weights": pa.array([np.minimum(total, 0xFFFFFFFF).astype("<u4").tobytes()], pa.binary())})


def _prefixes(source: DataFrame, size: int, percent: int, sketch: np.ndarray, buckets: int,
              renamed: dict[tuple[int, int], int], most: int) -> DataFrame:
    """Prefix tokens under the first order, packed by task and bucket of the token; a token
    that more than ``most`` documents may have goes to several buckets, by class."""

    def packed(parts: list[tuple]) -> pa.RecordBatch:
        *columns, deals = [np.concatenate(c) for c in zip(*parts, strict=True)]
        with np.errstate(over="ignore"):
            bucket = ((mixed(columns[0], 5) + mixed(deals, 3) * (deals > 0)) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        bucket = bucket[order]
        cuts = np.flatnonzero(np.diff(bucket)) + 1
        return pa.RecordBatch.from_arrays(
            [pa.array(bucket[np.concatenate([[0], cuts])]),
             *(pa.array([c.tobytes() for c in np.split(column[order], cuts)], pa.binary()) for column in columns)],
            ["bucket", *ENTRY])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, parts, held = set(), [], 0
        for batch in batches:
            for text in batch.column("text"):
                found = shingle_set(text.as_py(), size)
                if not len(found) or (named := class_id(found)) in seen:
                    continue
                seen.add(named)
                own = renamed.get(named, named[0])
                weight = sketch[(found % np.uint64(SKETCH)).astype(np.int64)]
                length = prefix_length(len(found), percent)
                order = np.lexsort((mixed(found, 1), weight))[:length]
                deals = -(-weight[order].astype(np.int64) // most)
                reach = len(found) - np.arange(length)
                parts.append((found[order], np.full(length, own, np.int64), np.where(deals > 1, -reach, reach).astype(np.int32),
                              np.full(length, len(found), np.int32), np.full(length, np.log1p(weight).mean(), np.float32),
                              np.where(deals > 1, own % np.maximum(deals, 1), 0).astype(np.uint64)))
                held += length
                if held > FLUSH:
                    yield packed(parts)
                    parts, held = [], 0
        if held:
            yield packed(parts)

    return source.select("text").mapInArrow(run, f"bucket long, {', '.join(f'{c} binary' for c in ENTRY)}")


def _groups(table: pa.Table, percent: int) -> pa.Table:
    """Of one bucket: a candidate of each member with its group's pivot (``b``), and of
    groups of three or more, or dealt to several buckets, the members (``token``) whose places
    allow a link."""
    tokens, classes, reach, sizes_of, density = (
        np.concatenate([np.frombuffer(b, kind) for b in table.column(c).to_pylist()]) for c, kind in ENTRY.items())
    order = np.lexsort((classes, -density, tokens))
    tokens, classes, reach, sizes_of = (c[order] for c in (tokens, classes, reach.astype(np.int64), sizes_of.astype(np.int64)))
    fresh = np.ones(len(tokens), bool)
    fresh[1:] = (tokens[1:] != tokens[:-1]) | (classes[1:] != classes[:-1])
    tokens, classes, reach, sizes_of = (c[fresh] for c in (tokens, classes, reach, sizes_of))
    dealt, reach = reach < 0, np.abs(reach)
    firsts = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]]))
    sizes = np.diff(np.append(firsts, len(tokens)))
    pivots, pivot_sizes, least = (np.repeat(c, sizes) for c in (classes[firsts], sizes_of[firsts], np.minimum.reduceat(sizes_of, firsts)))
    sizes = np.repeat(sizes, sizes)
    other = (classes != pivots) & (100 * np.minimum(sizes_of, pivot_sizes) >= percent * np.maximum(sizes_of, pivot_sizes))
    pairs = np.unique(np.stack([classes[other], pivots[other]], 1), axis=0)
    large = ((sizes >= 3) | dealt) & ((100 + percent) * reach >= percent * (sizes_of + np.where(dealt, 1, least)))
    is_pair = np.arange(len(pairs) + large.sum()) < len(pairs)
    filled = lambda values: pa.array(np.concatenate([np.zeros(len(pairs), np.int64), values]), mask=is_pair)
    return pa.table({
        "a": np.concatenate([pairs[:, 0], classes[large]]),
        "b": pa.array(np.concatenate([pairs[:, 1], classes[large]]), mask=~is_pair),
        "token": filled(tokens[large].view(np.int64)), "reach": filled(reach[large]), "n": filled(sizes_of[large])})


def _possible(percent: int, x: str, y: str) -> str:
    """SQL: sizes and parities of two classes allow a link.  With a share of t in common, sets
    of together m tokens differ in (1 - t) m / (1 + t) at most."""
    differing = " + ".join(f"bit_count({x}_parity[{i}] ^ {y}_parity[{i}])" for i in range(PARITY_BITS // 64))
    return (f"100 * least({x}_n, {y}_n) >= {percent} * greatest({x}_n, {y}_n) and "
            f"{100 + percent} * ({differing}) <= {100 - percent} * ({x}_n + {y}_n)")


def _side(classes: DataFrame, name: str) -> DataFrame:
    return classes.select(F.col("cls").alias(name), *(F.col(c).alias(f"{name}_{c}") for c in ("at", "n", "parity")))


def _verified(pairs: DataFrame, classes: DataFrame, renamed: dict[tuple[int, int], int], source: DataFrame, size: int,
              percent: int, scratch: Scratch) -> DataFrame:
    """Of candidate pairs (a, b) those that share prefix tokens under both other orders and
    whose sets are similar enough.  ``b`` should be the side with many partners."""
    likely = scratch.write(
        pairs.join(_side(classes, "a"), "a").join(_side(classes, "b"), "b").where(_possible(percent, "a", "b"))
        .select("a", "b", "a_at", "b_at"), "likely-pairs")
    many = likely.groupBy("b").agg(F.ceil(F.count("*") / MEMBERS).alias("deals"))
    dealt = likely.join(many, "b").withColumn("deal", F.expr("pmod(xxhash64(a), deals)"))
    wanted = scratch.write(
        dealt.select(F.col("a_at").alias("wanted_at"), "b", "deal", F.col("a").alias("cls"), F.lit(True).alias("is_member"))
        .union(dealt.select("b_at", "b", "deal", F.col("b").alias("cls"), F.lit(False)).distinct()), "wanted-sets")
    scratch.drop(likely)
    texts = likely_members(source, "at", wanted.select("wanted_at").distinct()).where("likely").select("at", "text")

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = [shingle_set(t.as_py(), size) for t in part.column("text")]
                own = [renamed.get(ids, ids[0]) for ids in map(class_id, found)]
                sets = pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in ("b", "deal", "is_member", "cls")), pa.array([f.tobytes() for f in found], pa.binary())],
                    ["b", "deal", "is_member", "cls", "tokens"])
                yield sets.filter(pc.equal(part.column("cls"), pa.array(own, pa.int64())))  # another text may have the same "at"

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, pivot, others = None, None, []
        for batch in batches:
            found = []
            for b, deal, is_member, cls, packed in zip(*(batch.column(c).to_pylist() for c in ("b", "deal", "is_member", "cls", "tokens")), strict=True):
                tokens = np.frombuffer(packed, np.uint64)
                if not is_member:
                    own, pivot, others = (b, deal), tokens, [_prefix(tokens, percent, seed) for seed in (2, 3)]
                    continue
                if own != (b, deal):
                    raise RuntimeError(f"the set of class {b} is missing")
                shared = all(len(np.intersect1d(p, _prefix(tokens, percent, seed), assume_unique=True))
                             for seed, p in zip((2, 3), others, strict=True))
                if shared:
                    common = len(np.intersect1d(pivot, tokens, assume_unique=True))
                    if 100 * common >= percent * (len(pivot) + len(tokens) - common):
                        found.append((cls, b))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], ["a", "b"])

    sets = texts.join(wanted, F.col("at") == F.col("wanted_at")).select("b", "deal", "is_member", "cls", "text").mapInArrow(
        emit, "b long, deal long, is_member boolean, cls long, tokens binary")
    links = scratch.write(
        sets.repartition("b", "deal").sortWithinPartitions("b", "deal", "is_member").mapInArrow(compare, "a long, b long").distinct(),
        "links")
    scratch.drop(wanted)
    return links


def similar(docs: DataFrame, size: int = 5, percent: int = 80, id_column: str = "doc_id",
            text_column: str = "text", most_in_task: int = BUCKET_TOKENS) -> DataFrame:
    """Rows (doc_id, n_shingles, component_id, is_first), one for each row of ``docs``: the
    smallest id reachable by links, itself included, and whether it is the row's own."""
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession)
    kind = docs.schema[id_column].dataType.simpleString()
    source = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).cast("binary").alias("text"),
                         F.xxhash64(text_column).alias("version")).withColumn("at", F.xxhash64("doc_id", "version"))
    first = scratch.write(_sets(source, size, kind), "sets")
    rows = first.where("slice is null")
    counted = (first.where("slice is not null").select("slice", "weights").groupBy("slice")
               .applyInArrow(_total, "slice long, weights binary").toArrow().sort_by("slice"))
    sketch = np.concatenate([np.frombuffer(w, "<u4") for w in counted.column("weights").to_pylist()] or [np.zeros(SKETCH, "<u4")])
    buckets = max(8, int(sketch.sum(dtype=np.int64)) // (5 * most_in_task))
    classes, renamed = _classes(rows, scratch)

    def groups_of(table: pa.Table) -> pa.Table:
        return _groups(table, percent)

    groups = scratch.write(
        _prefixes(source, size, percent, sketch, buckets, renamed, most_in_task).groupBy("bucket")
        .applyInArrow(groups_of, "a long, b long, token long, reach long, n long"), "groups")
    pairs = groups.where("b is not null").select("a", "b").distinct()
    entries = groups.where("token is not null").select("token", F.col("a").alias("cls"), "reach")
    links = _verified(pairs, classes, renamed, source, size, percent, scratch)
    roots = components(links, scratch)
    tried = [pairs]
    for step in range(PIVOT_ROUNDS):
        placed = (entries.join(roots, entries["cls"] == roots["node"], "left")
                  .select("token", "cls", "reach", F.coalesce("root", "cls").alias("component")))
        unsettled = (
            placed.groupBy("token", "component")
            .agg(F.count("*").alias("m"), F.min(F.struct(F.xxhash64("cls", F.lit(step)), "cls", "component")).alias("pivot"))
            .groupBy("token").agg(F.sum("m").alias("m"), F.sum(F.expr("m * m")).alias("within"), F.min("pivot").alias("pivot"),
                                  F.count("*").alias("components"))
            .where("components > 1").selectExpr("token", "pivot", "(m * m - within) / (2 * m) as share"))
        open_entries = scratch.write(placed.join(unsettled, "token"), "open")
        size_of = open_entries.agg(F.sum("share").alias("pairs"), F.count("*").alias("entries")).first()
        if not size_of["entries"]:
            scratch.drop(open_entries)
            break
        last = size_of["pairs"] <= OPEN_PAIRS * size_of["entries"] or step == PIVOT_ROUNDS - 1
        if last:
            told = scratch.write(open_entries.select("token", "cls", "reach", "component")
                                 .join(classes.select("cls", "n", "parity"), "cls"), "open-members")
            x, y = (told.select("token", *(F.col(c).alias(f"{side}_{c}") for c in ("cls", "reach", "component", "n", "parity")))
                    for side in ("x", "y"))
            more = x.join(y, (x["token"] == y["token"]) & F.expr(
                f"x_cls > y_cls and x_component <> y_component and {_possible(percent, 'x', 'y')} and "
                f"{100 + percent} * least(x_reach, y_reach) >= {percent} * (x_n + y_n)"))
            more = more.select(F.col("x_cls").alias("a"), F.col("y_cls").alias("b")).distinct()
        else:
            more = open_entries.where("component <> pivot.component").select(
                F.col("cls").alias("a"), F.col("pivot.cls").alias("b")).distinct()
        for before in tried:
            more = more.join(before, ["a", "b"], "left_anti").join(
                before.select(F.col("a").alias("b"), F.col("b").alias("a")), ["a", "b"], "left_anti")
        more = scratch.write(more, "more-pairs")
        found = _verified(more, classes, renamed, source, size, percent, scratch)
        joined = scratch.write(links.union(found), "all-links")
        for done in (open_entries, links, found, *([told] if last else [])):
            scratch.drop(done)
        links = joined
        roots = components(links, scratch)
        if last:
            scratch.drop(more)
            break
        tried.append(more)
    scratch.drop(groups)
    labelled = (classes.join(roots, F.col("cls") == F.col("node"), "left")
                .select("cid", "second", "least", F.coalesce("root", "cls").alias("component")))
    named = labelled.groupBy("component").agg(F.min("least").alias("component_id"))
    found = labelled.join(named, "component").select("cid", "second", "component_id")
    return (rows.join(found, ["cid", "second"], "left")
            .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))
            .withColumn("is_first", F.col("doc_id").eqNullSafe(F.col("component_id"))))


def _classes(rows: DataFrame, scratch: Scratch) -> tuple[DataFrame, dict[tuple[int, int], int]]:
    """A row for each set: ``cls``, 64 bits that name it, the row ``at`` which its text is read
    again, its size and parity, and the smallest id.  Sets that differ in the second half of
    their hash only get names of their own, which are returned: some three of 10^10 sets."""
    classes = scratch.write(
        rows.where("cid is not null").groupBy("cid", "second")
        .agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "version")).alias("row"), F.min("doc_id").alias("least"),
             F.any_value("n").alias("n"), F.any_value("parity").alias("parity"))
        .select("cid", "second", F.xxhash64("row.doc_id", "row.version").alias("at"), "least", "n", "parity"), "classes")
    twice = classes.groupBy("cid").agg(F.min("second").alias("kept"), F.count("*").alias("sets")).where("sets > 1")
    clashing = classes.join(twice, "cid").where("second <> kept").select("cid", "second").collect()
    renamed = {(r["cid"], r["second"]): r["cid"] ^ r["second"] for r in clashing}
    if not renamed:
        return classes.withColumn("cls", F.col("cid")), renamed
    names = classes.sparkSession.createDataFrame([(*k, v) for k, v in renamed.items()], "cid long, second long, renamed long")
    return classes.join(F.broadcast(names), ["cid", "second"], "left").withColumn("cls", F.coalesce("renamed", "cid")), renamed
