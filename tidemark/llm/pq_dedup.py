"""Near-duplicate vectors by product quantisation.

Equal vectors are one class, with its number of rows, so copies are never paired.
Classes are coded: the nearest of the coarse centroids, and for each subspace of the
residual the nearest of its codewords.  A class is compared with every list whose cell
its neighbourhood can reach: the plane between two centroids is nearer than the
radius of the threshold.  No list within that bound is left out, so every link is
found.  Within a list, members near each other have one of them as leader, and a class
asks a list only if its leader and one there are within the radius and both leaders'
spreads.  Distances from a class to the members of a list it asks are those to the vectors
their codes stand for, one matrix product; only members whose distance, less their own
coding error, is within the radius are compared exactly, in double precision.

Centroids and codewords are fitted on a bounded sample; every class is indexed.
Neighbouring lists are packed into blocks of bounded size and a large list is split
over several; a task has one pair of blocks, and a pair is only made if the one
reaches a list of the other.  It emits counts and a star of links per local
component, never the pairs of vectors.  Where cells are not well apart, as with
evenly spread vectors of many dimensions, most blocks reach each other and the work
grows with the square of the number of leaders: of classes, if none are near each other.

Vectors that are null or zero, or hold null or non-finite components link with nothing;
neither do rows without an id, which get a null component.  Vectors of different lengths
never link; each length is a pass of its own.  Rows with the same id and vector count once and all get its result.
Other columns are dropped, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, components
from tidemark.llm.hnsw import matrix, usable

BLOCK_BYTES = 4 << 20
CELLS = 1 << 21
LED = 1024
CODED = "cls long, size long, unit binary, list int, codes binary, error double"
PACKED = ("block int, cls binary, size binary, unit binary, list binary, codes binary, error binary, leader binary, "
          "apart binary, lists array<int>, reach array<int>")
KINDS = {"cls": np.int64, "size": np.int64, "unit": np.float64, "list": np.int32, "codes": np.uint8, "error": np.float64,
         "leader": np.int32, "apart": np.float64}


def k_means(points: np.ndarray, count: int, rounds: int = 8) -> np.ndarray:
    """Centroids of ``points``; the same for the same points."""
    order = np.random.default_rng(0).permutation(len(points))
    centroids = points[order[:count]].copy()
    for _ in range(rounds):
        own = closest(points, centroids)
        sums = np.zeros_like(centroids)
        np.add.at(sums, own, points)
        sizes = np.bincount(own, minlength=len(centroids))
        centroids[sizes > 0] = sums[sizes > 0] / sizes[sizes > 0, None]
    return centroids


def distances(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    square = (points ** 2).sum(1)[:, None] - 2 * points @ centroids.T + (centroids ** 2).sum(1)
    return np.maximum(square, 0)


def closest(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return np.concatenate([distances(points[i:i + 4096], centroids).argmin(1) for i in range(0, len(points), 4096)])


class Quantiser:
    def __init__(self, sample: np.ndarray, lists: int, parts: int, codewords: int) -> None:
        self.coarse = k_means(sample, min(lists, len(sample)))
        rest = sample - self.coarse[closest(sample, self.coarse)]
        self.splits = np.array_split(np.arange(sample.shape[1]), min(parts, sample.shape[1]))
        self.words = [k_means(rest[:, s], min(codewords, len(rest))) for s in self.splits]
        self.apart = np.sqrt(distances(self.coarse, self.coarse))

    def code(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Lists, codes and coding errors."""
        own = closest(unit, self.coarse)
        rest = unit - self.coarse[own]
        codes = np.stack([closest(rest[:, s], w) for s, w in zip(self.splits, self.words, strict=True)], 1)
        error = np.zeros(len(unit))
        for i, (s, w) in enumerate(zip(self.splits, self.words, strict=True)):
            error += ((rest[:, s] - w[codes[:, i]]) ** 2).sum(1)
        return own, codes.astype(np.uint8), np.sqrt(error)

    def decode(self, own: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The vectors that lists and codes stand for."""
        out = self.coarse[own]
        for i, (s, w) in enumerate(zip(self.splits, self.words, strict=True)):
            out[:, s] += w[codes[:, i]]
        return out

    def reaches(self, unit: np.ndarray, own: np.ndarray, radius: float, lists: np.ndarray | None = None) -> np.ndarray:
        """Whether a point of each list, or of each of ``lists``, can be within ``radius``; of
        linked points each reaches the other's list.  Multiplied out, as centroids may coincide."""
        lists = np.arange(len(self.coarse)) if lists is None else lists
        mine = ((unit - self.coarse[own]) ** 2).sum(1)[:, None]
        found = distances(unit, self.coarse[lists]) - mine <= 2 * radius * self.apart[own[:, None], lists] + 1e-7
        return found | (own[:, None] == lists)

    def order(self) -> np.ndarray:
        """Lists along the axis on which the centroids differ most, so that lists packed
        together are near each other."""
        centred = self.coarse - self.coarse.mean(0)
        return np.argsort(centred @ np.linalg.eigh(centred.T @ centred)[1][:, -1], kind="stable")


def places(sizes: dict[int, int], order: np.ndarray, most: int) -> list[tuple[int, int, int]]:
    """(list, first block, blocks): lists in order fill blocks of about ``most`` classes;
    a larger list has blocks of its own."""
    out, block, filled = [], 0, 0
    for i in order.tolist():
        size = sizes.get(i, 0)
        if not size:
            continue
        if filled and filled + size > most:
            block, filled = block + 1, 0
        count = math.ceil(size / most)
        out.append((i, block, count))
        block, filled = (block + count, 0) if count > 1 else (block, filled + size)
    return out


def led(unit: np.ndarray, own: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
    """Leaders of points sorted by list, as places, and the distances to them, at most about
    ``radius``.  A point is led by one of its list, or by itself."""
    leader, apart = np.arange(len(unit), dtype=np.int32), np.zeros(len(unit))
    starts = np.flatnonzero(np.diff(own, prepend=-1))
    for first, last in zip(starts.tolist(), [*starts[1:].tolist(), len(unit)], strict=True):
        for i in range(first, last, LED):
            points = unit[i:min(i + LED, last)]
            near = points @ points.T >= 1 - radius ** 2 / 2
            np.fill_diagonal(near, True)
            rest = np.arange(len(points))
            while len(rest):
                # The first point near each; those that are first for themselves lead.
                head = near[np.ix_(rest, rest)].argmax(1)
                leads = head[head] == head
                leader[i + rest[leads]] = i + rest[head[leads]]
                rest = rest[~leads]
    for i in range(0, len(unit), LED):
        apart[i:i + LED] = np.sqrt(((unit[i:i + LED] - unit[leader[i:i + LED]]) ** 2).sum(1))
    return leader, apart


def _pack(group: pd.DataFrame, quantiser: Quantiser, radius: float) -> pd.DataFrame:
    """A block as one row, with the lists it holds and those it reaches."""
    group = group.sort_values(["list", "cls"])
    unit = np.stack([np.frombuffer(u) for u in group["unit"]])
    own = group["list"].to_numpy(np.int32)
    reach = np.zeros(len(quantiser.coarse), bool)
    for i in range(0, len(unit), 1024):
        reach |= quantiser.reaches(unit[i:i + 1024], own[i:i + 1024], radius).any(0)
    leader, apart = led(unit, own, radius)
    return pd.DataFrame({
        "block": [int(group["block"].iloc[0])], "leader": [leader.tobytes()], "apart": [apart.tobytes()],
        **{c: [group[c].to_numpy(KINDS[c]).tobytes()] for c in ("cls", "size", "list", "error")},
        "unit": [unit.tobytes()], "codes": [b"".join(group["codes"])],
        "lists": [np.unique(own).tolist()], "reach": [np.nonzero(reach)[0].tolist()]})


def _merge(root: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """``root`` after joining x[i] with y[i]: every label is the smallest of its component."""
    while True:
        a, b = root[x], root[y]
        live = a != b
        if not live.any():
            return root
        x, y, a, b = x[live], y[live], a[live], b[live]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (root[root] != root).any():
            root = root[root]


def _within(queries: np.ndarray, points: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, point) of which the point is within its ``reach`` of the query, a vector
    of length one, and few that are just outside.  One product in single precision, with
    the bound as one more component, less what rounding can take."""
    square = (points ** 2).sum(1)
    rounding = (points.shape[1] + 8) * 2.0 ** -23 * (2 + square + reach ** 2)
    bound = (1 + square - reach ** 2) / 2 - rounding
    right = np.concatenate([points, -bound[:, None]], 1).astype(np.float32).T
    left = np.concatenate([queries, np.ones((len(queries), 1))], 1).astype(np.float32)
    found = []
    step = max(1, CELLS // len(points))
    for i in range(0, len(left), step):
        over = left[i:i + step] @ right
        some = np.flatnonzero(over.max(1) >= 0)
        a, b = np.nonzero(over[some] >= 0)
        found.append((i + some[a], b))
    return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])


def _asks(left: dict, right: dict, lists: np.ndarray, quantiser: Quantiser, radius: float) -> np.ndarray:
    """Which classes of ``left`` ask which lists of ``right``: those within the plane bound
    that hold a leader near enough to the class's own."""
    sides = []
    for side in (left, right):
        place, of = np.unique(side["leader"], return_inverse=True)
        spread = np.zeros(len(place))
        np.maximum.at(spread, of, side["apart"])
        sides.append((place, of, spread))
    (mine, of, spread), (theirs, _, their_spread) = sides
    column = np.searchsorted(lists, right["list"][theirs])
    near = np.zeros((len(mine), len(lists)), bool)
    order = np.argsort(spread, kind="stable")
    points = right["unit"][theirs]
    for some in np.array_split(order, len(order) // LED + 1):
        a, b = _within(left["unit"][mine[some]], points, radius + spread[some].max() + their_spread + 1e-9)
        near[some[a], column[b]] = True
    asks = near[of]
    asking = np.flatnonzero(asks.any(1))
    for i in range(0, len(asking), LED):
        some = asking[i:i + LED]
        asks[some] &= quantiser.reaches(left["unit"][some], left["list"][some], radius, lists)
    return asks


def _links(left: dict, right: dict, same: bool, quantiser: Quantiser, radius: float, threshold: float) -> pd.DataFrame:
    """Counts and a star of links between two blocks, or within one.

    Two blocks meet once, so both sides are credited; within a block each class asks for
    itself.
    """
    shift = 0 if same else len(left["cls"])
    cls = left["cls"] if same else np.concatenate([left["cls"], right["cls"]])
    counts, root = np.zeros(len(cls), np.int64), np.arange(len(cls))
    lists, starts = np.unique(right["list"], return_index=True)
    ends = [*starts[1:], len(right["list"])]
    asks = _asks(left, right, lists, quantiser, radius)
    for k, (start, end) in enumerate(zip(starts.tolist(), ends, strict=True)):
        asking = np.flatnonzero(asks[:, k])
        if not len(asking):
            continue
        unit = right["unit"][start:end]
        coded = quantiser.decode(right["list"][start:end], right["codes"][start:end])
        reach = radius + right["error"][start:end] + 1e-9
        step = max(1, CELLS // len(unit))
        for i in range(0, len(asking), step):
            some = asking[i:i + step]
            wanted = left["unit"][some]
            a, b = _within(wanted, coded, reach)
            if len(a) > len(some) * len(unit) // 16:
                near = (wanted @ unit.T)[a, b]
                exact = np.nonzero(np.abs(near - threshold) < 1e-9)[0]
            else:
                near, exact = np.empty(len(a)), np.arange(len(a))
            for part in np.array_split(exact, len(exact) // 65536 + 1):
                near[part] = np.einsum("ij,ij->i", wanted[a[part]], unit[b[part]])
            linked = near >= threshold
            x, y = some[a[linked]], start + b[linked]
            if same:
                x, y = x[x != y], y[x != y]
            counts += np.bincount(x, right["size"][y], len(cls)).astype(np.int64)
            if not same:
                counts += np.bincount(shift + y, left["size"][x], len(cls)).astype(np.int64)
            root = _merge(root, x, shift + y)
    found = np.nonzero(counts)[0]
    return pd.DataFrame({"cls": cls[found], "n": counts[found], "root": cls[root[found]]})


def near_duplicates(vectors: DataFrame, threshold: float = 0.95, list_size: int = 256, most_lists: int = 4096,
                    parts: int = 8, codewords: int = 64, sample_rows: int = 20_000,
                    id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """Rows (vec_id, n_links, component_id, kept), one for each row of ``vectors``.

    ``sample_rows`` bounds the sample that centroids and codewords are fitted on; a
    list has ``list_size`` classes on average until there are ``most_lists`` lists.
    """
    scratch = Scratch(vectors.sparkSession)
    rows = usable(vectors, id_column, vector_column).withColumn("point", F.xxhash64("vector"))
    classes = scratch.write(rows.distinct().groupBy("point", "vector").agg(
        F.min("vec_id").alias("cls"), F.count("*").alias("size")), "classes")
    every = vectors.select(F.col(id_column).cast("long").alias("vec_id"),
                           F.xxhash64(F.col(vector_column).cast("array<double>")).alias("point"))
    lengths = classes.groupBy(F.size("vector").alias("length")).count().orderBy("length").collect()
    if not lengths:
        return every.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
                            F.col("vec_id").isNotNull().alias("kept"))
    found = None
    for length, total in lengths:
        own = _found(classes.where(F.size("vector") == length), total, scratch, threshold, list_size, most_lists, parts,
                     codewords, sample_rows)
        found = own if found is None else found.union(own)
    roots = components(found.select(F.col("cls").alias("a"), F.col("root").alias("b")), scratch)
    counts = found.groupBy("cls").agg(F.sum("n").alias("n"))
    results = (classes.join(counts, "cls", "left").join(roots, F.col("cls") == F.col("node"), "left")
               .select(F.col("point").alias("class_point"), "vector",
                       (F.col("size") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"),
                       F.coalesce("root", "cls").alias("component_id")))
    source = vectors.select(F.col(id_column).cast("long").alias("vec_id"),
                            F.col(vector_column).cast("array<double>").alias("own_vector"))
    return (
        source.withColumn("point", F.xxhash64("own_vector"))
        .join(results, (F.col("point") == F.col("class_point")) & (F.col("own_vector") == F.col("vector")), "left")
        .select("vec_id", F.when(F.col("vec_id").isNull(), 0).otherwise(F.coalesce("n_links", F.lit(0))).cast("long").alias("n_links"),
                F.when(F.col("vec_id").isNotNull(), F.coalesce("component_id", "vec_id")).alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))))


def _found(same_length: DataFrame, total: int, scratch: Scratch, threshold: float, list_size: int, most_lists: int,
           parts: int, codewords: int, sample_rows: int) -> DataFrame:
    """Links among classes of vectors of one length: rows (cls, n, root)."""
    sample = same_length.orderBy("point", "cls").limit(sample_rows).select("vector").toPandas()
    quantiser = Quantiser(matrix(sample["vector"]), min(most_lists, max(1, math.ceil(total / list_size))), parts, codewords)
    radius = math.sqrt(2 - 2 * threshold)

    def code(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            unit = matrix(batch["vector"])
            own, codes, error = quantiser.code(unit)
            yield pd.DataFrame({
                "cls": batch["cls"], "size": batch["size"], "unit": [u.tobytes() for u in unit], "list": own.astype(np.int32),
                "codes": [c.tobytes() for c in codes], "error": error})

    coded = scratch.write(same_length.select("cls", "size", "vector").mapInPandas(code, CODED), "coded")
    length = quantiser.coarse.shape[1]
    # A row per list, so at most ``most_lists``.
    sizes = dict(map(tuple, coded.groupBy("list").count().collect()))
    placed = same_length.sparkSession.createDataFrame(
        places(sizes, quantiser.order(), max(256, BLOCK_BYTES // (8 * length))), "list int, first int, blocks int")
    packed = scratch.write(
        coded.join(F.broadcast(placed), "list")
        .withColumn("block", F.col("first") + F.pmod(F.xxhash64("cls"), "blocks").cast("int")).drop("first", "blocks")
        .groupBy("block").applyInPandas(lambda g: _pack(g, quantiser, radius), PACKED), "packed")
    holds = packed.select(F.col("block").alias("b"), F.explode("lists").alias("list"))
    pairs = (packed.select(F.col("block").alias("a"), F.explode("reach").alias("list")).join(holds, "list")
             .where("a <= b").select("a", "b").distinct())
    side = lambda of: packed.select(F.col("block").alias(of), *(F.col(c).alias(f"{of}_{c}") for c in KINDS))

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                row = batch.slice(i, 1).to_pylist()[0]
                blocks = [{c: np.frombuffer(row[f"{of}_{c}"], kind) for c, kind in KINDS.items()} for of in ("a", "b")]
                for block in blocks:
                    block["unit"] = block["unit"].reshape(-1, length)
                    block["codes"] = block["codes"].reshape(-1, len(quantiser.splits))
                found = _links(*blocks, row["a"] == row["b"], quantiser, radius, threshold)
                yield pa.RecordBatch.from_pandas(found.astype(np.int64), preserve_index=False)

    # Every other pair is turned round, so that no block is the second of most of its pairs.
    turned = (F.col("a") + F.col("b")) % 2 == 1
    pairs = pairs.select(F.when(turned, F.col("b")).otherwise(F.col("a")).alias("a"),
                         F.when(turned, F.col("a")).otherwise(F.col("b")).alias("b"))
    met = pairs.join(side("a"), "a").join(side("b"), "b")
    return scratch.write(met.mapInArrow(links, "cls long, n long, root long"), "links")
