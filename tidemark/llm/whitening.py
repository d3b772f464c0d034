"""Whitening of embeddings by a pivoted Cholesky factor and one-sided Jacobi rotations.

Entries become whole numbers, x = floor(1024 c) + 100000, so sums over any number of
rows are exact and the same for every partitioning and every retry.  One pass adds up
the rows and their sums S; a second the products of x - floor(S / n), numbers that are
centred to less than one unit before they are multiplied; what the fractions of the
means still add is subtracted exactly, in whole numbers.  The scatter is then factored
on the driver: Cholesky with the largest remaining diagonal as pivot gives a triangular
factor L, whose columns are rotated in pairs until they are orthogonal.  The squares of
the column lengths are the eigenvalues, the columns of length one the components.  L is
never squared, so small eigenvalues keep their digits.  Two more passes over the rows
project them: one adds up the products of the projections, whose distance from the
identity is returned with every row, the other writes the rows.

No row is shuffled.  A task adds d (d + 1) / 2 products to the sums Spark makes of them,
and as many numbers reach the driver, d being the vectors' length; that and the cube of d
are the bounds of the method, whatever the number of rows.  At most ``most_lengths``
different lengths are taken, or the fit fails: every length is fitted by itself and has
its own n, so one foreign vector among the others changes nothing.

Vectors that are null or hold null or non-finite entries, and those without entries, are
left out; entries over 2^52 fail the fit.  Repeated rows count and are returned one by one,
null ids with them.  A table that leaves no row, or only equal rows, has no components and
gives no rows; there are never more components than the rank.  Of equal eigenvalues any
orthogonal components may come, the same for all rows.  Other columns are dropped, whatever
their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the contract: x = floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 1024, 100_000
LARGEST = float(1 << 52)
LIMB = 32
CHUNK = 1 << 18
EXACT = float(1 << 53)
MOST_SWEEPS = 60


@dataclass
class Fit:
    """What the rows of one length have in common.  ``base`` is floor(S / n) by dimension,
    ``rest`` S - n base."""

    n: int
    base: np.ndarray
    rest: list[int]
    trace: float = 0.0
    values: np.ndarray | None = None
    components: np.ndarray | None = None
    error: float = 0.0


def whole_numbers(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and x-vectors of the usable rows, by length and in slices."""
    vectors = batch.column("vector")
    lengths = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    for length in np.unique(lengths[lengths > 0]).tolist():
        rows = np.flatnonzero(lengths == length)
        step = max(1, CHUNK // length)
        for at in range(0, len(rows), step):
            own = rows[at:at + step]
            flat = pc.list_flatten(vectors.take(pa.array(own))).cast(pa.float64())
            values = flat.to_numpy(zero_copy_only=False).reshape(len(own), length)
            fine = np.isfinite(values).all(1)
            own, values = own[fine], values[fine]
            if np.abs(values).max(initial=0) * SCALE > LARGEST:
                raise OverflowError("an entry is over 2^52 / 1024: its whole number would not be exact")
            if len(own):
                yield own, np.floor(SCALE * values).astype(np.int64) + SHIFT


def _exact_sum(x: np.ndarray) -> np.ndarray:
    return x.sum(0) if np.abs(x).max() * float(len(x)) < EXACT else x.astype(object).sum(0)


def _exact_products(y: np.ndarray) -> np.ndarray:
    """Sum of outer products of whole numbers: in doubles where every sum is exact."""
    most = float(np.abs(y).max())
    if most * most * len(y) < EXACT:
        y = y.astype(np.float64)
        return (y.T @ y).astype(np.int64)
    y = y.astype(object)
    return y.T @ y


def _limbs(values: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """Whole numbers of any size as two 64-bit ones, sums of which stay sums."""
    flat = [int(v) for v in values]
    return pa.array([v >> LIMB for v in flat], pa.int64()), pa.array([v & ((1 << LIMB) - 1) for v in flat], pa.int64())


SUMS = "size int, i int, j int, n long, high long, low long"


def _summed(vectors: DataFrame, add: object) -> dict[int, dict[tuple[int, int], tuple[int, int]]]:
    """Sums over all tasks of what ``add`` makes of slices: arrays by length, exact."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, int] = {}
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for _, x in whole_numbers(batch):
                size = x.shape[1]
                part = add(x).astype(object)
                counts[size] = counts.get(size, 0) + len(x)
                totals[size] = totals[size] + part if size in totals else part
        for size, total in totals.items():
            i, j = np.triu_indices(size) if total.ndim == 2 else (np.arange(size), np.arange(size))
            high, low = _limbs(total[i, j] if total.ndim == 2 else total)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(i), size, np.int32)), pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)),
                 pa.array(np.full(len(i), counts[size], np.int64)), high, low], ["size", "i", "j", "n", "high", "low"])

    rows = (vectors.select("vector").mapInArrow(run, SUMS).groupBy("size", "i", "j")
            .agg(*(F.sum(c).alias(c) for c in ("n", "high", "low"))).toArrow())
    out: dict[int, dict[tuple[int, int], tuple[int, int]]] = {}
    for size, i, j, n, high, low in zip(*(rows.column(c).to_pylist() for c in ("size", "i", "j", "n", "high", "low")), strict=True):
        out.setdefault(size, {})[i, j] = n, (high << LIMB) + low
    return out


def pivoted_cholesky(matrix: np.ndarray) -> np.ndarray:
    """L of ``matrix`` = L L', one column for each pivot above rounding; rows in the
    matrix's own order, triangular in the order of the pivots."""
    size = len(matrix)
    factor, left, taken = np.zeros((size, size)), matrix.diagonal().copy(), np.zeros(size, bool)
    least = size * np.finfo(float).eps * max(left.max(initial=0.0), 0.0)
    for k in range(size):
        pivot = int(np.argmax(np.where(taken, -np.inf, left)))
        if left[pivot] <= least:
            return factor[:, :k]
        column = (matrix[:, pivot] - factor[:, :k] @ factor[pivot, :k]) / np.sqrt(left[pivot])
        column[taken] = 0.0
        factor[:, k] = column
        left -= column * column
        taken[pivot] = True
    return factor


def rotated(factor: np.ndarray) -> np.ndarray:
    """``factor`` with its columns rotated in pairs until all are orthogonal; a round
    turns disjoint pairs at once, and every pair meets once a sweep."""
    columns = factor.copy()
    count = columns.shape[1]
    if count < 2:
        return columns
    places = np.arange(count + count % 2)
    for _ in range(MOST_SWEEPS):
        turned = False
        for _ in range(len(places) - 1):
            a, b = places[:len(places) // 2], places[len(places) // 2:][::-1]
            both = (a < count) & (b < count)
            a, b = a[both], b[both]
            x, y = columns[:, a], columns[:, b]
            xx, yy, xy = (x * x).sum(0), (y * y).sum(0), (x * y).sum(0)
            turn = np.abs(xy) > 1e-15 * np.sqrt(xx * yy)
            if turn.any():
                turned = True
                a, b, x, y = a[turn], b[turn], x[:, turn], y[:, turn]
                zeta = (yy[turn] - xx[turn]) / (2 * xy[turn])
                tangent = np.where(zeta < 0, -1.0, 1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
                cosine = 1 / np.hypot(1.0, tangent)
                sine = cosine * tangent
                columns[:, a], columns[:, b] = cosine * x - sine * y, sine * x + cosine * y
            places = np.concatenate([places[:1], np.roll(places[1:], 1)])
        if not turned:
            break
    return columns


def eigen(matrix: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues of a scatter, falling, and its components as columns."""
    columns = rotated(pivoted_cholesky(matrix))
    values = (columns * columns).sum(0)
    order = np.argsort(-values, kind="stable")[:most]
    order = order[values[order] > 0]
    return values[order], columns[:, order] / np.sqrt(values[order])


def fit(vectors: DataFrame, components: int = 8, most_lengths: int = 64) -> dict[int, Fit]:
    """Fits by vector length of a frame with the column ``vector``."""
    fits = {}
    for size, cells in _summed(vectors, _exact_sum).items():
        n = cells[0, 0][0]
        parts = [divmod(cells[i, i][1], n) for i in range(size)]
        fits[size] = Fit(n, np.array([q for q, _ in parts], np.int64), [r for _, r in parts])
    if len(fits) > most_lengths:
        raise ValueError(f"vectors of {len(fits)} lengths; most_lengths is {most_lengths}")
    bases = {size: own.base for size, own in fits.items()}
    for size, cells in _summed(vectors, lambda x: _exact_products(x - bases[x.shape[1]])).items():
        own = fits[size]
        scatter = np.zeros((size, size))
        for (i, j), (_, total) in cells.items():
            scatter[i, j] = scatter[j, i] = (own.n * total - own.rest[i] * own.rest[j]) / own.n ** 2
        own.trace = float(scatter.trace())
        own.values, own.components = eigen(scatter, components)
    for size, error in _identity_errors(vectors, fits).items():
        fits[size].error = error
    return fits


def whitened(x: np.ndarray, own: Fit) -> np.ndarray:
    centred = (x - own.base) - np.array(own.rest, np.float64) / own.n
    return centred @ own.components / np.sqrt(own.values)


def _identity_errors(vectors: DataFrame, fits: dict[int, Fit]) -> dict[int, float]:
    """Largest distance of the projections' covariance from the identity, by length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for _, x in whole_numbers(batch):
                w = whitened(x, fits[x.shape[1]])
                w = np.column_stack([w, np.ones(len(w))])
                totals[x.shape[1]] = totals.get(x.shape[1], 0) + w.T @ w
        for size, total in totals.items():
            i, j = np.indices(total.shape).reshape(2, -1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(i), size, np.int32)), pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)),
                 pa.array(total.ravel())], ["size", "i", "j", "total"])

    rows = (vectors.select("vector").mapInArrow(run, "size int, i int, j int, total double")
            .groupBy("size", "i", "j").agg(F.sum("total").alias("total")).collect())
    out = {}
    for size in {r["size"] for r in rows}:
        count = len(fits[size].values)
        sums = np.zeros((count + 1, count + 1))
        for r in rows:
            if r["size"] == size:
                sums[r["i"], r["j"]] = r["total"]
        mean = sums[:-1, -1] / fits[size].n
        covariance = sums[:-1, :-1] / fits[size].n - np.outer(mean, mean)
        out[size] = float(np.abs(covariance - np.eye(count)).max(initial=0.0))
    return out


def _deviations(x: np.ndarray, own: Fit) -> list[int]:
    """Sum over dimensions of (n x - S)^2 by row, exact."""
    y, rest = x - own.base, np.array(own.rest, object)
    most = own.n * (float(np.abs(y).max()) + 1)
    if most * most * x.shape[1] < float(1 << 62):
        away = own.n * y - rest.astype(np.int64)
        return (away * away).sum(1).tolist()
    away = own.n * y.astype(object) - rest
    return [sum(v * v for v in row) for row in away.tolist()]


def whiten(embeddings: DataFrame, components: int = 8, id_column: str = "vec_id", vector_column: str = "embedding",
           most_lengths: int = 64) -> DataFrame:
    """Rows (vec_id, component, n, deviation, whitened, explained, identity_error), one for
    each usable vector and component; ``deviation`` is a decimal of 38 digits."""
    vectors = embeddings.select(F.col(id_column).alias("vec_id"), F.col(vector_column).alias("vector"))
    fits = fit(vectors, components, most_lengths)
    kind = vectors.schema["vec_id"].dataType.simpleString()
    names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, x in whole_numbers(batch):
                own = fits[x.shape[1]]
                count = len(own.values)
                if not count:
                    continue
                repeated = pa.array(np.repeat(np.arange(len(rows)), count))
                away = pa.array(_deviations(x, own), pa.decimal128(38, 0))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id").take(pa.array(rows)).take(repeated),
                     pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(rows))),
                     pa.array(np.full(len(repeated), own.n, np.int64)), away.take(repeated),
                     pa.array(whitened(x, own).ravel()), pa.array(np.tile(own.values / own.trace, len(rows))),
                     pa.array(np.full(len(repeated), own.error))], names)

    return vectors.mapInArrow(
        run, f"vec_id {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, "
             "identity_error double")
