"""Nearest neighbours by cosine over navigable small-world graphs, one per shard.

Equal vectors are one point of a graph, so a vector that a third of all rows share
cannot fill it.  Points are dealt to shards by a hash; a shard's graph is built from the
top layer down by inserting points, a batch at a time: each searches the graph of those
before it with a beam, looks at the others of its batch and links to a diverse choice of
what it has met; points that get more links than fit are thinned by the same rule.  Every
layer holds a fixed share of the one below; neighbours are flat arrays.  A query descends
from the top layer and searches the lowest with a beam; many queries or new points take
each step together.  The shards' results are merged.

Queries are a stated small set (by default ids divisible by 50) and meet each shard
in blocks.  Shards hold a bounded number of points, so a task's memory is bounded.

Vectors that are null or zero, or hold null or non-finite components take no part; vectors
of different lengths are searched apart, a pass for each length.  The score is the cosine of
the vectors as given, in double precision; ties go to the smaller id.  Rows with the same id
and vector count once; of one id with several vectors each counts.  An empty table gives no
rows.  Other columns are dropped, whatever their names.
"""

from __future__ import annotations

from functools import partial
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch

RESULT = "query_id long, vec_id long, score double"
GRAPH = ("shard int, size long, vectors binary, ids binary, sizes array<long>, points binary, neighbours binary")
QUERY_BLOCK = 4096
BATCH, CHUNK, DESCENT = 1024, 256, 4


def usable(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """Rows (vec_id, vector) that cosine is defined for; components as doubles."""
    return (
        vectors.select(F.col(id_column).cast("long").alias("vec_id"),
                       F.col(vector_column).cast("array<double>").alias("vector"))
        .where("vec_id is not null and vector is not null and size(vector) > 0")
        .where("forall(vector, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))")
        .where("exists(vector, x -> x <> 0)"))


def matrix(column: pd.Series) -> np.ndarray:
    """Vectors scaled to length one; scaled first by the largest component, so that
    squares neither overflow nor vanish."""
    raw = np.stack(column.to_numpy()).astype(np.float64)
    raw = raw / np.abs(raw).max(1, keepdims=True)
    return raw / np.sqrt(np.einsum("ij,ij->i", raw, raw))[:, None]


def scaled(column: pd.Series) -> np.ndarray:
    """Vectors times powers of two that bring their largest components near one: cosines
    stay the same to the last bit, and squares neither overflow nor vanish."""
    raw = np.stack(column.to_numpy()).astype(np.float64)
    return np.ldexp(raw, -np.frexp(np.abs(raw).max(1))[1][:, None])


def cosines(raw: np.ndarray, query: np.ndarray) -> np.ndarray:
    """One formula for each pair alone: equal vectors give equal scores."""
    norms = np.sqrt(np.einsum("ij,ij->i", raw, raw)) * np.sqrt(np.einsum("i,i->", query, query))
    return np.clip(np.einsum("ij,j->i", raw, query) / norms, -1.0, 1.0)


class Layer:
    """Points of one layer, and a row of neighbours of each; -1 fills the row."""

    def __init__(self, points: np.ndarray, width: int) -> None:
        self.points = points
        self.neighbours = np.full((len(points), width), -1, np.int32)


def _diverse(vectors: np.ndarray, own: np.ndarray, candidates: np.ndarray, most: int) -> np.ndarray:
    """For each point of ``own`` at most ``most`` of its row of candidates (-1 fills a row):
    by falling nearness, each only if nearer to the point than to those chosen; places left
    over go to the nearest passed over."""
    out = np.full((len(own), most), -1, np.int32)
    for at in range(0, len(own), CHUNK):
        part, mine = candidates[at:at + CHUNK], own[at:at + CHUNK]
        around = vectors[np.maximum(part, 0)]
        near = np.where(part >= 0, np.matmul(around, vectors[mine][:, :, None])[:, :, 0], -np.inf)
        order = np.argsort(-near, axis=1, kind="stable")
        part, near = np.take_along_axis(part, order, 1), np.take_along_axis(near, order, 1)
        around = np.take_along_axis(around, order[:, :, None], 1)
        among = np.matmul(around, around.transpose(0, 2, 1))
        chosen, count = np.zeros(part.shape, bool), np.zeros(len(part), np.int64)
        nearest = np.full(part.shape, -np.inf, among.dtype)  # to any chosen one
        for i in range(part.shape[1]):
            fits = (part[:, i] >= 0) & (count < most) & (near[:, i] >= nearest[:, i])
            chosen[:, i] = fits
            count += fits
            np.maximum(nearest, np.where(fits[:, None], among[:, :, i], -np.inf), out=nearest)
        passed = (part >= 0) & ~chosen
        chosen |= passed & (np.cumsum(passed, 1) <= (most - count)[:, None])
        kept = np.argsort(~chosen, axis=1, kind="stable")[:, :most]
        found = np.where(np.take_along_axis(chosen, kept, 1), np.take_along_axis(part, kept, 1), -1)
        out[at:at + CHUNK, :found.shape[1]] = found
    return out


def build(unit: np.ndarray, links: int = 16, candidates: int = 48, share: int = 16) -> list[Layer]:
    """Layers from the lowest to the top, built from the top: each layer's points are the
    first ones of the layer below, in the order of the rows of ``unit``."""
    vectors = unit.astype(np.float32)
    sizes = [len(unit)]
    while sizes[-1] > share:
        sizes.append(-(-sizes[-1] // share))
    layers: list[Layer] = []
    for level in range(len(sizes) - 1, -1, -1):
        layers.insert(0, _layer(vectors[:sizes[level]], layers, links if level else 2 * links, links, candidates))
    return layers


def _layer(vectors: np.ndarray, above: list[Layer], width: int, links: int, candidates: int) -> Layer:
    """A layer made by inserting its points a batch at a time: a point searches the graph
    of those before it, from where the layers above lead it, and the others of its batch;
    it links to a diverse choice, and whoever gets more links than fit keeps a diverse
    choice too."""
    layer = Layer(np.arange(len(vectors)), width)
    table, done = layer.neighbours, 0
    while done < len(vectors):
        end = min(len(vectors), done + min(BATCH, max(64, done)))
        new = np.arange(done, end)
        near = vectors[new] @ vectors[new].T
        np.fill_diagonal(near, -np.inf)
        most = min(candidates, len(new) - 1)
        met = [done + np.argpartition(-near, most - 1, axis=1)[:, :most]] if most else []
        if done:
            entry = _entries(vectors, above, vectors[new])
            found, _ = beams(vectors, table, vectors[new], np.where(entry < done, entry, 0), candidates)
            met.append(found)
        if met:
            own = _diverse(vectors, new, np.concatenate(met, axis=1), links)
            table[new, :links] = own
            _link_back(vectors, table, new, own)
        done = end
    return layer


def _link_back(vectors: np.ndarray, table: np.ndarray, new: np.ndarray, own: np.ndarray) -> None:
    """Every point that a new one links to links to it, too."""
    source, target = np.repeat(new, own.shape[1]), own.ravel()
    source, target = source[target >= 0], target[target >= 0]
    fresh = ~(table[target] == source[:, None]).any(1)
    source, target = source[fresh], target[fresh]
    order = np.argsort(target, kind="stable")
    source, target = source[order], target[order]
    points, firsts, counts = np.unique(target, return_index=True, return_counts=True)
    for least, most in ((0, 16), (16, 64), (64, len(new) + 1)):
        some = (counts > least) & (counts <= most)
        if not some.any():
            continue
        rows, wide = points[some], counts[some].max()
        places = firsts[some][:, None] + np.arange(wide)
        inside = np.arange(wide) < counts[some][:, None]
        arriving = np.where(inside, source[np.minimum(places, len(source) - 1)], -1)
        table[rows] = _diverse(vectors, rows, np.concatenate([table[rows], arriving], axis=1), table.shape[1])


def beams(vectors: np.ndarray, table: np.ndarray, queries: np.ndarray, entries: np.ndarray,
          beam: int) -> tuple[np.ndarray, np.ndarray]:
    """For all queries at once, from one entry each: the ``beam`` nearest points met when
    each of them has shown its neighbours, and their nearness; -1 fills a row."""
    count = len(queries)
    points, near = np.full((count, beam), -1, np.int32), np.full((count, beam), -np.inf, queries.dtype)
    fresh = np.zeros((count, beam), bool)
    points[:, 0], fresh[:, 0] = entries, True
    near[:, 0] = np.einsum("ij,ij->i", vectors[entries], queries)
    live = np.arange(count)
    while len(live):
        ahead = np.where(fresh[live], near[live], -np.inf)
        at = ahead.argmax(1)
        going = ahead[np.arange(len(live)), at] > -np.inf
        live, at = live[going], at[going]
        if not len(live):
            break
        fresh[live, at] = False
        shown = table[points[live, at]]
        new = (shown >= 0) & ~(shown[:, :, None] == points[live][:, None, :]).any(2)
        reached = np.where(new, np.matmul(vectors[np.maximum(shown, 0)], queries[live][:, :, None])[:, :, 0], -np.inf)
        all_near = np.concatenate([near[live], reached], axis=1)
        best = np.argpartition(-all_near, beam - 1, axis=1)[:, :beam]
        near[live] = np.take_along_axis(all_near, best, 1)
        points[live] = np.take_along_axis(np.concatenate([points[live], shown], axis=1), best, 1)
        fresh[live] = np.take_along_axis(np.concatenate([fresh[live], new], axis=1), best, 1)
    points[near == -np.inf] = -1
    return points, near


def _entries(vectors: np.ndarray, above: list[Layer], queries: np.ndarray) -> np.ndarray:
    """Where each query enters the layer below ``above``."""
    entry = np.zeros(len(queries), np.int64)
    for layer in reversed(above):
        points, near = beams(vectors, layer.neighbours, queries, entry, DESCENT)
        entry = points[np.arange(len(queries)), near.argmax(1)]
    return entry


def searched(unit: np.ndarray, layers: list[Layer], queries: np.ndarray, beam: int) -> np.ndarray:
    """Points met last for each query, at most ``beam``; -1 fills a row."""
    vectors, asked = unit.astype(np.float32), queries.astype(np.float32)
    found = [beams(vectors, layers[0].neighbours, part, _entries(vectors, layers[1:], part), beam)[0]
             for part in np.array_split(asked, -(-len(asked) // BATCH))]
    return np.concatenate(found)


def search(unit: np.ndarray, layers: list[Layer], query: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Points met last for one query and their nearness, nearest first, at most ``beam``."""
    found = searched(unit, layers, query[None], beam)[0]
    found = found[found >= 0].astype(np.int64)
    near = unit[found] @ query
    order = np.lexsort((found, -near))
    return found[order], near[order]


def _unit(raw: np.ndarray) -> np.ndarray:
    return raw / np.sqrt(np.einsum("ij,ij->i", raw, raw))[:, None]


def _graph_row(group: pd.DataFrame, links: int, most: int) -> pd.DataFrame:
    """A shard's points and graph as one row of flat arrays."""
    # Points enter the graph in an order that is the same in every run and has
    # nothing to do with their ids.
    group = group.sort_values(["point", "first_id"])
    order = np.random.default_rng(0).permutation(len(group))
    raw = scaled(group["vector"].iloc[order])
    ids = np.full((len(group), most), -1, np.int64)
    for row, own in enumerate(group["ids"].iloc[order]):
        ids[row, :len(own)] = own
    layers = build(_unit(raw), links)
    return pd.DataFrame([{
        "shard": group["shard"].iloc[0], "size": len(group), "vectors": raw.tobytes(), "ids": ids.tobytes(),
        "sizes": [len(x.points) for x in layers], "points": np.concatenate([x.points for x in layers]).tobytes(),
        "neighbours": np.concatenate([x.neighbours.ravel() for x in layers]).tobytes()}])


def _answers(graph: pd.DataFrame, queries: pd.DataFrame, k: int, beam: int) -> pd.DataFrame:
    if graph.empty or queries.empty:
        return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
    row = graph.iloc[0]
    raw = np.frombuffer(row["vectors"]).reshape(row["size"], -1)
    unit = _unit(raw)
    ids = np.frombuffer(row["ids"], np.int64).reshape(row["size"], -1)
    points, flat = np.frombuffer(row["points"], np.int64), np.frombuffer(row["neighbours"], np.int32)
    width = len(flat) // max(1, len(points) + row["size"])  # the lowest layer's rows are twice as wide
    layers, point_at, flat_at = [], 0, 0
    for i, size in enumerate(row["sizes"]):
        own_width = width if i else 2 * width
        layer = Layer(points[point_at:point_at + size], 0)
        layer.neighbours = flat[flat_at:flat_at + size * own_width].reshape(size, own_width)
        layers.append(layer)
        point_at, flat_at = point_at + size, flat_at + size * own_width
    out = []
    asked = scaled(queries["vector"])
    for own, met, given in zip(queries["vec_id"].tolist(), searched(unit, layers, _unit(asked), beam), asked, strict=True):
        found = met[met >= 0]
        scores = cosines(raw[found], given)
        # One more than asked for, as the query's own does not count, and all that tie with it.
        order = np.argsort(-scores, kind="stable")
        best = order[scores[order] >= scores[order[min(k, len(order) - 1)]]]
        pairs = sorted((-s, i) for p, s in zip(found[best], scores[best].tolist(), strict=True)
                       for i in ids[p].tolist() if i >= 0 and i != own)[:k]
        out += [(own, i, -s) for s, i in pairs]
    return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])


def nearest(vectors: DataFrame, k: int = 5, every: int = 50, shard_points: int = 65_536, shards: int = 8,
            links: int = 16, beam: int = 96, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """Rows (query_id, rank, vec_id, score): the ``k`` nearest other rows found for each
    row whose id is divisible by ``every``.

    A shard has ``shard_points`` points at most on average; there are ``shards`` at least.
    """
    spark, scratch = vectors.sparkSession, Scratch(vectors.sparkSession)
    rows = scratch.write(usable(vectors, id_column, vector_column).distinct()
                         .withColumn("point", F.xxhash64("vector")), "vectors")
    sizes = [r["size"] for r in rows.select(F.size("vector").alias("size")).distinct().orderBy("size").collect()]
    result = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    for size in sizes:
        found = _nearest(rows.where(F.size("vector") == size), scratch, k, every, shard_points, shards, links, beam)
        result = found if size == sizes[0] else result.union(found)
    return result


def _nearest(rows: DataFrame, scratch: Scratch, k: int, every: int, shard_points: int, shards: int, links: int,
             beam: int) -> DataFrame:
    """The search among vectors of one length."""
    # Of equal vectors the smallest ids are all that can be among the nearest: one
    # more than asked for, as the query's own does not count.
    first = rows.selectExpr("*", f"row_number() over (partition by point, vector order by vec_id) n").where(f"n <= {k + 1}")
    points = scratch.write(first.groupBy("point", "vector").agg(
        F.min("vec_id").alias("first_id"), F.sort_array(F.collect_list("vec_id")).alias("ids")), "points")
    count = max(shards, -(-points.count() // shard_points))
    queries = rows.where(F.col("vec_id") % every == 0).select("vec_id", "vector")
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    asked = (queries.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"))
             .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(count - 1)))))
    # One graph a shard, written as flat arrays and read by every block of queries.
    graphs = scratch.write(
        points.withColumn("shard", F.pmod("point", F.lit(count)).cast("int")).groupBy("shard")
        .applyInPandas(partial(_graph_row, links=links, most=k + 1), GRAPH), "graphs")
    held = graphs.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    found = (held.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block"))
             .applyInPandas(partial(_answers, k=k, beam=beam), RESULT))
    return (found.selectExpr("*", "row_number() over (partition by query_id order by score desc, vec_id) rank")
            .where(f"rank <= {k}").select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
