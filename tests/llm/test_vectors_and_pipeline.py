"""Vector operators against brute force, the classifier on labels held out, the pipeline."""

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tests.conftest import DATA
from tests.llm.samples import documents
from tidemark.llm import hnsw, pq_dedup, quality
from tidemark.llm.common import Scratch, components


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(40, 32))
    near = np.repeat(base, 25, 0) + rng.normal(scale=0.12, size=(1000, 32))
    rows = [(i, v.tolist(), 0, "x", 1) for i, v in enumerate(near)]
    rows += [(1000 + i, near[0].tolist(), 0, "x", 1) for i in range(400)]
    rows += [(2000, None, 0, "x", 1), (2050, [0.0] * 32, 0, "x", 1), (2100, [float("nan")] * 32, 0, "x", 1),
             (2150, [None] * 32, 0, "x", 1), (2200, [1.0], 0, "x", 1), (None, near[5].tolist(), 0, "x", 1), (2250, [], 0, "x", 1)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, point string, cls int")


def good(vectors):
    rows = [r for r in vectors.collect() if r.vec_id is not None and r.vec_id < 2000]
    raw = np.array([r.embedding for r in rows])
    return np.array([r.vec_id for r in rows]), raw / np.linalg.norm(raw, axis=1)[:, None]


def test_near_duplicate_vectors(vectors):
    ids, unit = good(vectors)
    linked = unit @ unit.T >= 0.95
    label = ids.copy()
    for _ in range(50):
        label = np.array([label[row].min() for row in linked])
    found = {r.vec_id: r for r in pq_dedup.near_duplicates(vectors, list_size=64).collect()}
    assert len(found) == vectors.count()
    counts = np.array([found[i].n_links for i in ids])
    true = linked.sum(1) - 1
    assert (counts <= true).all() and counts.sum() >= 0.98 * true.sum()
    assert np.mean([found[i].component_id == c for i, c in zip(ids, label)]) > 0.98
    for i in (2000, 2050, 2100, 2150, 2200, 2250):
        assert tuple(found[i])[1:] == (0, i, True)
    assert tuple(found[None]) == (None, 0, None, False)
    assert pq_dedup.near_duplicates(vectors.limit(0)).count() == 0


def test_every_link_of_a_hot_group_over_many_lists(spark):
    rng = np.random.default_rng(4)
    near = rng.normal(size=64) + rng.normal(scale=0.2, size=(1000, 64))
    raw = np.concatenate([near, rng.normal(size=(2000, 64))])
    unit = raw / np.linalg.norm(raw, axis=1)[:, None]
    linked = unit @ unit.T >= 0.95
    label = np.arange(len(raw))
    for _ in range(50):
        label = np.array([label[row].min() for row in linked])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(raw)], "vec_id long, embedding array<double>")
    rows = sorted(pq_dedup.near_duplicates(df, list_size=16).collect())
    assert sum(linked[0]) > 100
    assert [r.n_links for r in rows] == (linked.sum(1) - 1).tolist()
    assert [r.component_id for r in rows] == label.tolist()


def test_nearest_vectors(vectors):
    ids, unit = good(vectors)
    found = hnsw.nearest(vectors, shards=3).collect()
    hits = total = 0
    for q in ids[ids % 50 == 0]:
        own = sorted((r for r in found if r.query_id == q), key=lambda r: r.rank)
        assert [r["rank"] for r in own] == [1, 2, 3, 4, 5]
        score = unit @ unit[np.searchsorted(ids, q)]
        score[ids == q] = -2
        best = ids[np.lexsort((ids, -np.round(score, 12)))[:5]]
        hits, total = hits + len({r.vec_id for r in own} & set(best.tolist())), total + 5
        assert np.allclose([r.score for r in own], score[np.searchsorted(ids, [r.vec_id for r in own])], atol=1e-12)
    assert hits >= 0.9 * total
    assert {r.query_id for r in found} == set(ids[ids % 50 == 0].tolist())
    assert hnsw.nearest(vectors.limit(0)).count() == 0


def test_recall_of_a_full_shard():
    rng = np.random.default_rng(5)
    unit = rng.normal(size=(200, 64))[rng.integers(0, 200, 8192)] + rng.normal(scale=0.35, size=(8192, 64))
    unit[:2730] = rng.normal(size=64) + rng.normal(scale=0.2, size=(2730, 64))
    unit = rng.permutation(unit / np.linalg.norm(unit, axis=1)[:, None])
    graph, hits = hnsw.build(unit), 0
    for q in range(200):
        near = unit @ unit[q]
        near[q] = -2
        found = [p for p in hnsw.search(unit, graph, unit[q], 96)[0].tolist() if p != q][:5]
        hits += len(set(found) & set(np.argsort(-near)[:5].tolist()))
    assert hits >= 0.9 * 1000


def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, i) for i in range(101, 200)] + [(300, 300)]
    df = spark.createDataFrame(edges, "a long, b long")
    found = dict(map(tuple, components(df, Scratch(spark)).collect()))
    assert found == {i: 0 for i in range(51)} | {i: 100 for i in range(100, 200)}


def test_quality_on_labels_held_out(spark):
    folder = f"{DATA}/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    scored = quality.score(docs, quality.train(docs, labels.where("doc_id % 4 <> 0"), rounds=1))
    judged = scored.join(labels.where("doc_id % 4 = 0").select("doc_id", F.col("quality").alias("truth")), "doc_id")
    right = judged.select(F.avg((F.col("is_good") == (F.col("truth") == 1)).cast("int"))).first()[0]
    assert right > 0.98
    assert scored.count() == docs.count()


def test_quality_of_awkward_rows(spark):
    docs = documents(spark)
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (99, 0)], "doc_id long, quality int")
    for some in (labels, labels.limit(0)):
        rows = quality.score(docs, quality.train(docs, some), keep=("n_chars", "kept")).collect()
        assert len(rows) == docs.count() and all(0 <= r.quality <= 1 for r in rows)
    assert quality.score(docs.limit(0), quality.train(docs.limit(0), labels)).count() == 0


def test_pipeline_stage_by_stage(spark):
    folder = f"{DATA}/sf0.001"
    docs, scratch = spark.read.parquet(f"{folder}/documents.parquet"), Scratch(spark)
    columns, seen = docs.columns, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = scratch.write(stage(spark, docs, folder), name)
        assert kept.columns == columns
        assert kept.join(docs, "doc_id", "left_anti").count() == 0
        seen.append((docs.count(), kept.count()))
        docs = kept
    assert seen[0][1] < seen[0][0] and seen[2][1] < seen[2][0]
    assert seen[1][0] == seen[1][1] and seen[3][0] == seen[3][1]
    pieces = corpus_pipeline.pack_windows(spark, docs, folder).collect()
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    assert sum(p.length for p in pieces) == sum(
        1 + len(library.encode(r.text or "", add_special_tokens=False).ids) for r in docs.collect())
