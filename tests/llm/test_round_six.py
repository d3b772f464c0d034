"""What workers hold at once in the quality step."""

import random
import tracemalloc

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import quality
from tidemark.session import BATCH_BYTES, BATCH_SETTING

DOCS, LABELS = "doc_id long, text string, lang string, source string", "doc_id long, quality int"


@pytest.fixture
def batch_setting(spark):
    before = spark.conf.get(BATCH_SETTING)
    yield spark.conf
    spark.conf.set(BATCH_SETTING, before)


def _sizes(batches):
    yield from (pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], ["n", "bytes"]) for b in batches)


def test_rows_go_to_workers_a_few_megabytes_at_a_time(spark, batch_setting):
    docs = spark.range(0, 3000, 1, 1).select(
        F.col("id").alias("doc_id"), F.expr("repeat(concat('w', id, ' '), 1200)").alias("text"),
        F.lit("en").alias("lang"), F.lit("web").alias("source"))
    labels = spark.createDataFrame([(1, 1), (2, 0)], LABELS)
    classifier = quality.train(docs.where("doc_id < 9"), labels, rounds=0)
    sizes = docs.mapInArrow(_sizes, "n long, bytes long").collect()
    assert sum(s.n for s in sizes) == 3000 and sum(s.bytes for s in sizes) > 3 * BATCH_BYTES
    assert max(s.bytes for s in sizes) < 1.2 * BATCH_BYTES
    assert quality.score(docs, classifier).count() == 3000


def test_training_turns_no_ids_into_rows_of_objects(spark, batch_setting, monkeypatch):
    docs = spark.createDataFrame([(i, "good words here" if i % 2 else "BAD $$$", "en", "web") for i in range(40)], DOCS)
    labels = spark.createDataFrame([(i, i % 2) for i in range(30)], LABELS)
    made, create = [], spark.createDataFrame
    monkeypatch.setattr(spark, "createDataFrame", lambda data, *a, **b: made.append(type(data)) or create(data, *a, **b))
    classifier = quality.train(docs, labels)
    monkeypatch.undo()
    assert made and set(made) == {pa.Table}
    assert all(r.is_good == r.doc_id % 2 for r in quality.score(docs, classifier).collect())


@pytest.mark.parametrize(("before", "after"), [("64m", BATCH_BYTES), ("1m", "1m"), ("9000", "9000")])
def test_smaller_batches_stay(spark, batch_setting, before, after):
    batch_setting.set(BATCH_SETTING, before)
    docs = spark.createDataFrame([(1, "a b", "en", "web")], DOCS)
    quality.train(docs, spark.createDataFrame([], "doc_id long, quality int"))
    assert batch_setting.get(BATCH_SETTING) == str(after)


def test_features_are_made_a_megabyte_at_a_time():
    rng = random.Random(3)
    texts = [" ".join(rng.choices(["alpha", "Beta,", "gamma", "12", "delta."], k=2000)) for _ in range(700)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array(["en"] * 700), pa.array(["web"] * 700)],
                                       ["text", "lang", "source"])
    whole = quality.Views().of(batch)
    assert batch.column("text").nbytes > 7e6
    reader, at, found, owners = quality.Views(), 0, [], []
    tracemalloc.start()
    for part, views in reader.parts(batch):
        found.append(len(views[0]))
        owners.append(len(part))
        at = max(at, tracemalloc.get_traced_memory()[1])
    tracemalloc.stop()
    assert sum(found) == len(whole[0]) and sum(owners) == 700 and len(found) > 6
    assert at < 50e6
