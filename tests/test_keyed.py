"""Keyed tables merged when read, batches into bronze, merged streams, the appended log."""

import json
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from tidemark.contracts import SOURCE_COLUMNS
from tidemark.operators.conform import RunInfo, latest
from tidemark.operators.upsert import DuplicateKeyError
from tidemark.plans.audit import RunLog, compact_run_log, run_log
from tidemark.session import file_system, fresh_location, materialise
from tidemark.sources import csv_batch
from tidemark.sources.keyed import ConcurrentChange, KeyedLayer
from tidemark.streaming import keyed_upsert


@pytest.fixture
def layer(spark):
    return KeyedLayer(spark, fresh_location(spark, "keyed"), buckets=8)


def rows(spark, *values):
    return spark.createDataFrame(list(values), "k int, v string")


def content(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def files(spark, folder):
    fs, path = file_system(spark, folder)
    return sorted((s.getPath().toString(), s.getModificationTime()) for s in fs.listStatus(path))


# --- keyed tables --------------------------------------------------------------------

def test_changes_are_written_alone_and_the_last_one_wins(spark, layer):
    layer.upsert("t", rows(spark, *((i, "base") for i in range(100))), ["k"])
    base = layer.state().tables["t"].base
    before = {b: files(spark, f) for b, f in base.items()}
    layer.upsert("t", rows(spark, (1, "a"), (200, "new")), ["k"])
    layer.upsert("t", rows(spark, (1, "b"), (2, None)), ["k"])
    table = layer.state().tables["t"]
    assert table.base == base and {b: files(spark, f) for b, f in base.items()} == before
    assert 1 <= len(table.touched()) <= 3
    expected = [(i, "base") for i in range(100) if i not in (1, 2)] + [(1, "b"), (2, None), (200, "new")]
    assert content(layer.read("t")) == sorted(expected, key=str)


def test_a_fold_rewrites_touched_buckets_only(spark, layer):
    layer.upsert("t", rows(spark, *((i, "base") for i in range(100))), ["k"])
    layer.upsert("t", rows(spark, (1, "a"), (2, "b")), ["k"])
    old = layer.state().tables["t"]
    before = {b: files(spark, f) for b, f in old.base.items()}
    expected = content(layer.read("t"))
    assert layer.fold("t", least_share=1e9) == []
    folded = layer.fold("t")
    new = layer.state().tables["t"]
    assert folded == old.touched() and new.changes == ()
    for bucket, folder in old.base.items():
        assert (new.base[bucket] == folder) == (bucket not in folded)
        assert files(spark, folder) == before[bucket]
    assert content(layer.read("t")) == expected and layer.fold("t") == []
    assert layer.remove_unused("t") == 1 and content(layer.read("t")) == expected


def test_buckets_with_few_changes_wait(spark, layer):
    layer.upsert("t", rows(spark, *((i, "base" * 50) for i in range(400))), ["k"])
    changed = [i for i in range(400) if i % 7 == 0]
    layer.upsert("t", rows(spark, *((i, "x" * i) for i in changed)), ["k"])
    layer.upsert("t", rows(spark, (0, "last")), ["k"])
    expected = content(layer.read("t"))
    size = {b: sum(r[1] for r in [(0, 0)]) for b in layer.state().tables["t"].touched()}
    for share in (0.9, 0.5, 0.2, 0.0):
        folded = layer.fold("t", share)
        left = layer.state().tables["t"]
        assert set(folded).isdisjoint(left.touched()) and set(folded) <= set(size)
        assert content(layer.read("t")) == expected
    assert left.changes == ()


def test_rows_without_a_key_and_empty_changes(spark, layer):
    layer.upsert("t", rows(spark, (1, "a"), (None, "x"), (None, "x")), ["k"])
    layer.upsert("t", rows(spark, (None, "x"), (None, "y")), ["k"])
    layer.upsert("t", rows(spark), ["k"])
    assert content(layer.read("t")) == sorted([(1, "a"), *[(None, "x")] * 3, (None, "y")], key=str)
    layer.fold("t")
    assert content(layer.read("t")) == sorted([(1, "a"), *[(None, "x")] * 3, (None, "y")], key=str)
    layer.upsert("empty", rows(spark), ["k"])
    assert layer.exists("empty") and layer.read("empty").columns == ["k", "v"]
    assert layer.read("empty").count() == 0
    layer.upsert("empty", rows(spark, (1, "a")), ["k"])
    layer.fold("empty")
    assert content(layer.read("empty")) == [(1, "a")]


def test_what_does_not_fit_is_refused_and_leaves_nothing(spark, layer):
    layer.upsert("t", rows(spark, (1, "a")), ["k"])
    state = layer.state()
    with pytest.raises(DuplicateKeyError):
        layer.upsert("t", rows(spark, (2, "a"), (2, "b")), ["k"])
    with pytest.raises(ValueError, match="keyed by"):
        layer.stage("t", rows(spark, (2, "a")), ["v"])
    with pytest.raises(ValueError, match="columns"):
        layer.stage("t", rows(spark, (2, "a")).withColumn("w", F.lit(1)), ["k"])
    assert layer.state() == state
    fs, path = file_system(spark, f"{layer.root}/t")
    assert len(fs.listStatus(path)) == 1


def test_several_tables_switch_at_once_and_batches_count_once(spark, layer):
    staged = [layer.stage(name, rows(spark, (1, name)), ["k"]) for name in ("a", "b")]
    assert not layer.exists("a") and not layer.exists("b")
    layer.commit(staged, ("s", 0))
    assert layer.state().version == 1 and layer.exists("a") and layer.exists("b")
    layer.upsert("a", rows(spark, (1, "again")), ["k"], stream=("s", 0))
    assert layer.state().version == 1 and content(layer.read("a")) == [(1, "a")]
    layer.upsert("a", rows(spark, (1, "next")), ["k"], stream=("s", 1))
    assert content(layer.read("a")) == [(1, "next")]


def test_writers_at_the_same_time_lose_nothing(spark, layer):
    layer.upsert("t", rows(spark, (0, "base")), ["k"])
    with ThreadPoolExecutor(6) as pool:
        list(pool.map(lambda i: layer.upsert("t", rows(spark, (i, "x")), ["k"]), range(1, 7)))
    assert content(layer.read("t")) == sorted([(0, "base")] + [(i, "x") for i in range(1, 7)], key=str)
    assert layer.state().version == 7


def test_a_change_during_a_fold_is_kept_and_two_folds_conflict(spark, layer, monkeypatch):
    layer.upsert("t", rows(spark, (1, "a"), (2, "a")), ["k"])
    layer.upsert("t", rows(spark, (1, "b")), ["k"])
    merged, other = layer._merged, KeyedLayer(spark, layer.root, buckets=8)

    def during(table, buckets):
        other.upsert("t", rows(spark, (1, "c"), (3, "c")), ["k"])
        return merged(table, buckets)

    monkeypatch.setattr(layer, "_merged", during)
    layer.fold("t")
    assert content(other.read("t")) == [(1, "c"), (2, "a"), (3, "c")]

    def folded_by_another(table, buckets):
        other.fold("t")
        return merged(table, buckets)

    monkeypatch.setattr(layer, "_merged", folded_by_another)
    with pytest.raises(ConcurrentChange):
        layer.fold("t")
    assert content(other.read("t")) == [(1, "c"), (2, "a"), (3, "c")]


def test_untouched_buckets_are_read_without_a_join(spark, layer):
    layer.upsert("t", rows(spark, *((i, "base") for i in range(100))), ["k"])
    assert "Join" not in layer.read("t")._jdf.queryExecution().executedPlan().toString()
    layer.upsert("t", rows(spark, (1, "a")), ["k"])
    assert len(layer.state().tables["t"].touched()) == 1


def test_store_merges_without_a_rewrite(spark, store):
    for n in range(20):
        merged = store.merge(rows(spark, (n % 3, str(n)), (100 + n, "x")), "control", "t", ["k"])
    assert {r.k: r.v for r in merged.collect()} == {0: "18", 1: "19", 2: "17"} | {100 + n: "x" for n in range(20)}
    assert len(store.keyed("control").state().tables["t"].changes) <= 16
    assert store.exists("control", "t") and store.count("control", "t") == 23


# --- batches into bronze ---------------------------------------------------------------

def batch(tmp_path, name, **tables):
    folder = tmp_path / name
    folder.mkdir()
    (folder / "manifest.json").write_text(json.dumps({"classification": csv_batch.CLASSIFICATION}))
    for table, lines in tables.items():
        head = list(SOURCE_COLUMNS[table])
        text = [",".join(head), *(",".join([*line, *[""] * (len(head) - len(line))]) for line in lines)]
        (folder / f"{table}.csv").write_text("\n".join(text) + "\n")
    return str(folder)


def test_batches_are_merged_into_bronze(spark, layer, tmp_path):
    csv_batch.merge_batch(layer, batch(tmp_path, "one", DEVICES=[("D1", "C1"), ("D2", "C2")], MERCHANTS=[("M1", "one")]))
    merged = csv_batch.merge_batch(layer, batch(tmp_path, "two", DEVICES=[("D2", "C9"), ("D3", "C3")]))
    assert list(merged) == ["DEVICES"]
    found = {(r.DEVICE_ID, r.CUSTOMER_ID) for r in layer.read("DEVICES").collect()}
    assert found == {("D1", "C1"), ("D2", "C9"), ("D3", "C3")}
    assert layer.read("MERCHANTS").count() == 1 and layer.state().version == 2


@pytest.mark.parametrize("bad", [[("M2", "x"), ("M2", "y")], [("M2", *"x" * 20)]])
def test_a_failing_table_changes_none(spark, layer, tmp_path, bad):
    csv_batch.merge_batch(layer, batch(tmp_path, "one", DEVICES=[("D1", "C1")], MERCHANTS=[("M1", "one")]))
    before = layer.state()
    with pytest.raises(Exception):
        csv_batch.merge_batch(layer, batch(tmp_path, "two", DEVICES=[("D1", "C9")], MERCHANTS=bad))
    assert layer.state() == before
    assert [tuple(r)[:2] for r in layer.read("DEVICES").collect()] == [("D1", "C1")]
    fs, path = file_system(spark, f"{layer.root}/DEVICES")
    assert len(fs.listStatus(path)) == 1


# --- merged streams ----------------------------------------------------------------------

SCHEMA = "k int, t int, v string"


def arrive(spark, root, number, *values):
    spark.createDataFrame(list(values), SCHEMA).coalesce(1).write.parquet(f"{root}/landing/load={number}")


def run(spark, root, layer, checkpoint="checkpoint"):
    schema = spark.createDataFrame([], SCHEMA).schema
    query = keyed_upsert.start_keyed_merge(spark, f"{root}/landing", schema, layer, "t", ["k"], ["t"], f"{root}/{checkpoint}", 1)
    query.awaitTermination()
    return [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]]


def test_only_new_files_are_read_and_late_rows_lose(spark, layer):
    root = fresh_location(spark, "stream")
    arrive(spark, root, 1, (1, 10, "a"), (2, 10, "b"))
    assert run(spark, root, layer) == [2]
    arrive(spark, root, 2, (1, 5, "late"), (3, 1, "c"), (3, 2, "d"))
    assert run(spark, root, layer) == [3]
    assert run(spark, root, layer) == []
    expected = [(1, 10, "a"), (2, 10, "b"), (3, 2, "d")]
    assert content(layer.read("t")) == expected
    table = layer.state().tables["t"]
    arrive(spark, root, 3, (1, 5, "late"), (3, 2, "d"))  # replayed rows change nothing
    assert run(spark, root, layer) == [2]
    assert content(layer.read("t")) == expected and layer.state().tables["t"] == table


def test_a_repeated_batch_is_taken_once(spark, layer):
    root = fresh_location(spark, "stream")
    arrive(spark, root, 1, (1, 1, "a"))
    run(spark, root, layer)
    state = layer.state()
    fs, path = file_system(spark, f"{root}/checkpoint/commits/0")
    fs.delete(path, False)  # as if the process had died before Spark noted the batch
    run(spark, root, layer)
    assert layer.state() == state
    run(spark, root, layer, "another-checkpoint")  # a new query reads all files again
    assert content(layer.read("t")) == [(1, 1, "a")]


# --- the run log ---------------------------------------------------------------------------

def test_events_are_appended_and_the_last_one_counts(spark, store):
    log = RunLog(store, RunInfo("r", "2024-01-01"), longest_message=5)
    with pytest.raises(KeyError), log.stage("s", announce=True):
        raise KeyError("long message")
    assert [(r.status, r.error_message) for r in run_log(store).collect()] == [("Failed", "'long")]
    fs, path = file_system(spark, f"{store.root}/control/control_pipeline_run_log")
    assert len(fs.listStatus(path)) == 2
    with log.stage("s") as counts:
        counts.rows_read = 3
    assert [(r.status, r.rows_read) for r in run_log(store).collect()] == [("Succeeded", 3)]
    before = content(run_log(store))
    assert compact_run_log(store) == 3 and len(fs.listStatus(path)) == 1
    assert content(run_log(store)) == before


def test_two_runs_at_once_lose_no_row(spark, store):
    def stages(run_id):
        log = RunLog(store, RunInfo(run_id))
        for n in range(5):
            with log.stage(f"s{n}", announce=True):
                pass

    with ThreadPoolExecutor(2) as pool:
        list(pool.map(stages, ("a", "b")))
    assert content(run_log(store).select("pipeline_run_id", "stage", "status")) == [
        (r, f"s{n}", "Succeeded") for r in "ab" for n in range(5)]


def test_an_empty_log_has_its_columns(store):
    assert run_log(store).count() == 0 and "stage" in run_log(store).columns


# --- latest rows in one pass -----------------------------------------------------------------

def test_latest_scans_once_and_keeps_rows_without_a_key(spark):
    values = [(i % 50, i, "x") for i in range(200)] + [(None, 1, "y")] * 30 + [(None, 2, "z"), (7, 199, "x"), (7, 199, "x")]
    df = materialise(spark.createDataFrame(values, "k int, t int, v string").repartition(7), "one-pass")
    found = latest(df, ["k"], ["t"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1 and plan.count("WindowGroupLimit") == 2
    assert found.columns == ["k", "t", "v"]
    keyed = [(k, 199 if k == 7 else 150 + k, "x") for k in range(50)]
    assert content(found) == sorted(keyed + [(None, 1, "y")] * 30 + [(None, 2, "z")], key=str)
    grouped = latest(df.withColumn("k", F.col("k").cast("string")), ["k"], ["t"], group="g")
    assert grouped.count() == 81 and grouped.filter("k IS NOT NULL AND g <> k").count() == 0
