import json

import pytest
from pyspark.sql import functions as F

from tidemark.contracts import SOURCE_COLUMNS
from tidemark.session import fresh_location
from tidemark.sources import csv_batch, fixtures
from tidemark.streaming import keyed_upsert
from tests.conftest import DATA

HEADER = list(SOURCE_COLUMNS["DEVICES"])


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return str(path)


# --- CSV batches -----------------------------------------------------------------

def test_empty_fields_are_null_and_header_case_is_ignored(spark, tmp_path):
    line = ",".join(["DEVICE-000001", "CUST-000001", '""', *[""] * (len(HEADER) - 3)])
    path = write(tmp_path / "d.csv", ",".join(HEADER).lower() + "\n" + line + "\n")
    row = csv_batch.read_csv(spark, "DEVICES", path).first()
    assert row["DEVICE_ID"] == "DEVICE-000001"
    assert [v for v in row[2:]] == [None] * (len(HEADER) - 2)


def test_quoted_json_survives(spark, tmp_path):
    values = ["D", "C", *[""] * 7, '"[{""type"":""emulator"",""score"":0.75}]"', "initial"]
    path = write(tmp_path / "d.csv", ",".join(HEADER) + "\n" + ",".join(values) + "\n")
    assert csv_batch.read_csv(spark, "DEVICES", path).first()["RISK_SIGNALS_JSON"] == (
        '[{"type":"emulator","score":0.75}]')


def test_line_breaks_in_fields_survive_and_odd_lines_fail(spark, tmp_path):
    values = ["D", "C", *[""] * 7, '"two\nlines"', "initial"]
    head = ",".join(HEADER) + "\n"
    path = write(tmp_path / "d.csv", head + ",".join(values) + "\n")
    rows = csv_batch.read_csv(spark, "DEVICES", path).collect()
    assert [r["RISK_SIGNALS_JSON"] for r in rows] == ["two\nlines"]
    for name, fields in (("long", [*values, "more"]), ("short", values[:5])):
        path = write(tmp_path / f"{name}.csv", head + ",".join(fields) + "\n")
        with pytest.raises(Exception, match="MALFORMED|FAILFAST|malformed"):
            csv_batch.read_csv(spark, "DEVICES", path).collect()


@pytest.mark.parametrize("header", [
    HEADER[:-1], [*HEADER, "EXTRA"], [*HEADER[:-1], HEADER[0]],
    [*HEADER[:-1], "SOURCE_BATCH) VALUES (1); DROP TABLE DEVICES --"],
    [HEADER[1], HEADER[0], *HEADER[2:]], []])
def test_foreign_headers_are_refused(spark, tmp_path, header):
    path = write(tmp_path / "d.csv", ",".join(f'"{h}"' for h in header) + "\n")
    with pytest.raises(csv_batch.ContractError):
        csv_batch.read_csv(spark, "DEVICES", path)
    with pytest.raises(csv_batch.ContractError):
        csv_batch.read_csv(spark, "SECRETS", path)


def batch(tmp_path, classification=csv_batch.CLASSIFICATION, header=HEADER):
    write(tmp_path / "b" / "manifest.json", json.dumps(
        {"classification": classification, "batch": "initial", "counts": {"DEVICES": 1}},
        indent=2))
    write(tmp_path / "b" / "DEVICES.csv",
          ",".join(header) + "\n" + ",".join(["D", "C", *[""] * (len(HEADER) - 2)]) + "\n")
    return str(tmp_path / "b")


def test_only_tables_in_the_batch_are_loaded(spark, tmp_path):
    tables = csv_batch.load_batch(spark, batch(tmp_path))
    assert list(tables) == ["DEVICES"] and tables["DEVICES"].count() == 1
    manifest = csv_batch.read_manifest(spark, str(tmp_path / "b"))
    assert csv_batch.manifest_counts(spark, manifest).collect() == [("DEVICES", 1)]


def test_batch_gate(spark, tmp_path):
    with pytest.raises(csv_batch.ContractError, match="classified"):
        csv_batch.load_batch(spark, batch(tmp_path / "x", classification="CUSTOMER_DATA"))
    with pytest.raises(csv_batch.ContractError, match="header"):
        csv_batch.load_batch(spark, batch(tmp_path / "y", header=HEADER[::-1]))


def test_every_file_of_a_folder_is_held_to_the_header(spark, tmp_path):
    good = ",".join(HEADER) + "\n" + ",".join(["D", *[""] * (len(HEADER) - 1)]) + "\n"
    write(tmp_path / "f" / "a.csv", good)
    write(tmp_path / "f" / "b.csv", good.replace("DEVICE_ID", "OTHER_ID"))
    with pytest.raises(Exception):
        csv_batch.read_csv(spark, "DEVICES", str(tmp_path / "f")).collect()


# --- layer tables ------------------------------------------------------------------

def test_a_replaced_table_may_be_read_by_its_own_plan(spark, store):
    store.replace(spark.range(10), "silver", "t")
    store.replace(store.read("silver", "t").filter("id > 5"), "silver", "t")
    assert store.count("silver", "t") == 4


def test_schema_is_replaced_with_the_table(spark, store):
    store.replace(spark.range(3), "silver", "t")
    store.replace(spark.range(2).select(F.lit("x").alias("name")), "silver", "t")
    assert store.read("silver", "t").columns == ["name"]
    assert store.count("silver", "t") == 2


def test_an_empty_table_keeps_its_schema(spark, store):
    store.replace(spark.range(0).withColumn("v", F.lit(1.5)), "silver", "t")
    assert store.read("silver", "t").columns == ["id", "v"]
    assert store.count("silver", "t") == 0


def test_a_failed_write_leaves_the_table_as_it_was(spark, store):
    store.replace(spark.range(3), "silver", "t")
    broken = spark.range(3).withColumn("id", F.raise_error(F.lit("no")).cast("bigint"))
    with pytest.raises(Exception):
        store.replace(broken, "silver", "t")
    assert store.count("silver", "t") == 3


def test_partitioned_tables_prune(spark, store):
    df = spark.range(100).withColumn("d", (F.col("id") % 4).cast("int"))
    table = store.replace(df, "gold", "t", ("d",))
    assert table.filter("d = 1").count() == 25
    plan = table.filter("d = 1")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(d" in plan
    store.replace(df.filter("d < 2"), "gold", "t", ("d",))
    assert store.count("gold", "t") == 50


def test_merge_creates_then_upserts(spark, store):
    def rows(*values):
        return spark.createDataFrame(list(values), "k int, v string")
    store.merge(rows((1, "a"), (2, "b")), "control", "t", ["k"])
    store.merge(rows((2, "B"), (3, "c")), "control", "t", ["k"])
    store.merge(rows((2, "B"), (3, "c")), "control", "t", ["k"])
    assert sorted(tuple(r) for r in store.read("control", "t").collect()) == [
        (1, "a"), (2, "B"), (3, "c")]


def test_superseded_locations_can_be_removed(spark, store):
    for n in range(4):
        store.replace(spark.range(n), "silver", "t")
    assert store.remove_superseded("silver", "t", keep=1) == 2
    assert store.remove_superseded("silver", "t", keep=1) == 0
    assert store.count("silver", "t") == 3


def test_other_file_formats(spark, store):
    from tidemark.sources.layers import LayerStore
    orc = LayerStore(spark, store.root + "-orc", store.namespace + "_orc", fmt="orc")
    orc.replace(spark.range(5), "silver", "t")
    assert orc.count("silver", "t") == 5


# --- streaming ----------------------------------------------------------------------

def arrive(spark, root, number, rows):
    spark.createDataFrame(rows, "k int, t int, v string").write.parquet(
        f"{root}/landing/load={number}")


def run_stream(spark, root):
    schema = spark.createDataFrame([], "k int, t int, v string").schema
    keyed_upsert.start_change_stream(spark, f"{root}/landing", schema, f"{root}/log",
                                     f"{root}/checkpoint", 1).awaitTermination()
    return keyed_upsert.read_log(spark, f"{root}/log", schema)


def state(df):
    return sorted((r.k, r.v) for r in df.collect())


def test_both_policies_and_replay(spark, store):
    root = fresh_location(spark, "stream")
    arrive(spark, root, 1, [(1, 10, "a"), (2, 10, "b")])
    log = run_stream(spark, root)
    keyed_upsert.fold(store, log, "bronze", "last", ["k"], "t")
    keyed_upsert.fold(store, log, "bronze", "newest", ["k"], "t", newest_event_wins=True)
    arrive(spark, root, 2, [(1, 5, "late"), (3, 1, "c")])
    for _ in range(2):  # the second run finds no new files
        log = run_stream(spark, root)
        assert log.count() == 4
        last = keyed_upsert.fold(store, log, "bronze", "last", ["k"], "t")
        newest = keyed_upsert.fold(store, log, "bronze", "newest", ["k"], "t",
                                   newest_event_wins=True)
        assert state(last) == [(1, "late"), (2, "b"), (3, "c")]
        assert state(newest) == [(1, "a"), (2, "b"), (3, "c")]
        assert state(keyed_upsert.current_rows(log, ["k"], "t")) == state(last)
    arrive(spark, root, 3, [(1, 5, "late"), (3, 1, "c")])  # the same rows once more
    log = run_stream(spark, root)
    assert state(keyed_upsert.fold(store, log, "bronze", "last", ["k"], "t")) == state(last)


def test_late_and_split_loads_are_folded(spark, store):
    root = fresh_location(spark, "stream")
    arrive(spark, root, 3, [(1, 1, "three")])
    keyed_upsert.fold(store, run_stream(spark, root), "bronze", "late", ["k"], "t")
    arrive(spark, root, 2, [(1, 9, "two"), (2, 1, "two")])
    spark.createDataFrame([(4, 1, "more")], "k int, t int, v string").write.mode("append").parquet(
        f"{root}/landing/load=3")
    table = keyed_upsert.fold(store, run_stream(spark, root), "bronze", "late", ["k"], "t")
    assert state(table) == [(1, "three"), (2, "two"), (4, "more")]


def test_fixture_mapping_has_bad_rows_for_every_rule(spark):
    folder = f"{DATA}/sf0.01"
    assert fixtures.merchants(spark, folder).filter("MERCHANT_NAME IS NULL").count() == 6
    assert fixtures.sessions(spark, folder).filter("DEVICE_ID IS NULL").count() == 118


def test_intermediates_are_discarded(spark):
    from tidemark import session
    kept, session._locations[:] = list(session._locations), []
    df = session.materialise(spark.range(5), "gone")
    assert df.count() == 5
    location = session._locations[0]
    assert session.discard_intermediates(spark) == 1
    files, path = session.file_system(spark, location)
    assert not files.exists(path)
    session._locations.extend(kept)
