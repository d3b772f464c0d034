"""The full run: reruns, failures, published goldens."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark.contracts import GOLD_TABLES
from tidemark.operators import consume, secure
from tidemark.operators.conform import RunInfo
from tidemark.operators.upsert import upsert
from tidemark.operators.validation import ValidationError
from tidemark.plans.audit import RunLog, compact_run_log, run_log
from tidemark.plans.medallion import (
    RECONCILIATION_TABLE,
    VALIDATION_TABLE,
    Settings,
    bronze_loaders,
    land_sources,
    run_medallion,
)
from tidemark.sources import fixtures, serving
from tests.conftest import DATA

CLOCK = ("silver_loaded_at", "gold_loaded_at", "started_at", "ended_at", "duration_seconds")


def log_rows(store, run_id):
    rows = run_log(store).filter(F.col("pipeline_run_id") == run_id).collect()
    return {r.stage: r for r in rows}


def content(store, layer, table):
    df = run_log(store) if table == "run_log" else store.read(layer, table)
    return sorted(map(str, df.drop(*[c for c in CLOCK if c in df.columns]).collect()))


def test_a_rerun_changes_nothing_but_clocks(spark, store):
    land_sources(store, fixtures.source_tables(spark, f"{DATA}/sf0.001"))
    settings = Settings(run=RunInfo("run-a", "2024-01-31"))
    run_medallion(store, bronze_loaders(store), settings)
    tables = [("gold", t) for t in GOLD_TABLES] + [
        ("silver", "transactions"), ("silver", "quarantine_merchants"),
        ("silver", "quarantine_transactions"), ("control", "run_log"),
        ("control", RECONCILIATION_TABLE), ("control", VALIDATION_TABLE)]
    before = {t: content(store, *t) for t in tables}
    run_medallion(store, bronze_loaders(store), settings)
    assert {t: content(store, *t) for t in tables} == before
    assert run_log(store).count() == 6
    assert store.count("silver", "quarantine_merchants") == 0
    assert store.count("silver", "quarantine_transactions") == 133
    # valid + quarantined = latest rows, and no key is on both sides
    valid = store.read("silver", "transactions").select("TransactionID")
    rejected = store.read("silver", "quarantine_transactions").select("TransactionID")
    assert valid.count() + rejected.count() == 4599
    assert valid.join(rejected, "TransactionID").count() == 0
    quarantined = store.read("silver", "quarantine_transactions").first()
    assert (quarantined.source_system, quarantined.quarantine_reason) == (
        "quality", "invalid key, timestamp, or amount")
    device = store.read("gold", "DimDevice")
    assert {"source_system", "silver_loaded_at", "gold_loaded_at", "DeviceSK"} <= set(device.columns)
    assert "source_system" not in secure.allowed_columns(device).columns
    assert len(secure.allowed_columns(device).columns) == 14
    # a second run keeps the first one's control rows
    run_medallion(store, bronze_loaders(store), Settings(run=RunInfo("run-b"),
                                                         dates_cover_alerts=True))
    assert run_log(store).count() == 12
    assert store.count("control", RECONCILIATION_TABLE) == 14

    # serving views agree with the DataFrame form of the same rules
    user = spark.range(1).select(F.current_user()).first()[0]
    profile = store.read("gold", "AggCustomerRiskProfile")
    hidden = store.read("serving", "AggCustomerRiskProfile")
    assert hidden.count() == profile.filter("CustomerRiskBand <> 'High'").count() == 149
    serving.grant_investigator(store, user)
    assert store.read("serving", "AggCustomerRiskProfile").count() == profile.count() == 150
    serving.refresh_serving(store)  # keeps who was granted
    assert store.read("serving", "AggCustomerRiskProfile").count() == 150
    for table in ("DimCustomer", "DimDevice"):
        expected = secure.masked(store.read("gold", table), table)
        assert store.read("serving", table).exceptAll(expected).isEmpty()
    published = serving.publish_tables(store)
    assert [r.object_name for r in published.orderBy("execution_order").collect()] == list(
        GOLD_TABLES)
    again = serving.publish_tables(store)
    assert again.exceptAll(published).isEmpty()


def test_a_failed_stage_is_logged_and_stops_the_run(spark, store):
    tables = fixtures.source_tables(spark, f"{DATA}/sf0.001")
    land_sources(store, {n: t for n, t in tables.items() if n != "DEVICES"})
    with pytest.raises(ValidationError):
        run_medallion(store, bronze_loaders(store), Settings(run=RunInfo("bad")))
    rows = log_rows(store, "bad")
    assert {s: r.status for s, r in rows.items()} == {
        "pipeline": "Failed", "source_validation": "Failed"}
    assert "1 object" in rows["pipeline"].error_message
    results = store.read("control", VALIDATION_TABLE).filter("status = 'FAIL'").collect()
    assert [r.object for r in results] == ["DEVICES"]
    assert not store.exists("silver", "transactions")


def test_long_error_messages_are_cut_and_retries_replace(spark, store):
    log = RunLog(store, RunInfo("r"))
    with pytest.raises(RuntimeError):
        with log.stage("s"):
            raise RuntimeError("x" * 5000)
    assert len(log_rows(store, "r")["s"].error_message) == 2000
    with log.stage("s") as counts:
        counts.rows_written = 7
    row = log_rows(store, "r")["s"]
    assert (row.status, row.rows_written, row.error_message) == ("Succeeded", 7, None)


def test_facts_can_be_split_by_date(spark, store):
    land_sources(store, fixtures.source_tables(spark, f"{DATA}/sf0.001"))
    settings = Settings(run=RunInfo("p"), partitions={"FactDigitalSessions": ("DateKey",)})
    run_medallion(store, bronze_loaders(store), settings)
    fact = store.read("gold", "FactDigitalSessions")
    assert fact.count() == 992
    plan = fact.filter("DateKey = 20240105")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(DateKey" in plan
