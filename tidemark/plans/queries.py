"""Registered queries: every operator over the given tables.

A query that uses silver rows in several branches writes them once to the
shared folder and reads them back; a query that uses them once stays lazy.
Surrogate keys are left out of the results, which carry the natural keys they
stand for; timestamps are returned without a zone.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from contextlib import suppress

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.contracts import BY_SOURCE, BY_TABLE, ID_PATTERNS, SOURCE_COLUMNS
from tidemark.functions.text import json_text
from tidemark.operators import consume, profile, reconcile, secure, star
from tidemark.operators.conform import (
    RunInfo,
    conform,
    latest_conformed,
    with_gold_lineage,
    with_lineage,
)
from tidemark.operators.quality import FLAG, REASON, duplicate_keys, flag_entity, valid_rows
from tidemark.operators.rule_scan import library_rules, scan_with_rules
from tidemark.operators.scan import HEX_TOKEN_RULE, scan_text
from tidemark.operators.upsert import upsert
from tidemark.operators.validation import ValidationError, validate_batch, validate_sources
from tidemark.plans.audit import run_log
from tidemark.plans.medallion import (
    Settings,
    bronze_loaders,
    build_gold,
    build_silver,
    land_sources,
    reconcile_layers,
    run_medallion,
)
from tidemark.session import concurrently, fresh_location, materialise, prepare
from tidemark.sources import csv_batch, fixtures
from tidemark.sources.keyed import KeyedLayer
from tidemark.sources.layers import LayerStore
from tidemark.sources.serving import publish_tables, refresh_serving, view_counts
from tidemark.streaming import keyed_upsert

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
RUN = RunInfo(run_id="run-1", run_date="2024-01-31")
INVESTIGATOR = "lead.investigator"
ANALYST = "branch.analyst"


def registered(query: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return _without_zone(query(prepare(spark), folder))
    REGISTRY[query.__name__] = run
    return run


def _register_as(name: str, query: Query) -> None:
    query.__name__ = name
    registered(query)


def _without_zone(df: DataFrame) -> DataFrame:
    zoned = {f.name: F.col(f.name).cast("timestamp_ntz") for f in df.schema.fields
             if isinstance(f.dataType, T.TimestampType)}
    return df.withColumns(zoned) if zoned else df


def _without_keys(df: DataFrame) -> DataFrame:
    return df.drop("CustomerSK", "AccountSK", "MerchantSK", "DeviceSK")


# --- silver, lazy or written once ------------------------------------------

def _flagged(spark: SparkSession, folder: str, table: str,
             joined_next: bool = False) -> DataFrame:
    entity = BY_TABLE[table]
    parent = None
    if entity.parent:
        parent = valid_rows(_flagged(spark, folder, entity.parent[0], joined_next=True))
    return flag_entity(fixtures.BUILDERS[entity.source](spark, folder), entity, parent,
                       joined_next=joined_next)


def _valid(spark: SparkSession, folder: str, table: str,
           joined_next: bool = False) -> DataFrame:
    return valid_rows(_flagged(spark, folder, table, joined_next))


def _lazy_silver(spark: SparkSession, folder: str, *tables: str,
                 joined_next: tuple[str, ...] = ()) -> dict[str, DataFrame]:
    return {t: _valid(spark, folder, t, t in joined_next) for t in tables}


def _written_silver(spark: SparkSession, folder: str, *tables: str,
                    **columns: tuple[str, ...]) -> dict[str, DataFrame]:
    """Valid rows of the tables, each written in one pass, side by side.

    ``columns`` limits a table to those the query goes on to use.
    """
    def write(table: str) -> DataFrame:
        rows = _valid(spark, folder, table).select(*columns.get(table, ["*"]))
        return materialise(rows, f"silver-{table}")

    return concurrently({t: lambda t=t: write(t) for t in tables})


def _scores(spark: SparkSession, folder: str, only: DataFrame | None = None) -> DataFrame:
    """Scores in range, for plans that join them to valid transactions only; ``only``
    holds the ids that are wanted."""
    entity = BY_TABLE["transaction_risk"]
    return valid_rows(flag_entity(fixtures.transaction_risk(spark, folder), entity,
                                  check_parent=False, joined_next=True, only=only))


def _recent_scores(spark: SparkSession, folder: str, transactions: DataFrame,
                   last: dt.date | None) -> DataFrame:
    """Scores of the transactions of the 30 days before ``last``: those of all others are
    left out before copies are compared."""
    recent = transactions.filter(profile.within_window("TransactionTimestamp", last))
    return _scores(spark, folder, recent.select("TransactionID"))


PROFILE_COLUMNS = ("TransactionID", "CustomerID", "TransactionTimestamp", "Amount")


def _profile(spark: SparkSession, folder: str) -> DataFrame:
    silver = _written_silver(
        spark, folder, "transactions", "sessions", "devices", "fraud_alerts",
        transactions=PROFILE_COLUMNS,
        sessions=("CustomerID", "DeviceID", "LoginTimestamp", "FailedAttempts", "Country"),
        devices=("CustomerID", "Trusted"),
        fraud_alerts=("CustomerID", "AlertID"))
    dates = profile.as_of(silver)
    silver["transaction_risk"] = _recent_scores(
        spark, folder, silver["transactions"], dates.transactions)
    return profile.customer_risk_profile(silver, dates)


def _written_profile(spark: SparkSession, folder: str) -> DataFrame:
    return materialise(_profile(spark, folder), "profile")


def _store(spark: SparkSession) -> LayerStore:
    root = fresh_location(spark, "layers")
    return LayerStore(spark, root, "tidemark_" + root[-12:])


def _landed(spark: SparkSession, folder: str) -> LayerStore:
    store = _store(spark)
    land_sources(store, fixtures.source_tables(spark, folder))
    return store


def _built(spark: SparkSession, folder: str) -> LayerStore:
    """All layers up to gold, in a store of their own."""
    store = _landed(spark, folder)
    settings = Settings(run=RUN)
    build_silver(store, {n: load() for n, load in bronze_loaders(store).items()}, settings)
    build_gold(store, settings)
    return store


# --- sources and sinks --------------------------------------------------------

@registered
def bronze_scan_counts(spark: SparkSession, folder: str) -> DataFrame:
    counts = None
    for name, df in fixtures.source_tables(spark, folder).items():
        part = df.agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("object"), "row_count")
        counts = part if counts is None else counts.unionByName(part)
    return counts


@registered
def csv_contract_load(spark: SparkSession, folder: str) -> DataFrame:
    """Write the sources as a CSV batch, load it under the contract, and count
    rows and NULL fields per table."""
    batch = fresh_location(spark, "batch")
    csv_batch.write_batch(fixtures.source_tables(spark, folder), batch, "initial")
    result = None
    for name, df in csv_batch.load_batch(spark, batch).items():
        nulls = F.lit(0).cast("bigint")
        for column in SOURCE_COLUMNS[name]:
            nulls = nulls + F.count_if(F.col(column).isNull())
        part = df.agg(F.count("*").alias("row_count"), nulls.alias("null_fields")).select(
            F.lit(name).alias("object"), "row_count", "null_fields")
        result = part if result is None else result.unionByName(part)
    return result


@registered
def idempotent_refresh(spark: SparkSession, folder: str) -> DataFrame:
    """Replace a table twice; the second time from a plan that reads it."""
    store = _store(spark)
    devices = latest_conformed(fixtures.devices(spark, folder), BY_TABLE["devices"])
    first = store.replace(devices, "silver", "devices")
    return store.replace(first, "silver", "devices")


@registered
def published_tables(spark: SparkSession, folder: str) -> DataFrame:
    return publish_tables(_built(spark, folder))


@registered
def serving_view_counts(spark: SparkSession, folder: str) -> DataFrame:
    store = _built(spark, folder)
    refresh_serving(store)
    return view_counts(store)


@registered
def incremental_apply(spark: SparkSession, folder: str) -> DataFrame:
    base, changes = fixtures.event_changes(spark, folder)
    return upsert(base, changes, ["event_id"])


@registered
def keyed_change_apply(spark: SparkSession, folder: str) -> DataFrame:
    """One event in a hundred restated and one added, without a rewrite of the others."""
    events = fixtures.table(spark, folder, "events")
    part = F.col("event_id") % 100
    layer = KeyedLayer(spark, fresh_location(spark, "keyed"), buckets=16)
    layer.upsert("events", events.filter(part != 13), ["event_id"])
    raised = F.when(part == 7, F.col("value") + 1000).otherwise(F.col("value"))
    layer.upsert("events", events.filter(part.isin(7, 13)).withColumn("value", raised), ["event_id"])
    layer.fold("events", least_share=0.5)
    return layer.read("events")


@registered
def stream_merge_events(spark: SparkSession, folder: str) -> DataFrame:
    """Loads merged as they arrive: a base and its changes; then, in a second run, older
    rows that come late and the changes once more."""
    base, changes = fixtures.event_changes(spark, folder)
    late = changes.withColumns({"ts": F.col("ts") - F.expr("interval 1 day"), "value": F.col("value") - 5})
    root = fresh_location(spark, "stream")
    layer = KeyedLayer(spark, f"{root}/table", buckets=16)
    for arriving in ({1: base, 2: changes}, {3: late, 4: changes}):
        for number, load in arriving.items():
            load.write.parquet(f"{root}/landing/load={number}")
        keyed_upsert.start_keyed_merge(
            spark, f"{root}/landing", base.schema, layer, "events", ["event_id"], ["ts"],
            f"{root}/checkpoint").awaitTermination()
    return layer.read("events")


@registered
def bronze_batch_merge(spark: SparkSession, folder: str) -> DataFrame:
    """An initial and an incremental CSV batch merged into bronze; the rows as merged."""
    restated = {"MERCHANTS": {"MERCHANT_NAME": F.concat("MERCHANT_NAME", F.lit(" Ltd"))},
                "DEVICES": {"OPERATING_SYSTEM": F.lit("iOS")}, "FRAUD_ALERTS": {"STATUS": F.lit("CLOSED")}}
    batches = {"initial": {}, "incremental": {}}
    for name, changed in restated.items():
        rows = fixtures.BUILDERS[name](spark, folder)
        digit = F.substring(BY_SOURCE[name].source_key, -1, 1)
        more = rows.filter(digit.isin("0", "5")).withColumn("SOURCE_BATCH", F.lit("incremental"))
        batches["initial"][name] = rows.filter(digit != "5")
        batches["incremental"][name] = more.withColumns(
            {c: F.when(digit == "0", v).otherwise(F.col(c)) for c, v in changed.items()})
    layer = KeyedLayer(spark, fresh_location(spark, "bronze"), buckets=16)
    for batch, tables in batches.items():
        place = fresh_location(spark, f"batch-{batch}")
        csv_batch.write_batch(tables, place, batch)
        csv_batch.merge_batch(layer, place)
    shown = {"MERCHANTS": ("MERCHANT_NAME", "COUNTRY", "MERCHANT_RISK_CATEGORY"),
             "DEVICES": ("CUSTOMER_ID", "TRUSTED", "OPERATING_SYSTEM"),
             "FRAUD_ALERTS": ("CUSTOMER_ID", "SEVERITY", "STATUS")}
    parts = [layer.read(name).select(
        F.lit(name).alias("object"), F.col(BY_SOURCE[name].source_key).alias("row_key"),
        F.concat_ws("|", *[F.coalesce(c, F.lit("")) for c in columns]).alias("fields"), "SOURCE_BATCH")
        for name, columns in shown.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@registered
def stream_upsert_events(spark: SparkSession, folder: str) -> DataFrame:
    """Three arriving loads: a base, its changes, and the changes once more."""
    base, changes = fixtures.event_changes(spark, folder)
    root = fresh_location(spark, "stream")
    for number, load in enumerate((base, changes, changes), start=1):
        load.write.parquet(f"{root}/landing/load={number}")
    keyed_upsert.start_change_stream(
        spark, f"{root}/landing", base.schema, f"{root}/log", f"{root}/checkpoint"
    ).awaitTermination()
    log = keyed_upsert.read_log(spark, f"{root}/log", base.schema)
    return keyed_upsert.current_rows(log, ["event_id"], "ts").drop(keyed_upsert.LOAD)


# --- typing, lineage, latest rows ---------------------------------------------

def _conform_query(source: str) -> Query:
    return lambda spark, folder: conform(
        fixtures.BUILDERS[source](spark, folder), BY_SOURCE[source])


def _latest_query(table: str) -> Query:
    entity = BY_TABLE[table]
    return lambda spark, folder: latest_conformed(
        fixtures.BUILDERS[entity.source](spark, folder), entity)


def _split_query(table: str) -> Query:
    return lambda spark, folder: _flagged(spark, folder, table).select(
        BY_TABLE[table].key, FLAG, REASON)


_register_as("conform_transactions", _conform_query("TRANSACTIONS"))
_register_as("conform_sessions", _conform_query("DIGITAL_SESSIONS"))
_register_as("conform_alerts", _conform_query("FRAUD_ALERTS"))
_register_as("latest_transactions", _latest_query("transactions"))
_register_as("latest_risk", _latest_query("transaction_risk"))
_register_as("latest_devices", _latest_query("devices"))
for _name, _table in (("transactions", "transactions"), ("risk", "transaction_risk"),
                      ("merchants", "merchants"), ("sessions", "sessions"),
                      ("devices", "devices"), ("alerts", "fraud_alerts")):
    _register_as(f"quality_split_{_name}", _split_query(_table))


@registered
def json_text_events(spark: SparkSession, folder: str) -> DataFrame:
    """Nested properties and plain ones, both as text."""
    events = fixtures.table(spark, folder, "events").withColumn(
        "detail", F.struct(F.from_json("props", "k int").getField("k").alias("k"),
                           F.col("event_type").alias("kind")))
    return events.select("event_id", json_text(events, "detail").alias("detail_text"),
                         json_text(events, "props").alias("props_text"))


@registered
def with_lineage_merchants(spark: SparkSession, folder: str) -> DataFrame:
    rows = conform(fixtures.merchants(spark, folder), BY_TABLE["merchants"])
    return with_lineage(rows, RUN, "source").drop("silver_loaded_at")


REGISTRY["with_lineage"] = REGISTRY.pop("with_lineage_merchants")


# --- validation, reconciliation, audit ------------------------------------------

@registered
def source_validation(spark: SparkSession, folder: str) -> DataFrame:
    loaders = {name: lambda build=build: build(spark, folder)
               for name, build in fixtures.BUILDERS.items()}
    return validate_sources(spark, loaders, RUN)


@registered
def source_validation_failures(spark: SparkSession, folder: str) -> DataFrame:
    """Findings on an object without a required column, an empty one and an unreadable one."""
    def unreadable() -> DataFrame:
        raise OSError("no such object")

    sources = fixtures.source_tables(spark, folder)
    sources["DEVICES"] = sources["DEVICES"].drop("TRUSTED")
    sources["MERCHANTS"] = sources["MERCHANTS"].filter("MERCHANT_ID IS NULL")
    loaders = {name: lambda df=df: df for name, df in sources.items()}
    return validate_sources(spark, loaders | {"FRAUD_ALERTS": unreadable}, RUN)


@registered
def batch_validation(spark: SparkSession, folder: str) -> DataFrame:
    """Check the sources as a batch whose manifest counts the tables they map."""
    def write(name: str, df: DataFrame) -> DataFrame:
        used = {BY_SOURCE[name].source_key, *ID_PATTERNS}
        return materialise(df.select(*[c for c in df.columns if c in used]),
                           f"batch-{name.lower()}")

    tables = concurrently({name: lambda name=name, df=df: write(name, df)
                           for name, df in fixtures.source_tables(spark, folder).items()})
    expected = None
    for name, origin in (("TRANSACTIONS", "lineitem"), ("TRANSACTION_RISK", "lineitem"),
                         ("MERCHANTS", "supplier"), ("DIGITAL_SESSIONS", "events"),
                         ("DEVICES", "customer"), ("FRAUD_ALERTS", "events")):
        part = fixtures.table(spark, folder, origin).agg(F.count("*").alias("expected")).select(
            F.lit(name).alias("object"), "expected")
        expected = part if expected is None else expected.unionByName(part)
    return validate_batch(tables, expected)


@registered
def duplicate_transaction_keys(spark: SparkSession, folder: str) -> DataFrame:
    return duplicate_keys(fixtures.transactions(spark, folder), ["TRANSACTION_ID"])


REGISTRY["duplicate_keys"] = REGISTRY.pop("duplicate_transaction_keys")


@registered
def reconciliation(spark: SparkSession, folder: str) -> DataFrame:
    return reconcile_layers(_built(spark, folder), Settings(run=RUN)).drop("notes")


@registered
def audit_log_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """The log of a full run: every stage once, however often it was written."""
    store = _landed(spark, folder)
    run_medallion(store, bronze_loaders(store), Settings(run=RUN))
    return run_log(store).drop("started_at", "ended_at", "duration_seconds")


@registered
def audit_log_failure(spark: SparkSession, folder: str) -> DataFrame:
    """The log of a run whose source validation finds an empty table."""
    store = _landed(spark, folder)
    store.replace(store.read("bronze", "MERCHANTS").limit(0), "bronze", "MERCHANTS")
    with suppress(ValidationError):
        run_medallion(store, bronze_loaders(store), Settings(run=RUN))
    return run_log(store).drop("started_at", "ended_at", "duration_seconds")


@registered
def orphan_alerts(spark: SparkSession, folder: str) -> DataFrame:
    silver = _lazy_silver(spark, folder, "fraud_alerts", "transactions",
                          joined_next=("transactions",))
    return reconcile.orphan_alerts(silver["fraud_alerts"], silver["transactions"]).select(
        "AlertID", "TransactionID")


@registered
def joined_alerts(spark: SparkSession, folder: str) -> DataFrame:
    return reconcile.joined_alert_count(
        fixtures.alerts(spark, folder), fixtures.transactions(spark, folder))


# --- gold -----------------------------------------------------------------------

@registered
def dim_customer(spark: SparkSession, folder: str) -> DataFrame:
    return _without_keys(star.dim_customer(_lazy_silver(
        spark, folder, "transactions", "sessions", "devices", "fraud_alerts")))


@registered
def dim_account(spark: SparkSession, folder: str) -> DataFrame:
    return _without_keys(star.dim_account(_lazy_silver(spark, folder, "transactions")))


@registered
def dim_date(spark: SparkSession, folder: str) -> DataFrame:
    return star.dim_date(_lazy_silver(spark, folder, "transactions", "sessions"))


@registered
def fact_transactions(spark: SparkSession, folder: str) -> DataFrame:
    silver = _lazy_silver(spark, folder, "transactions", "merchants",
                          joined_next=("transactions",))
    silver["transaction_risk"] = _scores(spark, folder)
    return _without_keys(star.fact_transactions(silver, natural_keys=True))


@registered
def fact_sessions(spark: SparkSession, folder: str) -> DataFrame:
    return _without_keys(star.fact_sessions(
        _lazy_silver(spark, folder, "sessions", "devices"), natural_keys=True))


@registered
def fact_alerts(spark: SparkSession, folder: str) -> DataFrame:
    return _without_keys(star.fact_alerts(
        _lazy_silver(spark, folder, "fraud_alerts"), natural_keys=True))


@registered
def orphan_date_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Transaction-only dates leave alert dates without a date row."""
    silver = _lazy_silver(spark, folder, "transactions", "sessions", "fraud_alerts")
    days = star.dim_date({**silver, "sessions": silver["sessions"].filter(F.lit(False))})
    return star.orphan_date_keys(star.fact_alerts(silver), days)


@registered
def domain_watermarks(spark: SparkSession, folder: str) -> DataFrame:
    return profile.domain_watermarks(_lazy_silver(spark, folder, "transactions", "sessions"))


def _rounded_average(df: DataFrame) -> DataFrame:
    return df.withColumn("AverageTransactionRiskScore",
                         F.round("AverageTransactionRiskScore", 4))


@registered
def txn_profile_30d(spark: SparkSession, folder: str) -> DataFrame:
    silver = _written_silver(spark, folder, "transactions",
                             transactions=PROFILE_COLUMNS)
    last = silver["transactions"].agg(F.to_date(F.max("TransactionTimestamp"))).first()[0]
    silver["transaction_risk"] = _recent_scores(spark, folder, silver["transactions"], last)
    return _rounded_average(profile.transaction_profile(silver, last))


@registered
def session_profile_30d(spark: SparkSession, folder: str) -> DataFrame:
    silver = _written_silver(spark, folder, "sessions")
    last = silver["sessions"].agg(F.to_date(F.max("LoginTimestamp"))).first()[0]
    return profile.session_profile(silver, last)


@registered
def untrusted_devices(spark: SparkSession, folder: str) -> DataFrame:
    return profile.untrusted_devices(_lazy_silver(spark, folder, "devices"))


@registered
def alerts_per_customer(spark: SparkSession, folder: str) -> DataFrame:
    return profile.alerts_per_customer(_lazy_silver(spark, folder, "fraud_alerts"))


@registered
def customer_risk_profile(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded_average(_without_keys(_profile(spark, folder)))


# --- reports ----------------------------------------------------------------------

@registered
def risk_leaderboard_top25(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded_average(consume.risk_leaderboard(_profile(spark, folder)))


@registered
def risk_band_summary(spark: SparkSession, folder: str) -> DataFrame:
    return consume.risk_band_summary(_profile(spark, folder))


@registered
def alert_drillthrough(spark: SparkSession, folder: str) -> DataFrame:
    silver = _written_silver(spark, folder, "merchants", "fraud_alerts")
    ids = materialise(consume.newest_alerts(silver["fraud_alerts"], 25)
                      .filter("TransactionID IS NOT NULL").select("TransactionID"), "newest")
    # A key's rows are kept or left out together, so this may be done before the latest
    # row of each is looked for.
    silver["transactions"] = valid_rows(flag_entity(
        fixtures.transactions(spark, folder), BY_TABLE["transactions"], joined_next=True, only=ids))
    silver["transaction_risk"] = _scores(spark, folder, ids)
    return consume.alert_drillthrough(
        star.fact_alerts(silver), star.fact_transactions(silver), star.dim_merchant(silver))


@registered
def suspicious_transactions(spark: SparkSession, folder: str) -> DataFrame:
    silver = _written_silver(spark, folder, "sessions")
    silver |= _lazy_silver(spark, folder, "transactions", "merchants", "devices",
                           "fraud_alerts", joined_next=("transactions",))
    silver["transaction_risk"] = _scores(spark, folder)
    last = silver["sessions"].agg(F.to_date(F.max("LoginTimestamp"))).first()[0]
    return consume.suspicious_transactions(silver, profile.session_profile(silver, last))


# --- secured views ------------------------------------------------------------------

def _investigators(spark: SparkSession) -> DataFrame:
    return spark.range(1).select(F.lit(INVESTIGATOR).alias("PrincipalName"))


@registered
def rls_filtered_profile(spark: SparkSession, folder: str) -> DataFrame:
    """What an analyst and an investigator see of the same profiles."""
    rows = _written_profile(spark, folder)
    parts = [secure.visible_profiles(rows, _investigators(spark), user).select(
        F.lit(user).alias("viewer"), "CustomerID", "CustomerRiskBand", "CustomerRiskScore")
        for user in (ANALYST, INVESTIGATOR)]
    return parts[0].unionByName(parts[1])


@registered
def visible_profile_counts(spark: SparkSession, folder: str) -> DataFrame:
    rows = _written_profile(spark, folder)
    parts = [secure.visible_profile_counts(
        secure.visible_profiles(rows, _investigators(spark), user), user)
        for user in (ANALYST, INVESTIGATOR)]
    return parts[0].unionByName(parts[1])


@registered
def masked_customers(spark: SparkSession, folder: str) -> DataFrame:
    rows = star.dim_customer(_lazy_silver(
        spark, folder, "transactions", "sessions", "devices", "fraud_alerts"))
    return _without_keys(secure.masked(rows, "DimCustomer"))


@registered
def masked_devices(spark: SparkSession, folder: str) -> DataFrame:
    rows = star.dim_device(_lazy_silver(spark, folder, "devices"))
    return secure.masked(rows, "DimDevice").select("DeviceID", "CustomerID", "DeviceFingerprint")


@registered
def column_allowlist_devices(spark: SparkSession, folder: str) -> DataFrame:
    rows = with_gold_lineage(star.dim_device(_lazy_silver(spark, folder, "devices")), RUN)
    return _without_keys(secure.allowed_columns(rows)).drop("gold_loaded_at")


# --- text scan --------------------------------------------------------------------------

@registered
def secret_scan_documents(spark: SparkSession, folder: str) -> DataFrame:
    return scan_text(fixtures.table(spark, folder, "documents"), "doc_id", "text",
                     extra_rules=HEX_TOKEN_RULE)


@registered
def secret_scan_conversations(spark: SparkSession, folder: str) -> DataFrame:
    turns = fixtures.table(spark, folder, "conversations").select(
        F.concat_ws("/", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
        .alias("label"), "text")
    return scan_text(turns, "label", "text", extra_rules=HEX_TOKEN_RULE)


def _planted(spark: SparkSession, folder: str) -> DataFrame:
    """A text for each customer: a line of its own data and one with a credential of the
    kind that its number names, made of its hash; every twelfth has one that is too short."""
    m = F.md5(F.col("c_custkey").cast("string"))
    part = lambda start, size: F.substring(m, start, size)
    guid = F.concat(part(1, 8), F.lit("-"), part(9, 4), F.lit("-4"), part(14, 3), F.lit("-a"), part(18, 3), F.lit("-"), part(21, 12))
    secrets = [
        F.concat(F.lit("x AccountKey="), m, m), F.concat(F.lit("https://host/path?sig="), m), F.concat(F.lit("use ghp_"), m),
        F.concat(F.lit("use dapi"), m), F.concat(F.lit("eyJ"), m, F.lit("."), m, F.lit("."), m),
        F.lit("-----BEGIN RSA PRIVATE KEY-----"), F.concat(F.lit('password = "'), m, F.lit('"')),
        F.concat(F.lit('Authorization: "Bearer '), m, F.lit('"')), guid,
        F.concat(F.lit("https://app.snowflake.com/"), m, F.lit("/"), part(1, 8), F.lit("/")),
        F.concat(m, F.lit(".snowflakecomputing.com")), F.concat(F.lit("use ghp_"), part(1, 8))]
    chosen = F.array(*secrets)[(F.col("c_custkey") % 12).cast("int")]
    return fixtures.table(spark, folder, "customer").select(
        F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("label"),
        F.concat_ws("\n", F.concat(F.lit("customer "), F.col("c_name")), chosen).alias("text"))


@registered
def secret_scan_planted(spark: SparkSession, folder: str) -> DataFrame:
    return scan_text(_planted(spark, folder), "label", "text")


@registered
def rule_table_scan(spark: SparkSession, folder: str) -> DataFrame:
    """A thousand rules for mail hosts and the library's, as rows, over documents and the
    planted texts."""
    host = F.col("id").cast("string")
    hosts = spark.range(1000).select(
        F.concat(F.lit("mail-host-"), host).alias("rule"),
        F.concat(F.lit(r"[a-z.]+[0-9]{2}@mail"), host, F.lit(r"\.example\.com")).alias("pattern"),
        F.array(F.concat(F.lit("@mail"), host, F.lit(".example.com"))).alias("words"))
    documents = fixtures.table(spark, folder, "documents").select(
        F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("label"), "text")
    return scan_with_rules(documents.unionByName(_planted(spark, folder)), "label", "text",
                           hosts.unionByName(library_rules(spark)))
