"""The full run: validate, silver, gold, publish, reconcile, each stage logged."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.contracts import ENTITIES, GOLD_TABLES, SOURCE_COLUMNS, Entity
from tidemark.operators import profile, reconcile, star
from tidemark.operators.conform import RunInfo, with_gold_lineage, with_lineage
from tidemark.operators.quality import FLAG, REASON, flag_entity, flag_unkeyed
from tidemark.operators.validation import Loaders, raise_on_failure, validate_sources
from tidemark.plans.audit import RunLog
from tidemark.session import concurrently
from tidemark.sources.layers import Buckets, LayerStore
from tidemark.sources.serving import refresh_serving

VALIDATION_TABLE = "source_validation_results"
RECONCILIATION_TABLE = "reconciliation_results"
RESULT_KEY = ("pipeline_run_id", "source", "object")


@dataclass(frozen=True)
class Settings:
    """Options of a run.

    ``partitions`` maps a gold table to the columns its files are split by, for
    example ``{"FactTransactions": ("DateKey",)}``.  ``buckets`` hashes silver
    transactions and scores by their shared key, so that gold joins them without
    moving either; set it to ``spark.sql.shuffle.partitions``.  ``date_ranges``
    writes ranges of event time to files of their own, for silver tables that are read by date far
    more often than written; it costs a shuffle of each and is left out of bucketed ones.
    """

    run: RunInfo = RunInfo()
    source_system: str = "source"
    keep_unknown_accounts: bool = False
    dates_cover_alerts: bool = False
    partitions: Mapping[str, Sequence[str]] = field(default_factory=dict)
    buckets: int = 0
    date_ranges: bool = False
    workers: int = 4

    def bucketing(self, entity: Entity) -> Buckets | None:
        shared = entity.parent or any(e.parent and e.parent[0] == entity.table for e in ENTITIES)
        return Buckets(entity.key, self.buckets) if self.buckets and shared else None


def land_sources(store: LayerStore, tables: Mapping[str, DataFrame], workers: int = 4) -> None:
    concurrently({name: lambda name=name, df=df: store.replace(df, "bronze", name)
                  for name, df in tables.items()}, workers)


def bronze_loaders(store: LayerStore) -> Loaders:
    return {name: lambda name=name: store.read("bronze", name) for name in SOURCE_COLUMNS}


def build_silver(store: LayerStore, raw: Mapping[str, DataFrame], settings: Settings,
                 entities: Sequence[Entity] = ENTITIES) -> int:
    """Write every silver and quarantine table; returns the valid rows written.

    Each entity is written in one pass that holds both halves.  The tables are
    switched together after the last write, so a failed stage changes none.
    """
    layouts: dict[str, tuple[str, DataFrame]] = {}

    def write(entity: Entity) -> None:
        parent = None
        if entity.parent:
            location, rows = layouts[entity.parent[0]]
            parent = store.spark.read.schema(rows.schema).format(store.fmt).load(
                location).filter(F.col(FLAG))
        buckets = settings.bucketing(entity)
        flagged = flag_entity(raw[entity.source], entity, parent, joined_next=bool(buckets),
                              unique_parent=True)
        if buckets:
            # All go to quarantine, so the valid half stays partitioned by the key.
            flagged = flagged.unionByName(flag_unkeyed(raw[entity.source], entity))
        system = F.when(F.col(FLAG), settings.source_system).otherwise("quality")
        flagged = with_lineage(flagged, settings.run, system)
        layouts[entity.table] = (
            store.stage_flagged(flagged, "silver", entity.table, buckets, entity.event_time,
                                settings.date_ranges),
            flagged)

    for wave in ([e for e in entities if not e.parent], [e for e in entities if e.parent]):
        concurrently({e.table: lambda e=e: write(e) for e in wave}, settings.workers)
    for entity in entities:
        location, rows = layouts[entity.table]
        store.switch("silver", entity.table, rows.drop(FLAG, REASON).schema,
                     store.half(location, True), buckets=settings.bucketing(entity))
        store.switch("silver", entity.quarantine, rows.drop(FLAG).schema,
                     store.half(location, False))
    return sum(store.count("silver", e.table) for e in entities)


def silver_tables(store: LayerStore) -> dict[str, DataFrame]:
    """Silver as written.  The merchant and device dimensions keep its source and
    load time; gold puts its own run in place of silver's."""
    return {e.table: store.read("silver", e.table) for e in ENTITIES}


def build_gold(store: LayerStore, settings: Settings) -> int:
    """Write all dimensions, facts and the profile; returns the rows written."""
    silver = silver_tables(store)
    extra = None
    if settings.dates_cover_alerts:
        extra = silver["fraud_alerts"].select(F.to_date("CreatedTimestamp").alias("d"))
    written: dict[str, tuple[DataFrame, str]] = {}

    def write(name: str, df: DataFrame) -> None:
        rows = with_gold_lineage(df, settings.run)
        split = tuple(settings.partitions.get(name, ()))
        written[name] = (rows, store.stage(rows, "gold", name, split))

    # The profile starts from the customer dimension as written.
    write("DimCustomer", star.dim_customer(silver))
    rows, location = written["DimCustomer"]
    customers = store.spark.read.schema(rows.schema).format(store.fmt).load(location).select(
        "CustomerID", "CustomerSK")
    tables = {
        "FactTransactions": lambda: star.fact_transactions(
            silver, settings.keep_unknown_accounts, by_hash=not settings.buckets),
        "AggCustomerRiskProfile": lambda: profile.customer_risk_profile(
            silver, customers=customers, by_hash=not settings.buckets),
        "FactDigitalSessions": lambda: star.fact_sessions(silver),
        "FactFraudAlerts": lambda: star.fact_alerts(silver),
        "DimAccount": lambda: star.dim_account(silver),
        "DimMerchant": lambda: star.dim_merchant(silver),
        "DimDevice": lambda: star.dim_device(silver),
        "DimDate": lambda: star.dim_date(silver, extra),
    }
    concurrently({name: lambda name=name, build=build: write(name, build())
                  for name, build in tables.items()}, settings.workers)
    for name in GOLD_TABLES:
        rows, location = written[name]
        store.switch("gold", name, rows.schema, location, tuple(settings.partitions.get(name, ())))
    return sum(store.count("gold", name) for name in GOLD_TABLES)


def reconcile_layers(store: LayerStore, settings: Settings) -> DataFrame:
    one = store.spark.range(1)
    parts = []
    for entity in ENTITIES:
        gold = store.read("gold", entity.same_grain) if entity.same_grain else None
        parts.append(reconcile.reconcile_entity(
            one, settings.run, entity, store.read("bronze", entity.source),
            store.read("silver", entity.table), store.read("silver", entity.quarantine),
            gold, settings.source_system))
    parts.append(reconcile.reconcile_relationship(
        one, settings.run, store.read("silver", "fraud_alerts"),
        store.read("silver", "transactions")))
    return reconcile.all_results(parts)


def _store_results(store: LayerStore, results: DataFrame, table: str) -> DataFrame:
    """Merge control rows and return this run's as they were stored."""
    run_id = results.select("pipeline_run_id").first()[0]
    stored = store.merge(results, "control", table, RESULT_KEY)
    return stored.filter(F.col("pipeline_run_id") == run_id)


def run_medallion(store: LayerStore, loaders: Loaders, settings: Settings = Settings()) -> None:
    """Run all stages in order; a failure is logged on its stage and on the run.

    ``loaders`` open the bronze tables by source name.  Results of a check are
    stored before a failed check raises.
    """
    log = RunLog(store, settings.run)
    with log.stage("pipeline", announce=True):
        with log.stage("source_validation") as counts:
            results = _store_results(
                store, validate_sources(store.spark, loaders, settings.run,
                                        settings.source_system), VALIDATION_TABLE)
            totals = results.agg(F.sum("source_count"), F.count("*")).first()
            counts.rows_read, counts.rows_written = totals[0], totals[1]
            raise_on_failure(results, "source validation")
            source_rows = counts.rows_read
        with log.stage("silver_transform") as counts:
            counts.rows_read = source_rows
            raw = {name: load() for name, load in loaders.items()}
            counts.rows_written = silver_rows = build_silver(store, raw, settings)
        with log.stage("gold_build") as counts:
            counts.rows_read = silver_rows
            counts.rows_written = build_gold(store, settings)
        with log.stage("serving_publish") as counts:
            counts.rows_written = refresh_serving(store)
        with log.stage("reconciliation") as counts:
            results = _store_results(store, reconcile_layers(store, settings),
                                     RECONCILIATION_TABLE)
            totals = results.agg(F.sum("source_count"), F.count("*")).first()
            counts.rows_read, counts.rows_written = totals[0], totals[1]
            raise_on_failure(results, "reconciliation")
