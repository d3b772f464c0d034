"""Layer-to-layer reconciliation and relationship checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.contracts import Entity
from tidemark.operators.conform import RunInfo, join_by_hash


def _count(df: DataFrame) -> Column:
    return df.agg(F.count("*")).scalar()


def _rows_and_copies(raw: DataFrame, entity: Entity) -> Column:
    """Rows, and rows that are further copies of a conformed key, from one scan of the
    key; rows without one are no copies.

    Counted from the source alone, independently of what silver kept.
    """
    key = F.col(entity.source_key).cast("string")
    keys = raw.select((F.trim(key) if entity.source_key in entity.trimmed else key).alias("k"))
    return keys.agg(F.struct(
        F.count("*").alias("rows"), (F.count("k") - F.count_distinct("k")).alias("copies"))).scalar()


def reconcile_entity(one_row: DataFrame, run: RunInfo, entity: Entity, raw: DataFrame,
                     silver: DataFrame, quarantine: DataFrame,
                     gold: DataFrame | None = None, source: str = "source") -> DataFrame:
    """source = silver + quarantined + removed copies, and gold = silver where
    both have the same grain."""
    counts = one_row.select(_rows_and_copies(raw, entity).alias("raw")).select(
        F.col("raw.rows").alias("source_count"), F.col("raw.copies").alias("duplicate_count"),
        _count(silver).alias("silver_count"),
        _count(quarantine).alias("quarantine_count"),
        (_count(gold) if gold is not None else F.lit(None).cast("bigint")).alias("gold_count"),
    )
    expected = F.col("source_count") - F.col("duplicate_count") - F.col("quarantine_count")
    agrees = (F.col("silver_count") == expected) & (
        F.col("gold_count").isNull() | (F.col("gold_count") == F.col("silver_count")))
    return _result(counts, run, source, entity.source, "row_count_minus_quarantine",
                   F.when(agrees, "PASS").otherwise("FAIL"),
                   F.format_string("silver should have %s rows", expected))


def reconcile_relationship(one_row: DataFrame, run: RunInfo, alerts: DataFrame,
                           transactions: DataFrame) -> DataFrame:
    """Alerts that name a transaction should find it; a miss is a warning only."""
    linked = alerts.filter(F.col("TransactionID").isNotNull())
    counts = one_row.select(
        _count(linked).alias("source_count"),
        F.lit(0).cast("bigint").alias("duplicate_count"),
        _count(orphan_alerts(alerts, transactions, by_hash=True)).alias("quarantine_count"),
        F.lit(None).cast("bigint").alias("gold_count"),
    ).withColumn("silver_count", F.col("source_count") - F.col("quarantine_count"))
    return _result(counts, run, "cross_domain", "fraud_alerts_to_transactions",
                   "relationship_validation",
                   F.when(F.col("quarantine_count") == 0, "PASS").otherwise("WARN"),
                   F.lit("alerts whose transaction is not valid"))


def _result(counts: DataFrame, run: RunInfo, source: str, name: str, kind: str,
            status: Column, notes: Column) -> DataFrame:
    return counts.select(
        F.lit(run.run_id).alias("pipeline_run_id"),
        F.lit(run.run_date).cast("string").alias("run_date"),
        F.lit(source).alias("source"), F.lit(name).alias("object"),
        "source_count", "silver_count", "gold_count", "quarantine_count", "duplicate_count",
        F.lit(kind).alias("validation_type"), status.alias("status"), notes.alias("notes"))


def all_results(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def orphan_alerts(alerts: DataFrame, transactions: DataFrame, by_hash: bool = False) -> DataFrame:
    """Alerts whose transaction is not among the valid ones."""
    linked = alerts.filter(F.col("TransactionID").isNotNull())
    known = transactions.select("TransactionID")
    if by_hash:
        return join_by_hash(linked, known, "TransactionID", "left_anti")
    return linked.join(known, "TransactionID", "left_anti")


def joined_alert_count(alerts: DataFrame, transactions: DataFrame) -> DataFrame:
    """Number of alert-transaction pairs, on the source tables.

    Both sides are reduced to a count per id before they meet, so copies of an
    id multiply as numbers and not as rows.
    """
    per_alert = alerts.groupBy("TRANSACTION_ID").agg(F.count("*").alias("a"))
    per_txn = transactions.groupBy("TRANSACTION_ID").agg(F.count("*").alias("t"))
    return per_alert.join(per_txn, "TRANSACTION_ID").agg(
        F.coalesce(F.sum(F.col("a") * F.col("t")), F.lit(0)).alias("joined_alerts"))


def unresolved_accounts(transactions: DataFrame) -> DataFrame:
    """Valid transactions that never reach the fact table for want of an account."""
    return transactions.filter(F.col("AccountID").isNull()).agg(
        F.count("*").alias("missing_account_count"))
