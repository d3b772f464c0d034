"""Reports over the gold tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.risk import HIGH_FROM
from tidemark.operators.star import Silver, dim_merchant

# The columns of the report, in its order.
LEADERBOARD_COLUMNS = (
    "CustomerID", "CustomerRiskBand", "CustomerRiskScore", "TransactionCount30D",
    "TotalTransactionAmount30D", "AverageTransactionRiskScore", "HighRiskTransactionCount",
    "FraudAlertCount", "FailedLoginCount", "DistinctDeviceCount", "UntrustedDeviceCount",
    "GeographicAnomalyCount",
)


def risk_leaderboard(profile: DataFrame, top: int = 25) -> DataFrame:
    ranked = profile.orderBy(F.desc("CustomerRiskScore"), F.desc("FraudAlertCount"), "CustomerID")
    return ranked.select(*LEADERBOARD_COLUMNS).limit(top)


def risk_band_summary(profile: DataFrame) -> DataFrame:
    # Scores carry two decimals, so decimal sums are exact and their mean is the
    # same on every run.
    score = F.col("CustomerRiskScore").cast("decimal(18,2)")
    return profile.groupBy("CustomerRiskBand").agg(
        F.count("CustomerID").alias("CustomerCount"),
        F.round(F.sum(score).cast("double") / F.count("CustomerRiskScore"), 2)
        .alias("AverageCustomerRiskScore"),
        F.sum("TotalTransactionAmount30D").alias("TotalTransactionAmount30D"),
        F.sum("FraudAlertCount").alias("FraudAlertCount"),
    )


MOST_BROADCAST = 10_000


def newest_alerts(alerts: DataFrame, top: int) -> DataFrame:
    return alerts.orderBy(F.desc("CreatedTimestamp"), "AlertID").limit(top)


def alert_drillthrough(alerts: DataFrame, transactions: DataFrame, merchants: DataFrame,
                       top: int | None = 25) -> DataFrame:
    """Alerts with the transaction and merchant they point at, newest first.

    Takes the gold facts and dimension.  The joins are left joins on unique
    keys, so the newest alerts are chosen before anything is joined to them, and
    their at most ``top`` ids select the facts: without a shuffle up to
    ``MOST_BROADCAST`` of them, beyond that as Spark's size checks say.
    """
    newest = alerts.select("AlertID", "TransactionID", "Severity", "Status", "CreatedTimestamp")
    order = (F.desc("CreatedTimestamp"), F.col("AlertID"))
    facts = transactions.select("TransactionID", "MerchantSK", "Amount", "RiskScore", "RiskBand")
    if top is not None:
        newest = newest_alerts(newest, top)
        ids = newest.select("TransactionID")
        facts = facts.join(F.broadcast(ids) if top <= MOST_BROADCAST else ids, "TransactionID",
                           "left_semi")
    names = merchants.select("MerchantSK", "MerchantName", "MerchantRiskCategory")
    joined = newest.join(facts, "TransactionID", "left").join(names, "MerchantSK", "left")
    return joined.select(
        "AlertID", "TransactionID", "Severity", "Status", "CreatedTimestamp", "Amount",
        "RiskScore", "RiskBand", "MerchantName", "MerchantRiskCategory").orderBy(*order)


def suspicious_transactions(silver: Silver, behaviour: DataFrame) -> DataFrame:
    """High-risk transactions with device trust, recent sessions and alerts.

    ``behaviour`` holds one row per customer (the 30-day session profile).
    Alerts are reduced to one row per transaction before the join.
    """
    risky = silver["transaction_risk"].filter(F.col("RiskScore") >= HIGH_FROM).select(
        "TransactionID", "RiskScore")
    rows = silver["transactions"].select(
        "TransactionID", "CustomerID", "MerchantID", "DeviceID", "TransactionTimestamp",
        "Amount").join(risky, "TransactionID")
    alerts = silver["fraud_alerts"].filter(F.col("TransactionID").isNotNull()).groupBy(
        "TransactionID").agg(F.count("AlertID").alias("LinkedAlertCount"))
    merchants = dim_merchant(silver).select("MerchantID", "MerchantRiskCategory")
    devices = silver["devices"].select("DeviceID", F.col("Trusted").alias("DeviceTrusted"))
    sessions = behaviour.select("CustomerID", "FailedLoginCount", "GeographicAnomalyCount")
    rows = (rows.join(alerts, "TransactionID", "left")
            .join(devices, "DeviceID", "left")
            .join(merchants, "MerchantID", "left")
            .join(sessions, "CustomerID", "left"))
    return rows.select(
        "TransactionID", "CustomerID", "MerchantID", "DeviceID", "TransactionTimestamp",
        "Amount", "RiskScore", "DeviceTrusted", "MerchantRiskCategory",
        F.coalesce("FailedLoginCount", F.lit(0)).alias("FailedLoginCount"),
        F.coalesce("GeographicAnomalyCount", F.lit(0)).alias("GeographicAnomalyCount"),
        F.coalesce("LinkedAlertCount", F.lit(0)).alias("LinkedAlertCount"),
    )
