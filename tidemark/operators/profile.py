"""As-of 30-day behaviour and the customer risk profile."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.risk import HIGH_FROM, customer_risk_score, risk_band
from tidemark.operators.conform import join_by_hash
from tidemark.operators.star import Silver, dim_customer

WINDOW_DAYS = 30


def domain_watermarks(silver: Silver) -> DataFrame:
    """First and last event date of the transaction and the session domain."""
    parts = []
    for domain, table, column in (("transactions", "transactions", "TransactionTimestamp"),
                                  ("sessions", "sessions", "LoginTimestamp")):
        parts.append(silver[table].agg(
            F.to_date(F.min(column)).alias("first_date"),
            F.to_date(F.max(column)).alias("last_date"),
        ).select(F.lit(domain).alias("domain"), "first_date", "last_date"))
    return parts[0].unionByName(parts[1])


@dataclass(frozen=True)
class AsOf:
    """Last event date per domain; ``None`` for an empty domain."""

    transactions: dt.date | None
    sessions: dt.date | None


def as_of(silver: Silver) -> AsOf:
    """The two as-of dates, read in one job.

    They come back as values and not as a subquery so that the window filters
    are literals, which reach the file scan and skip row groups.
    """
    dates = {r["domain"]: r["last_date"] for r in domain_watermarks(silver).collect()}
    return AsOf(dates["transactions"], dates["sessions"])


def within_window(timestamp: str, last: dt.date | None, days: int = WINDOW_DAYS) -> Column:
    """Dates in ``[last - days + 1, last]``, as a range over the raw timestamp."""
    if last is None:
        return F.lit(False)
    day = dt.datetime(last.year, last.month, last.day, tzinfo=dt.UTC)
    column = F.col(timestamp)
    return ((column >= F.lit(day - dt.timedelta(days=days - 1)))
            & (column < F.lit(day + dt.timedelta(days=1))))


def exact_average(column: str) -> Column:
    """Mean of a double that does not depend on the order rows arrive in.

    Scores lie in 0..100; summing them as decimals keeps a mean on a rounding
    boundary on the same side whatever the partitioning or retries.
    """
    return F.sum(F.col(column).cast("decimal(18,10)")).cast("double") / F.count(column)


def transaction_profile(silver: Silver, last: dt.date | None,
                        by_hash: bool = False) -> DataFrame:
    recent = silver["transactions"].filter(within_window("TransactionTimestamp", last))
    recent = recent.select("TransactionID", "CustomerID", "Amount")
    scores = silver["transaction_risk"].select("TransactionID", "RiskScore")
    scored = (join_by_hash(recent, scores, "TransactionID") if by_hash
              else recent.join(scores, "TransactionID", "left"))
    return scored.groupBy("CustomerID").agg(
        F.count("TransactionID").alias("TransactionCount30D"),
        F.sum("Amount").alias("TotalTransactionAmount30D"),
        exact_average("RiskScore").alias("AverageTransactionRiskScore"),
        F.count_if(F.col("RiskScore") >= HIGH_FROM).alias("HighRiskTransactionCount"),
    )


def session_profile(silver: Silver, last: dt.date | None) -> DataFrame:
    recent = silver["sessions"].filter(within_window("LoginTimestamp", last))
    return recent.groupBy("CustomerID").agg(
        F.sum("FailedAttempts").alias("FailedLoginCount"),
        F.count_distinct("DeviceID").alias("DistinctDeviceCount"),
        F.count_if(F.col("Country") != "US").alias("GeographicAnomalyCount"),
    )


def untrusted_devices(silver: Silver) -> DataFrame:
    return silver["devices"].groupBy("CustomerID").agg(
        F.count_if(~F.col("Trusted")).alias("UntrustedDeviceCount"))


def alerts_per_customer(silver: Silver) -> DataFrame:
    return silver["fraud_alerts"].groupBy("CustomerID").agg(
        F.count("AlertID").alias("FraudAlertCount"))


def customer_risk_profile(silver: Silver, dates: AsOf | None = None,
                          customers: DataFrame | None = None, by_hash: bool = False) -> DataFrame:
    """One row per customer: behaviour, score and band.

    Each side is aggregated to one row per customer before the joins, so no
    join sees more than one row per key.  ``customers`` is the customer
    dimension where it is already written; ``by_hash`` is for silver that does not lie
    partitioned by transaction.
    """
    dates = dates or as_of(silver)
    profile = dim_customer(silver) if customers is None else customers
    for side in (transaction_profile(silver, dates.transactions, by_hash),
                 session_profile(silver, dates.sessions),
                 untrusted_devices(silver),
                 alerts_per_customer(silver)):
        profile = profile.join(side, "CustomerID", "left")
    profile = profile.fillna(0).withColumn("CustomerRiskScore", customer_risk_score())
    return profile.withColumn("CustomerRiskBand", risk_band(F.col("CustomerRiskScore")))
