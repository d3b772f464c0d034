"""Dimensions and facts of the gold star schema.

A surrogate key is a function of the natural key alone.  Where a dimension is
built from the fact's own rows (customer, account) every key resolves, so the
key lookup is a projection and costs no shuffle; a join is made only where
membership in the dimension can fail (merchant, device).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import surrogate_key
from tidemark.operators.conform import join_by_hash

Silver = Mapping[str, DataFrame]


def date_key(timestamp: str) -> Column:
    return F.date_format(timestamp, "yyyyMMdd").cast("int")


def lookup_key(fact: DataFrame, dimension: DataFrame, key: str, surrogate: str,
               how: str = "left") -> DataFrame:
    """Add a dimension's surrogate key by natural key.

    No hint: Spark broadcasts the two-column dimension side when its measured
    size allows and otherwise sort-merges, splitting hot keys at run time.
    """
    return fact.join(dimension.select(key, surrogate), key, how)


def dim_customer(silver: Silver) -> DataFrame:
    """Every customer id seen in any of the four customer-bearing tables."""
    ids = None
    for table in ("transactions", "sessions", "devices", "fraud_alerts"):
        part = silver[table].select("CustomerID")
        ids = part if ids is None else ids.unionByName(part)
    return ids.distinct().withColumn("CustomerSK", surrogate_key("CustomerID"))


def dim_account(silver: Silver) -> DataFrame:
    """One row per account; a shared account belongs to its lowest customer id.

    The pairs are made distinct first, by hash and ahead of the shuffle, so the
    string minimum only ever sees a handful of rows per account.
    """
    pairs = silver["transactions"].select("AccountID", "CustomerID").distinct()
    return (pairs.groupBy("AccountID").agg(F.min("CustomerID").alias("CustomerID"))
            .withColumn("AccountSK", surrogate_key("AccountID")))


def dim_merchant(silver: Silver) -> DataFrame:
    return silver["merchants"].withColumn("MerchantSK", surrogate_key("MerchantID"))


def dim_device(silver: Silver) -> DataFrame:
    return silver["devices"].withColumn("DeviceSK", surrogate_key("DeviceID"))


def dim_date(silver: Silver, extra_dates: DataFrame | None = None) -> DataFrame:
    """Every day from the first to the last transaction or session date.

    ``extra_dates`` (one date column ``d``) widens the range, for example to the
    alert dates.  No dates, no rows.
    """
    bounds = (silver["transactions"].select(F.to_date("TransactionTimestamp").alias("d"))
              .unionByName(silver["sessions"].select(F.to_date("LoginTimestamp").alias("d"))))
    if extra_dates is not None:
        bounds = bounds.unionByName(extra_dates.select(F.col("d").cast("date").alias("d")))
    span = bounds.agg(F.min("d").alias("first"), F.max("d").alias("last"))
    days = span.filter(F.col("first").isNotNull()).select(
        F.explode(F.expr("sequence(first, last, interval 1 day)")).alias("FullDate"))
    return days.select(
        "FullDate",
        date_key("FullDate").alias("DateKey"),
        F.year("FullDate").alias("Year"),
        F.month("FullDate").alias("Month"),
        F.dayofmonth("FullDate").alias("Day"),
        F.date_format("FullDate", "EEEE").alias("DayName"),
    )


def fact_transactions(silver: Silver, keep_unknown_accounts: bool = False,
                      natural_keys: bool = False, by_hash: bool = False) -> DataFrame:
    """Valid transactions with their risk score and dimension keys.

    Transactions without an account have no account dimension row and are left
    out, unless ``keep_unknown_accounts`` keeps them with a NULL key.
    ``natural_keys`` also returns the ids the keys stand for; the merchant id is
    then NULL where the merchant is not in the dimension.  ``by_hash`` joins the scores
    by the hash of the id first; not for rows that lie partitioned by the id.
    """
    rows = silver["transactions"]
    if not keep_unknown_accounts:
        rows = rows.filter(F.col("AccountID").isNotNull())
    scores = silver["transaction_risk"].select("TransactionID", "RiskScore", "RiskBand")
    rows = (join_by_hash(rows, scores, "TransactionID") if by_hash
            else rows.join(scores, "TransactionID", "left"))
    rows = lookup_key(rows, dim_merchant(silver), "MerchantID", "MerchantSK")
    account_key = F.when(F.col("AccountID").isNotNull(), surrogate_key("AccountID"))
    columns = [
        "TransactionID",
        surrogate_key("CustomerID").alias("CustomerSK"),
        account_key.alias("AccountSK"),
        "MerchantSK", "DeviceID",
        date_key("TransactionTimestamp").alias("DateKey"),
        "TransactionTimestamp", "Amount", "Currency", "Channel", "TransactionStatus",
        "RiskScore", "RiskBand",
    ]
    if natural_keys:
        known = F.when(F.col("MerchantSK").isNotNull(), F.col("MerchantID"))
        columns += ["CustomerID", "AccountID", known.alias("MerchantID")]
    return rows.select(*columns)


def fact_sessions(silver: Silver, natural_keys: bool = False) -> DataFrame:
    rows = lookup_key(silver["sessions"], dim_device(silver), "DeviceID", "DeviceSK")
    columns = [
        "SessionID", surrogate_key("CustomerID").alias("CustomerSK"), "DeviceSK",
        date_key("LoginTimestamp").alias("DateKey"), "LoginTimestamp", "LogoutTimestamp",
        "AuthenticationMethod", "MfaUsed", "FailedAttempts", "Country", "SessionRiskScore",
    ]
    if natural_keys:
        known = F.when(F.col("DeviceSK").isNotNull(), F.col("DeviceID"))
        columns += ["CustomerID", known.alias("DeviceID")]
    return rows.select(*columns)


def fact_alerts(silver: Silver, natural_keys: bool = False) -> DataFrame:
    columns = [
        "AlertID", surrogate_key("CustomerID").alias("CustomerSK"), "TransactionID",
        date_key("CreatedTimestamp").alias("DateKey"), "CreatedTimestamp", "AlertType",
        "Severity", "Status",
    ]
    return silver["fraud_alerts"].select(*columns, *(["CustomerID"] if natural_keys else []))


def orphan_date_keys(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """Date keys of a fact that the date dimension does not have, with row counts."""
    per_key = fact.groupBy("DateKey").agg(F.count("*").alias("row_count"))
    return per_key.join(dates.select("DateKey"), "DateKey", "left_anti")
