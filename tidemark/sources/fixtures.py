"""The six banking source tables as a mapping of the given test tables.

Bad rows come from fixed conditions on the data, so every rule has rows to
catch at every scale.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.contracts import SOURCE_COLUMNS
from tidemark.functions.text import zero_padded


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _id(prefix: str, number: Column, width: int) -> Column:
    return F.concat(F.lit(prefix), zero_padded(number, width))


def _iso(timestamp: Column) -> Column:
    return F.date_format(timestamp, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def _in_contract_order(df: DataFrame, source: str, **columns: Column) -> DataFrame:
    columns.setdefault("SOURCE_BATCH", F.lit("initial"))
    return df.select(*[columns[c].alias(c) if c in columns
                       else F.lit(None).cast("string").alias(c)
                       for c in SOURCE_COLUMNS[source]])


def _transaction_id() -> Column:
    number = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    prefix = F.when(F.col("l_orderkey") % 997 == 0, "BAD-").otherwise("TXN-")
    tail = F.when(F.col("l_linenumber") == 7, " ").otherwise("")
    return F.concat(prefix, zero_padded(number, 9), tail)


def _line_timestamp() -> Column:
    return F.when(F.col("l_quantity") == 1, "not-a-timestamp").otherwise(_iso(F.col("l_shipdate")))


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    rows = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    customer, line = F.col("o_custkey"), F.col("l_linenumber")
    price = F.col("l_extendedprice")
    returned = (F.col("l_returnflag") == "R") & (F.col("l_quantity") == 50)
    return _in_contract_order(
        rows, "TRANSACTIONS",
        TRANSACTION_ID=_transaction_id(),
        ACCOUNT_ID=_id("ACCT", customer * 2 + line % 2, 9),
        CUSTOMER_ID=_id("CUST-", customer, 6),
        MERCHANT_ID=_id("MER", F.col("l_suppkey"), 6),
        DEVICE_ID=_id("DEVICE-", customer * 3 + line % 3 + 1, 6),
        TRANSACTION_TIMESTAMP=_line_timestamp(),
        AMOUNT=F.when(returned, -price).otherwise(price).cast("decimal(18,2)"),
        CURRENCY=F.lit("usd"),
        TRANSACTION_TYPE=F.lit("Purchase"),
        MERCHANT_CATEGORY=F.lit("Retail"),
        CHANNEL=F.col("l_linestatus"),
        COUNTRY=F.lit("US"),
        CARD_PRESENT=F.lit("True"),
        TRANSACTION_STATUS=F.col("l_returnflag"),
    )


def transaction_risk(spark: SparkSession, folder: str) -> DataFrame:
    """One score per transaction row, dated like the row, copies included."""
    score = F.round(F.col("l_discount") * 700 + F.col("l_tax") * 500, 2)
    band = F.when(score >= 80, "High").when(score >= 45, "Medium").otherwise("Low")
    return _in_contract_order(
        table(spark, folder, "lineitem"), "TRANSACTION_RISK",
        TRANSACTION_ID=_transaction_id(),
        RISK_SCORE=score,
        RISK_BAND=band,
        MODEL_VERSION=F.lit("synthetic-risk-v1"),
        SCORED_TIMESTAMP=_line_timestamp(),
        RISK_FACTORS_JSON=F.lit("[]"),
    )


def merchants(spark: SparkSession, folder: str) -> DataFrame:
    nations = table(spark, folder, "nation").select("n_nationkey", "n_name")
    rows = table(spark, folder, "supplier").join(
        nations, F.col("s_nationkey") == F.col("n_nationkey"), "left")
    digit = F.col("s_suppkey") % 10
    return _in_contract_order(
        rows, "MERCHANTS",
        MERCHANT_ID=_id("MER", F.col("s_suppkey"), 6),
        MERCHANT_NAME=F.when(F.col("s_acctbal") >= 0, F.col("s_name")),
        MERCHANT_CATEGORY=F.lit("Retail"),
        COUNTRY=F.col("n_name"),
        MERCHANT_RISK_CATEGORY=F.when(digit == 9, "High").when(digit >= 6, "Medium")
        .otherwise("Low"),
    )


def _events(spark: SparkSession, folder: str) -> DataFrame:
    """Events with the number ``k`` of their properties and their device number."""
    k = F.get_json_object("props", "$.k").cast("int")
    return table(spark, folder, "events").withColumn("k", k).withColumn(
        "dev", F.col("user_id") * 3 + F.col("k") % 3 + 1)


def sessions(spark: SparkSession, folder: str) -> DataFrame:
    k = F.col("k")
    return _in_contract_order(
        _events(spark, folder), "DIGITAL_SESSIONS",
        SESSION_ID=_id("SESSION-", F.col("event_id"), 9),
        CUSTOMER_ID=_id("CUST-", F.col("user_id"), 6),
        DEVICE_ID=F.when(k != 99, _id("DEVICE-", F.col("dev"), 6)),
        DEVICE_TYPE=F.lit("Mobile"),
        OPERATING_SYSTEM=F.lit("Android"),
        LOGIN_TIMESTAMP=F.col("ts"),
        LOGOUT_TIMESTAMP=F.col("ts") + F.expr("interval 5 minutes"),
        AUTHENTICATION_METHOD=F.lit("passkey"),
        MFA_USED=F.lit("True"),
        FAILED_ATTEMPTS=F.when(F.col("event_type") == "error", 1 + k % 3).otherwise(0),
        COUNTRY=F.when(k >= 90, "GB").otherwise("US"),
        SESSION_RISK_SCORE=F.least(F.lit(100.0), F.col("value")),
        ACTIVITIES_JSON=F.lit("[]"),
    )


def devices(spark: SparkSession, folder: str) -> DataFrame:
    """One row per device number; a device number stands for one (user, k % 3)."""
    per_device = _events(spark, folder).groupBy("user_id", "dev").agg(
        F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
    dev = F.col("dev")
    return _in_contract_order(
        per_device, "DEVICES",
        DEVICE_ID=_id("DEVICE-", dev, 6),
        CUSTOMER_ID=_id("CUST-", F.col("user_id"), 6),
        FIRST_SEEN=F.col("first_ts"),
        LAST_SEEN=F.col("last_ts"),
        TRUSTED=F.when(dev % 7 != 0, "True").otherwise("False"),
        DEVICE_FINGERPRINT=_id("SYNTH-FP-", dev, 8),
        OPERATING_SYSTEM=F.lit("Android"),
        RISK_SIGNALS_JSON=F.lit("[]"),
    )


def alerts(spark: SparkSession, folder: str) -> DataFrame:
    event, value = F.col("event_id"), F.col("value")
    order_count = table(spark, folder, "orders").count()  # from the file footers
    transaction = _id("TXN-", (event % order_count) * 10 + 1 + event % 7, 9)
    severity = (F.when(F.col("event_type") == "signup", "unknown")
                .when(value >= 300, "CRITICAL").when(value >= 200, "HIGH")
                .when(value >= 150, "Medium").otherwise("low"))
    return _in_contract_order(
        table(spark, folder, "events").filter(value >= 50), "FRAUD_ALERTS",
        ALERT_ID=_id("ALERT-", event, 8),
        CUSTOMER_ID=_id("CUST-", F.col("user_id"), 6),
        TRANSACTION_ID=F.when(event % 13 != 0, transaction),
        CREATED_TIMESTAMP=F.col("ts"),
        ALERT_TYPE=F.lit("transactionAnomaly"),
        SEVERITY=severity,
        STATUS=F.lit("OPEN"),
        SIGNALS_JSON=F.lit("[]"),
        INVESTIGATOR_NOTES_JSON=F.lit("[]"),
    )


BUILDERS = {
    "TRANSACTIONS": transactions,
    "TRANSACTION_RISK": transaction_risk,
    "MERCHANTS": merchants,
    "DIGITAL_SESSIONS": sessions,
    "DEVICES": devices,
    "FRAUD_ALERTS": alerts,
}


def source_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {name: build(spark, folder) for name, build in BUILDERS.items()}


def event_changes(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """A base load and a change set that together cover all events.

    The base is every event but the sign-ups.  The changes add the sign-ups and
    restate every error with its value raised by 1000.
    """
    events = table(spark, folder, "events")
    kind = F.col("event_type")
    base = events.filter(kind != "signup")
    raised = F.when(kind == "error", F.col("value") + 1000).otherwise(F.col("value"))
    changes = events.filter(kind.isin("signup", "error")).withColumn("value", raised)
    return base, changes
