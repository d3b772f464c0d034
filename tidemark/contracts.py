"""The banking model as data: source columns, typing, keys, rules.

The operators are generic; everything that is specific to the six source
entities is stated here.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Source headers (order matters) and the type each column takes
# when it is conformed.  The first column of a table is its key.
# ---------------------------------------------------------------------------
SOURCE_COLUMNS: Mapping[str, Mapping[str, str]] = {
    "TRANSACTIONS": {
        "TRANSACTION_ID": "string", "ACCOUNT_ID": "string", "CUSTOMER_ID": "string",
        "MERCHANT_ID": "string", "DEVICE_ID": "string", "TRANSACTION_TIMESTAMP": "timestamp",
        "AMOUNT": "decimal(18,2)", "CURRENCY": "string", "TRANSACTION_TYPE": "string",
        "MERCHANT_CATEGORY": "string", "CHANNEL": "string", "COUNTRY": "string",
        "CARD_PRESENT": "boolean", "TRANSACTION_STATUS": "string", "SOURCE_BATCH": "string",
    },
    "TRANSACTION_RISK": {
        "TRANSACTION_ID": "string", "RISK_SCORE": "double", "RISK_BAND": "string",
        "MODEL_VERSION": "string", "SCORED_TIMESTAMP": "timestamp",
        "RISK_FACTORS_JSON": "string", "SOURCE_BATCH": "string",
    },
    "MERCHANTS": {
        "MERCHANT_ID": "string", "MERCHANT_NAME": "string", "MERCHANT_CATEGORY": "string",
        "CITY": "string", "STATE": "string", "COUNTRY": "string",
        "MERCHANT_RISK_CATEGORY": "string", "SOURCE_BATCH": "string",
    },
    "DIGITAL_SESSIONS": {
        "SESSION_ID": "string", "CUSTOMER_ID": "string", "DEVICE_ID": "string",
        "DEVICE_TYPE": "string", "OPERATING_SYSTEM": "string", "LOGIN_TIMESTAMP": "timestamp",
        "LOGOUT_TIMESTAMP": "timestamp", "AUTHENTICATION_METHOD": "string",
        "MFA_USED": "boolean", "FAILED_ATTEMPTS": "int", "COUNTRY": "string",
        "STATE": "string", "CITY": "string", "SESSION_RISK_SCORE": "double",
        "ACTIVITIES_JSON": "string", "SOURCE_BATCH": "string",
    },
    "DEVICES": {
        "DEVICE_ID": "string", "CUSTOMER_ID": "string", "FIRST_SEEN": "timestamp",
        "LAST_SEEN": "timestamp", "TRUSTED": "boolean", "DEVICE_FINGERPRINT": "string",
        "OPERATING_SYSTEM": "string", "OPERATING_SYSTEM_VERSION": "string",
        "APP_VERSION": "string", "RISK_SIGNALS_JSON": "string", "SOURCE_BATCH": "string",
    },
    "FRAUD_ALERTS": {
        "ALERT_ID": "string", "CUSTOMER_ID": "string", "TRANSACTION_ID": "string",
        "CREATED_TIMESTAMP": "timestamp", "ALERT_TYPE": "string", "SEVERITY": "string",
        "STATUS": "string", "SIGNALS_JSON": "string", "INVESTIGATOR_NOTES_JSON": "string",
        "SOURCE_BATCH": "string",
    },
}

# Columns a source object must have to pass source validation.
REQUIRED_COLUMNS: Mapping[str, tuple[str, ...]] = {
    "TRANSACTIONS": ("TRANSACTION_ID", "CUSTOMER_ID", "ACCOUNT_ID", "MERCHANT_ID",
                     "TRANSACTION_TIMESTAMP", "AMOUNT"),
    "TRANSACTION_RISK": ("TRANSACTION_ID", "RISK_SCORE", "RISK_BAND", "SCORED_TIMESTAMP"),
    "MERCHANTS": ("MERCHANT_ID", "MERCHANT_NAME", "MERCHANT_RISK_CATEGORY"),
    "DIGITAL_SESSIONS": ("SESSION_ID", "CUSTOMER_ID", "DEVICE_ID", "LOGIN_TIMESTAMP",
                         "FAILED_ATTEMPTS"),
    "DEVICES": ("DEVICE_ID", "CUSTOMER_ID", "TRUSTED", "OPERATING_SYSTEM"),
    "FRAUD_ALERTS": ("ALERT_ID", "CUSTOMER_ID", "TRANSACTION_ID", "CREATED_TIMESTAMP",
                     "SEVERITY"),
}

# The contract pads identifiers to the widths below.  Numbers that need more digits
# keep them all, up to this many, so a table may outgrow the padding.
MOST_DIGITS = 18

# Identifier prefixes and the digits they are padded to.
ID_PATTERNS: Mapping[str, str] = {
    column: rf"^{prefix}\d{{{padded},{MOST_DIGITS}}}$"
    for column, prefix, padded in (
        ("TRANSACTION_ID", "TXN-", 9),
        ("CUSTOMER_ID", "CUST-", 6),
        ("ACCOUNT_ID", "ACCT", 9),
        ("MERCHANT_ID", "MER", 6),
        ("DEVICE_ID", "DEVICE-", 6),
    )
}

# Fixed values: (child table, column, parent table) checked on a first batch.
BATCH_REFERENCES: tuple[tuple[str, str, str], ...] = (
    ("TRANSACTION_RISK", "TRANSACTION_ID", "TRANSACTIONS"),
    ("TRANSACTIONS", "MERCHANT_ID", "MERCHANTS"),
    ("DIGITAL_SESSIONS", "DEVICE_ID", "DEVICES"),
)

# Columns of DimDevice the default reader role may see.
READER_DEVICE_COLUMNS: tuple[str, ...] = (
    "DeviceID", "CustomerID", "FirstSeen", "LastSeen", "Trusted", "DeviceFingerprint",
    "OperatingSystem", "OperatingSystemVersion", "AppVersion", "RiskSignalsJSON", "DeviceSK",
    "pipeline_run_id", "run_date", "gold_loaded_at",
)

# Source batches from oldest to newest; a batch not listed ranks lowest.
BATCH_ORDER: tuple[str, ...] = ("initial", "incremental")


@dataclass(frozen=True)
class Entity:
    """One source table and how its silver table is made from it.

    ``newest_first`` are the columns that decide which copy of a key is kept;
    every other column follows as a tie-breaker so that the choice never
    depends on task order.  ``rules`` are SQL conditions over conformed names.
    """

    source: str
    table: str
    newest_first: tuple[str, ...]
    rules: Mapping[str, str]
    reason: str
    trimmed: tuple[str, ...] = ()
    uppered: tuple[str, ...] = ()
    lowered: tuple[str, ...] = ()
    keeps_batch: bool = False
    renamed: Mapping[str, str] = field(default_factory=dict)
    parent: tuple[str, str] | None = None
    same_grain: str | None = None

    @property
    def columns(self) -> Mapping[str, str]:
        return SOURCE_COLUMNS[self.source]

    @property
    def source_key(self) -> str:
        return next(iter(self.columns))

    @property
    def key(self) -> str:
        return self.conformed_name(self.source_key)

    @property
    def event_time(self) -> str | None:
        """The timestamp that orders the rows, where there is one."""
        times = {self.conformed_name(c) for c, t in self.columns.items() if t == "timestamp"}
        return self.newest_first[0] if self.newest_first[0] in times else None

    def conformed_name(self, source_column: str) -> str:
        if source_column in self.renamed:
            return self.renamed[source_column]
        return pascal_case(source_column)

    @property
    def quarantine(self) -> str:
        return f"quarantine_{self.table}"


def pascal_case(name: str) -> str:
    """``DEVICE_ID`` -> ``DeviceID``; the words ID and JSON stay upper case."""
    return "".join(w if w in ("ID", "JSON") else w.capitalize() for w in name.split("_"))


# Fixed values below: table names, rules with their bounds, and reason texts.
TRANSACTIONS = Entity(
    source="TRANSACTIONS",
    table="transactions",
    newest_first=("TransactionTimestamp", "Amount"),
    rules={
        "key": f"TransactionID RLIKE '^TXN-[0-9]{{9,{MOST_DIGITS}}}$'",
        "customer": "CustomerID IS NOT NULL",
        "timestamp": "TransactionTimestamp IS NOT NULL",
        "amount": "Amount >= 0",
    },
    reason="invalid key, timestamp, or amount",
    trimmed=("TRANSACTION_ID", "ACCOUNT_ID", "CUSTOMER_ID", "MERCHANT_ID", "DEVICE_ID"),
    uppered=("CURRENCY",),
    keeps_batch=True,
    same_grain="FactTransactions",
)

TRANSACTION_RISK = Entity(
    source="TRANSACTION_RISK",
    table="transaction_risk",
    newest_first=("ScoredTimestamp",),
    rules={"score": "RiskScore BETWEEN 0 AND 100"},
    reason="risk score outside 0..100 or orphan TransactionID",
    trimmed=("TRANSACTION_ID",),
    keeps_batch=True,
    renamed={"RISK_FACTORS_JSON": "RiskFactors"},
    parent=("transactions", "TransactionID"),
)

MERCHANTS = Entity(
    source="MERCHANTS",
    table="merchants",
    newest_first=("SourceBatch",),
    rules={"key": "MerchantID IS NOT NULL", "name": "MerchantName IS NOT NULL"},
    reason="missing merchant business key or name",
    keeps_batch=True,
    same_grain="DimMerchant",
)

SESSIONS = Entity(
    source="DIGITAL_SESSIONS",
    table="sessions",
    newest_first=("LoginTimestamp",),
    rules={
        "key": "SessionID IS NOT NULL",
        "customer": "CustomerID IS NOT NULL",
        "device": "DeviceID IS NOT NULL",
        "login": "LoginTimestamp IS NOT NULL",
    },
    reason="missing key, device, customer, or valid login timestamp",
    same_grain="FactDigitalSessions",
)

DEVICES = Entity(
    source="DEVICES",
    table="devices",
    newest_first=("LastSeen",),
    rules={"key": "DeviceID IS NOT NULL", "customer": "CustomerID IS NOT NULL"},
    reason="missing device or customer business key",
    same_grain="DimDevice",
)

ALERTS = Entity(
    source="FRAUD_ALERTS",
    table="fraud_alerts",
    newest_first=("CreatedTimestamp",),
    rules={
        "key": "AlertID IS NOT NULL",
        "customer": "CustomerID IS NOT NULL",
        "created": "CreatedTimestamp IS NOT NULL",
        "severity": "Severity IN ('low', 'medium', 'high', 'critical')",
    },
    reason="missing key/timestamp or invalid severity",
    lowered=("SEVERITY", "STATUS"),
    same_grain="FactFraudAlerts",
)

# Parents come before the entities that refer to them.
ENTITIES: tuple[Entity, ...] = (
    TRANSACTIONS, TRANSACTION_RISK, MERCHANTS, SESSIONS, DEVICES, ALERTS,
)
BY_TABLE: Mapping[str, Entity] = {e.table: e for e in ENTITIES}
BY_SOURCE: Mapping[str, Entity] = {e.source: e for e in ENTITIES}

# Gold objects in publishing order: dimensions before the facts that use them.
GOLD_TABLES: tuple[str, ...] = (
    "DimCustomer", "DimAccount", "DimMerchant", "DimDevice", "DimDate",
    "FactTransactions", "FactDigitalSessions", "FactFraudAlerts", "AggCustomerRiskProfile",
)

AUDIT_COLUMNS: Mapping[str, str] = {
    "pipeline_run_id": "string", "run_date": "string", "stage": "string", "status": "string",
    "rows_read": "bigint", "rows_written": "bigint", "started_at": "timestamp",
    "ended_at": "timestamp", "duration_seconds": "bigint", "error_message": "string",
}

VALIDATION_SCHEMA = (
    "pipeline_run_id string, run_date string, source string, object string, "
    "source_count bigint, validation_type string, status string, notes string"
)
