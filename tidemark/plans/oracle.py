"""The registered queries once more, as plain SQL over the given tables.

Written from the definitions and not from the DataFrame code, so the two check
each other.  Common steps are named subqueries; each statement carries the ones
it needs.
"""

from __future__ import annotations

import re

from tidemark.operators.scan import HEX_TOKEN_RULE, SAFE_LITERALS, SAFE_REPLACEMENT, SECRET_RULES


def _pad(number: str, width: int) -> str:
    text = f"CAST({number} AS VARCHAR)"
    return f"lpad({text}, CAST(greatest({width}, length({text})) AS INTEGER), '0')"


def _id(prefix: str, number: str, width: int) -> str:
    return f"'{prefix}' || {_pad(number, width)}"


def _latest(source: str, key: str, order: str) -> str:
    return (f"SELECT * FROM {source} QUALIFY row_number() OVER "
            f"(PARTITION BY {key} ORDER BY {order}) = 1")


_TXN_ID = (f"(CASE WHEN l_orderkey % 997 = 0 THEN 'BAD-' ELSE 'TXN-' END) || "
           f"{_pad('(l_orderkey * 10 + l_linenumber)', 9)} || "
           "(CASE WHEN l_linenumber = 7 THEN ' ' ELSE '' END)")
_TXN_TIME = "CASE WHEN l_quantity = 1 THEN NULL ELSE l_shipdate END"
_HALF_UP = "floor({0} * 100 + 0.5 + 1e-7) / 100"
_SCORE = ("least(100.0, coalesce(AverageTransactionRiskScore, 0.0) * 0.45"
          " + least(FraudAlertCount * 12.0::DOUBLE, 24.0::DOUBLE)"
          " + least(FailedLoginCount * 2.0::DOUBLE, 12.0::DOUBLE)"
          " + least(UntrustedDeviceCount * 5.0::DOUBLE, 10.0::DOUBLE)"
          " + least(GeographicAnomalyCount * 3.0::DOUBLE, 9.0::DOUBLE))")

STEPS: dict[str, str] = {
    # sources, typed
    "src_txn": f"""
        SELECT {_TXN_ID} AS TRANSACTION_ID,
               {_id('ACCT', '(o_custkey * 2 + l_linenumber % 2)', 9)} AS AccountID,
               {_id('CUST-', 'o_custkey', 6)} AS CustomerID,
               {_id('MER', 'l_suppkey', 6)} AS MerchantID,
               {_id('DEVICE-', '(o_custkey * 3 + l_linenumber % 3 + 1)', 6)} AS DeviceID,
               {_TXN_TIME} AS TransactionTimestamp,
               CAST(CASE WHEN l_returnflag = 'R' AND l_quantity = 50 THEN -l_extendedprice
                         ELSE l_extendedprice END AS DECIMAL(18,2)) AS Amount,
               'USD' AS Currency, 'Purchase' AS TransactionType,
               'Retail' AS MerchantCategory, l_linestatus AS Channel, 'US' AS Country,
               TRUE AS CardPresent, l_returnflag AS TransactionStatus, 'initial' AS SourceBatch
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "con_txn": "SELECT trim(TRANSACTION_ID) AS TransactionID, * EXCLUDE (TRANSACTION_ID) FROM src_txn",
    "src_risk": f"""
        SELECT {_TXN_ID} AS TRANSACTION_ID, round(l_discount * 700 + l_tax * 500, 2) AS RiskScore,
               {_TXN_TIME} AS ScoredTimestamp
        FROM lineitem""",
    "con_risk": """
        SELECT trim(TRANSACTION_ID) AS TransactionID, RiskScore,
               CASE WHEN RiskScore >= 80 THEN 'High' WHEN RiskScore >= 45 THEN 'Medium'
                    ELSE 'Low' END AS RiskBand,
               'synthetic-risk-v1' AS ModelVersion, ScoredTimestamp, '[]' AS RiskFactors,
               'initial' AS SourceBatch
        FROM src_risk""",
    "con_mer": f"""
        SELECT {_id('MER', 's_suppkey', 6)} AS MerchantID,
               CASE WHEN s_acctbal >= 0 THEN s_name END AS MerchantName,
               'Retail' AS MerchantCategory, CAST(NULL AS VARCHAR) AS City,
               CAST(NULL AS VARCHAR) AS State, n_name AS Country,
               CASE WHEN s_suppkey % 10 = 9 THEN 'High' WHEN s_suppkey % 10 >= 6 THEN 'Medium'
                    ELSE 'Low' END AS MerchantRiskCategory,
               'initial' AS SourceBatch
        FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey""",
    "ev": """
        SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
               user_id * 3 + CAST(json_extract_string(props, '$.k') AS INTEGER) % 3 + 1 AS dev
        FROM events""",
    "con_ses": f"""
        SELECT {_id('SESSION-', 'event_id', 9)} AS SessionID,
               {_id('CUST-', 'user_id', 6)} AS CustomerID,
               CASE WHEN k <> 99 THEN {_id('DEVICE-', 'dev', 6)} END AS DeviceID,
               'Mobile' AS DeviceType, 'Android' AS OperatingSystem, ts AS LoginTimestamp,
               ts + INTERVAL 5 MINUTE AS LogoutTimestamp, 'passkey' AS AuthenticationMethod,
               TRUE AS MfaUsed,
               CAST(CASE WHEN event_type = 'error' THEN 1 + k % 3 ELSE 0 END AS INTEGER)
                   AS FailedAttempts,
               CASE WHEN k >= 90 THEN 'GB' ELSE 'US' END AS Country,
               CAST(NULL AS VARCHAR) AS State, CAST(NULL AS VARCHAR) AS City,
               least(100.0::DOUBLE, value) AS SessionRiskScore, '[]' AS ActivitiesJSON
        FROM ev""",
    "con_dev": f"""
        SELECT {_id('DEVICE-', 'dev', 6)} AS DeviceID, {_id('CUST-', 'user_id', 6)} AS CustomerID,
               min(ts) AS FirstSeen, max(ts) AS LastSeen, dev % 7 <> 0 AS Trusted,
               {_id('SYNTH-FP-', 'dev', 8)} AS DeviceFingerprint, 'Android' AS OperatingSystem,
               CAST(NULL AS VARCHAR) AS OperatingSystemVersion,
               CAST(NULL AS VARCHAR) AS AppVersion, '[]' AS RiskSignalsJSON
        FROM ev GROUP BY user_id, dev""",
    "con_ale": f"""
        SELECT {_id('ALERT-', 'event_id', 8)} AS AlertID,
               {_id('CUST-', 'user_id', 6)} AS CustomerID,
               CASE WHEN event_id % 13 <> 0 THEN
                   {_id('TXN-', '((event_id % (SELECT count(*) FROM orders)) * 10 + 1 + event_id % 7)', 9)}
               END AS TransactionID,
               ts AS CreatedTimestamp, 'transactionAnomaly' AS AlertType,
               CASE WHEN event_type = 'signup' THEN 'unknown' WHEN value >= 300 THEN 'critical'
                    WHEN value >= 200 THEN 'high' WHEN value >= 150 THEN 'medium'
                    ELSE 'low' END AS Severity,
               'open' AS Status, '[]' AS SignalsJSON, '[]' AS InvestigatorNotesJSON
        FROM events WHERE value >= 50""",
    # latest row per key
    "lat_txn": _latest("con_txn", "TransactionID",
                       "TransactionTimestamp DESC NULLS LAST, Amount DESC, AccountID DESC, "
                       "CustomerID DESC, MerchantID DESC, DeviceID DESC, Channel DESC, "
                       "TransactionStatus DESC"),
    "lat_risk": _latest("con_risk", "TransactionID",
                        "ScoredTimestamp DESC NULLS LAST, RiskScore DESC"),
    # verdicts
    "ver_txn": """
        SELECT *, coalesce(regexp_matches(TransactionID, '^TXN-[0-9]{9,18}$')
               AND CustomerID IS NOT NULL AND TransactionTimestamp IS NOT NULL
               AND Amount >= 0, FALSE) AS is_valid FROM lat_txn""",
    "txn": "SELECT * EXCLUDE (is_valid) FROM ver_txn WHERE is_valid",
    "ver_risk": """
        SELECT r.*, coalesce(RiskScore >= 0 AND RiskScore <= 100, FALSE)
               AND EXISTS (SELECT 1 FROM txn t WHERE t.TransactionID = r.TransactionID) AS is_valid
        FROM lat_risk r""",
    "ver_mer": "SELECT *, MerchantID IS NOT NULL AND MerchantName IS NOT NULL AS is_valid FROM con_mer",
    "ver_ses": """
        SELECT *, SessionID IS NOT NULL AND CustomerID IS NOT NULL AND DeviceID IS NOT NULL
               AND LoginTimestamp IS NOT NULL AS is_valid FROM con_ses""",
    "ver_dev": "SELECT *, DeviceID IS NOT NULL AND CustomerID IS NOT NULL AS is_valid FROM con_dev",
    "ver_ale": """
        SELECT *, AlertID IS NOT NULL AND CustomerID IS NOT NULL AND CreatedTimestamp IS NOT NULL
               AND Severity IN ('low', 'medium', 'high', 'critical') AS is_valid FROM con_ale""",
    "risk": "SELECT * EXCLUDE (is_valid) FROM ver_risk WHERE is_valid",
    "mer": "SELECT * EXCLUDE (is_valid) FROM ver_mer WHERE is_valid",
    "ses": "SELECT * EXCLUDE (is_valid) FROM ver_ses WHERE is_valid",
    "dev": "SELECT * EXCLUDE (is_valid) FROM ver_dev WHERE is_valid",
    "ale": "SELECT * EXCLUDE (is_valid) FROM ver_ale WHERE is_valid",
    # gold
    "dimcust": """
        SELECT CustomerID FROM txn UNION SELECT CustomerID FROM ses
        UNION SELECT CustomerID FROM dev UNION SELECT CustomerID FROM ale""",
    "dimacct": "SELECT AccountID, min(CustomerID) AS CustomerID FROM txn GROUP BY AccountID",
    "bounds": """
        SELECT min(d) AS lo, max(d) AS hi FROM (
            SELECT CAST(TransactionTimestamp AS DATE) AS d FROM txn
            UNION ALL SELECT CAST(LoginTimestamp AS DATE) FROM ses)""",
    "dimdate": """
        SELECT CAST(t AS DATE) AS FullDate FROM (
            SELECT unnest(generate_series(lo::TIMESTAMP, hi::TIMESTAMP, INTERVAL 1 DAY)) AS t
            FROM bounds)""",
    "facttxn": """
        SELECT t.TransactionID, t.DeviceID,
               CAST(strftime(TransactionTimestamp, '%Y%m%d') AS INTEGER) AS DateKey,
               TransactionTimestamp, Amount, Currency, Channel, TransactionStatus, RiskScore,
               RiskBand, t.CustomerID, t.AccountID, m.MerchantID, m.MerchantName,
               m.MerchantRiskCategory
        FROM txn t LEFT JOIN risk r ON t.TransactionID = r.TransactionID
        LEFT JOIN mer m ON t.MerchantID = m.MerchantID
        WHERE t.AccountID IS NOT NULL""",
    "factses": """
        SELECT SessionID, CAST(strftime(LoginTimestamp, '%Y%m%d') AS INTEGER) AS DateKey,
               LoginTimestamp, LogoutTimestamp, AuthenticationMethod, MfaUsed, FailedAttempts,
               Country, SessionRiskScore, s.CustomerID, d.DeviceID
        FROM ses s LEFT JOIN dev d ON s.DeviceID = d.DeviceID""",
    "factale": """
        SELECT AlertID, TransactionID,
               CAST(strftime(CreatedTimestamp, '%Y%m%d') AS INTEGER) AS DateKey,
               CreatedTimestamp, AlertType, Severity, Status, CustomerID
        FROM ale""",
    "txn30": """
        SELECT t.CustomerID, count(t.TransactionID) AS TransactionCount30D,
               CAST(sum(Amount) AS DECIMAL(28,2)) AS TotalTransactionAmount30D,
               CAST(sum(CAST(RiskScore AS DECIMAL(18,10))) AS DOUBLE) / nullif(count(RiskScore), 0)
                   AS AverageTransactionRiskScore,
               CAST(sum(CASE WHEN RiskScore >= 80 THEN 1 ELSE 0 END) AS BIGINT)
                   AS HighRiskTransactionCount
        FROM txn t LEFT JOIN risk r ON t.TransactionID = r.TransactionID
        WHERE CAST(TransactionTimestamp AS DATE) BETWEEN
              (SELECT max(CAST(TransactionTimestamp AS DATE)) - 29 FROM txn)
          AND (SELECT max(CAST(TransactionTimestamp AS DATE)) FROM txn)
        GROUP BY t.CustomerID""",
    "ses30": """
        SELECT CustomerID, CAST(sum(FailedAttempts) AS BIGINT) AS FailedLoginCount,
               count(DISTINCT DeviceID) AS DistinctDeviceCount,
               CAST(sum(CASE WHEN Country <> 'US' THEN 1 ELSE 0 END) AS BIGINT)
                   AS GeographicAnomalyCount
        FROM ses
        WHERE CAST(LoginTimestamp AS DATE) BETWEEN
              (SELECT max(CAST(LoginTimestamp AS DATE)) - 29 FROM ses)
          AND (SELECT max(CAST(LoginTimestamp AS DATE)) FROM ses)
        GROUP BY CustomerID""",
    "untrust": """
        SELECT CustomerID, CAST(sum(CASE WHEN NOT Trusted THEN 1 ELSE 0 END) AS BIGINT)
               AS UntrustedDeviceCount
        FROM dev GROUP BY CustomerID""",
    "alertcnt": "SELECT CustomerID, count(AlertID) AS FraudAlertCount FROM ale GROUP BY CustomerID",
    "prof0": """
        SELECT c.CustomerID, coalesce(TransactionCount30D, 0) AS TransactionCount30D,
               coalesce(TotalTransactionAmount30D, 0)::DECIMAL(28,2) AS TotalTransactionAmount30D,
               coalesce(AverageTransactionRiskScore, 0) AS AverageTransactionRiskScore,
               coalesce(HighRiskTransactionCount, 0) AS HighRiskTransactionCount,
               coalesce(FailedLoginCount, 0) AS FailedLoginCount,
               coalesce(DistinctDeviceCount, 0) AS DistinctDeviceCount,
               coalesce(GeographicAnomalyCount, 0) AS GeographicAnomalyCount,
               coalesce(UntrustedDeviceCount, 0) AS UntrustedDeviceCount,
               coalesce(FraudAlertCount, 0) AS FraudAlertCount
        FROM dimcust c LEFT JOIN txn30 USING (CustomerID) LEFT JOIN ses30 USING (CustomerID)
        LEFT JOIN untrust USING (CustomerID) LEFT JOIN alertcnt USING (CustomerID)""",
    "prof1": f"SELECT *, {_HALF_UP.format(_SCORE)} AS CustomerRiskScore FROM prof0",
    "prof": """
        SELECT * REPLACE (round(AverageTransactionRiskScore, 4) AS AverageTransactionRiskScore),
               CASE WHEN CustomerRiskScore >= 80 THEN 'High' WHEN CustomerRiskScore >= 45
                    THEN 'Medium' ELSE 'Low' END AS CustomerRiskBand
        FROM prof1""",
    "changed": """
        SELECT event_id, ts, user_id, event_type,
               CASE WHEN event_type = 'error' THEN value + 1000 ELSE value END AS value, props
        FROM events""",
}


def _statement(final: str) -> str:
    """``final`` with the steps it needs; ``STEPS`` lists a step after those it uses."""
    needed: set[str] = set()
    pending = [final]
    while pending:
        read = set(re.findall(r"(?:FROM|JOIN|UNION)\s+\(?([a-z_0-9]+)\b", pending.pop()))
        for name in read & (STEPS.keys() - needed):
            needed.add(name)
            pending.append(STEPS[name])
    steps = ",\n".join(f"{name} AS ({STEPS[name]})" for name in STEPS if name in needed)
    return f"WITH {steps}\n{final}" if steps else final


def _split(verdicts: str, key: str, reason: str) -> str:
    return (f"SELECT {key}, is_valid, CASE WHEN NOT is_valid THEN '{reason}' END AS "
            f"quarantine_reason FROM {verdicts}")


_ENTITIES = (
    ("TRANSACTIONS", "txn", "TransactionID"), ("TRANSACTION_RISK", "risk", "TransactionID"),
    ("MERCHANTS", "mer", "MerchantID"), ("DIGITAL_SESSIONS", "ses", "SessionID"),
    ("DEVICES", "dev", "DeviceID"), ("FRAUD_ALERTS", "ale", "AlertID"),
)
_GOLD_COUNTS = {
    "DimCustomer": "dimcust", "DimAccount": "dimacct", "DimMerchant": "mer", "DimDevice": "dev",
    "DimDate": "dimdate", "FactTransactions": "facttxn", "FactDigitalSessions": "factses",
    "FactFraudAlerts": "factale", "AggCustomerRiskProfile": "prof",
}
_SAME_GRAIN = {"txn": "facttxn", "mer": "mer", "ses": "factses", "dev": "dev", "ale": "factale"}


def _source_total() -> str:
    return "(" + " + ".join(f"(SELECT count(*) FROM con_{s})" for _, s, _ in _ENTITIES) + ")"


def _silver_total() -> str:
    return "(" + " + ".join(f"(SELECT count(*) FROM {s})" for _, s, _ in _ENTITIES) + ")"


def _gold_total(names: tuple[str, ...] = tuple(_GOLD_COUNTS)) -> str:
    return "(" + " + ".join(f"(SELECT count(*) FROM {_GOLD_COUNTS[n]})" for n in names) + ")"


def _null_fields() -> str:
    """NULL fields per source table; the constant ones are columns left empty."""
    counts = {
        "TRANSACTIONS": ("con_txn", "0"),
        "TRANSACTION_RISK": ("con_risk", "0"),
        "MERCHANTS": ("con_mer", "count(*) * 2 + count(*) FILTER (MerchantName IS NULL)"
                                 " + count(*) FILTER (Country IS NULL)"),
        "DIGITAL_SESSIONS": ("con_ses", "count(*) * 2 + count(*) FILTER (DeviceID IS NULL)"),
        "DEVICES": ("con_dev", "count(*) * 2"),
        "FRAUD_ALERTS": ("con_ale", "count(*) FILTER (TransactionID IS NULL)"),
    }
    return " UNION ALL ".join(
        f"SELECT '{name}' AS object, count(*) AS row_count, CAST({nulls} AS BIGINT) AS null_fields"
        f" FROM {step}" for name, (step, nulls) in counts.items())


def _reconciliation() -> str:
    parts = []
    for source, step, key in _ENTITIES:
        gold = f"(SELECT count(*) FROM {_SAME_GRAIN[step]})" if step in _SAME_GRAIN else \
            "CAST(NULL AS BIGINT)"
        parts.append(f"""
            SELECT 'run-1' AS pipeline_run_id, '2024-01-31' AS run_date, 'source' AS source,
                   '{source}' AS object, (SELECT count(*) FROM con_{step}) AS source_count,
                   (SELECT count(*) FROM {step}) AS silver_count, {gold} AS gold_count,
                   (SELECT count(*) FROM ver_{step} WHERE NOT is_valid) AS quarantine_count,
                   (SELECT count(*) - count(DISTINCT {key}) FROM con_{step}) AS duplicate_count,
                   'row_count_minus_quarantine' AS validation_type, 'PASS' AS status""")
    linked = "(SELECT count(*) FROM ale WHERE TransactionID IS NOT NULL)"
    found = "(SELECT count(*) FROM ale WHERE TransactionID IN (SELECT TransactionID FROM txn))"
    parts.append(f"""
        SELECT 'run-1', '2024-01-31', 'cross_domain', 'fraud_alerts_to_transactions', {linked},
               {found}, NULL, {linked} - {found}, 0, 'relationship_validation',
               CASE WHEN {linked} = {found} THEN 'PASS' ELSE 'WARN' END""")
    return " UNION ALL ".join(parts)


def _audit() -> str:
    stages = (
        ("pipeline", "0", "0"),
        ("source_validation", _source_total(), "6"),
        ("silver_transform", _source_total(), _silver_total()),
        ("gold_build", _silver_total(), _gold_total()),
        ("serving_publish", "0",
         _gold_total(("DimCustomer", "DimDevice", "AggCustomerRiskProfile"))),
        ("reconciliation",
         f"{_source_total()} + (SELECT count(*) FROM ale WHERE TransactionID IS NOT NULL)", "7"),
    )
    return " UNION ALL ".join(
        f"SELECT 'run-1' AS pipeline_run_id, '2024-01-31' AS run_date, '{stage}' AS stage, "
        f"'Succeeded' AS status, CAST({read} AS BIGINT) AS rows_read, "
        f"CAST({written} AS BIGINT) AS rows_written, CAST(NULL AS VARCHAR) AS error_message"
        for stage, read, written in stages)


def _batch_checks() -> str:
    patterns = {"CustomerID": ("CUSTOMER_ID", r"^CUST-\d{6,18}$"),
                "AccountID": ("ACCOUNT_ID", r"^ACCT\d{9,18}$"),
                "MerchantID": ("MERCHANT_ID", r"^MER\d{6,18}$"),
                "DeviceID": ("DEVICE_ID", r"^DEVICE-\d{6,18}$")}
    txn_pattern = r"^TXN-\d{9,18}$"
    tables = {  # object -> step, key, pattern columns, transaction id column, manifest table
        "TRANSACTIONS": ("src_txn", "TRANSACTION_ID",
                         ("CustomerID", "AccountID", "MerchantID", "DeviceID"),
                         "TRANSACTION_ID", "lineitem"),
        "TRANSACTION_RISK": ("src_risk", "TRANSACTION_ID", (), "TRANSACTION_ID", "lineitem"),
        "MERCHANTS": ("con_mer", "MerchantID", ("MerchantID",), None, "supplier"),
        "DIGITAL_SESSIONS": ("con_ses", "SessionID", ("CustomerID", "DeviceID"), None, "events"),
        "DEVICES": ("con_dev", "DeviceID", ("CustomerID", "DeviceID"), None, "customer"),
        "FRAUD_ALERTS": ("con_ale", "AlertID", ("CustomerID",), "TransactionID", "events"),
    }
    parts = []
    for name, (step, key, columns, txn_column, manifest) in tables.items():
        parts.append(f"SELECT 'row_count' AS \"check\", '{name}' AS object, CAST(abs((SELECT "
                     f"count(*) FROM {step}) - (SELECT count(*) FROM {manifest})) AS BIGINT) "
                     "AS failures")
        parts.append(f"SELECT 'duplicate_key', '{name}', count(*) - count(DISTINCT {key}) "
                     f"FROM {step}")
        if txn_column:
            parts.append(f"SELECT 'pattern:TRANSACTION_ID', '{name}', count(*) FILTER "
                         f"(NOT regexp_matches({txn_column}, '{txn_pattern}')) FROM {step}")
        for column in columns:
            label, pattern = patterns[column]
            parts.append(f"SELECT 'pattern:{label}', '{name}', count(*) FILTER "
                         f"(NOT regexp_matches({column}, '{pattern}')) FROM {step}")
    parts.append("SELECT 'orphan:TRANSACTION_ID', 'TRANSACTION_RISK', count(*) FROM src_risk "
                 "WHERE TRANSACTION_ID NOT IN (SELECT TRANSACTION_ID FROM src_txn)")
    parts.append("SELECT 'orphan:MERCHANT_ID', 'TRANSACTIONS', count(*) FROM src_txn "
                 "WHERE MerchantID NOT IN (SELECT MerchantID FROM con_mer)")
    parts.append("SELECT 'orphan:DEVICE_ID', 'DIGITAL_SESSIONS', count(*) FROM con_ses "
                 "WHERE coalesce(DeviceID, '') NOT IN (SELECT DeviceID FROM con_dev)")
    return " UNION ALL ".join(parts)


def _scan(table: str, label: str, alias: str) -> str:
    text = "text"
    for literal in SAFE_LITERALS:
        text = f"replace({text}, '{literal}', '{SAFE_REPLACEMENT}')"
    breaks = r"\r\n|[\n\x0b\f\r\x1c\x1d\x1e\x{85}\x{2028}\x{2029}]"
    rules = {**SECRET_RULES, **HEX_TOKEN_RULE}
    branches = " UNION ALL ".join(
        f"SELECT {alias}, line, '{name}' AS rule FROM numbered WHERE regexp_matches(content, "
        f"'{pattern.replace(chr(39), chr(39) * 2)}')" for name, pattern in rules.items())
    return f"""
        WITH cut AS (SELECT {label} AS {alias}, regexp_split_to_array({text}, '{breaks}') AS parts
                     FROM {table}),
             numbered AS (SELECT {alias}, CAST(i AS INTEGER) AS line, parts[i] AS content
                          FROM cut, unnest(generate_series(1, len(parts))) AS n(i))
        {branches}"""


_FINAL: dict[str, str] = {
    "bronze_scan_counts": " UNION ALL ".join(
        f"SELECT '{name}' AS object, count(*) AS row_count FROM con_{step}"
        for name, step, _ in _ENTITIES),
    "csv_contract_load": _null_fields(),
    "idempotent_refresh": "SELECT * FROM con_dev",
    "published_tables": " UNION ALL ".join(
        f"SELECT {i} AS execution_order, '{name}' AS object_name, count(*) AS row_count "
        f"FROM {step}" for i, (name, step) in enumerate(_GOLD_COUNTS.items(), 1)),
    "serving_view_counts": " UNION ALL ".join(
        f"SELECT '{name}' AS view_name, count(*) AS row_count FROM {step}"
        + (" WHERE CustomerRiskBand <> 'High'" if step == "prof" else "")
        for name, step in _GOLD_COUNTS.items()),
    "incremental_apply": "SELECT * FROM changed",
    "stream_upsert_events": "SELECT * FROM changed",
    "stream_merge_events": "SELECT * FROM changed",
    "keyed_change_apply": """
        SELECT event_id, ts, user_id, event_type,
               CASE WHEN event_id % 100 = 7 THEN value + 1000 ELSE value END AS value, props
        FROM events""",
    "bronze_batch_merge": """
        SELECT object, row_key, fields, CASE WHEN right(row_key, 1) IN ('0', '5')
               THEN 'incremental' ELSE 'initial' END AS SOURCE_BATCH
        FROM (SELECT 'MERCHANTS' AS object, MerchantID AS row_key, coalesce(MerchantName
                     || CASE WHEN right(MerchantID, 1) = '0' THEN ' Ltd' ELSE '' END, '') || '|'
                     || coalesce(Country, '') || '|' || MerchantRiskCategory AS fields FROM con_mer
              UNION ALL SELECT 'DEVICES', DeviceID, CustomerID || '|'
                     || CASE WHEN Trusted THEN 'True' ELSE 'False' END || '|'
                     || CASE WHEN right(DeviceID, 1) = '0' THEN 'iOS' ELSE 'Android' END FROM con_dev
              UNION ALL SELECT 'FRAUD_ALERTS', AlertID, CustomerID || '|' || CASE Severity
                     WHEN 'critical' THEN 'CRITICAL' WHEN 'high' THEN 'HIGH'
                     WHEN 'medium' THEN 'Medium' ELSE Severity END || '|'
                     || CASE WHEN right(AlertID, 1) = '0' THEN 'CLOSED' ELSE 'OPEN' END FROM con_ale)""",
    "conform_transactions": "SELECT * FROM con_txn",
    "conform_sessions": "SELECT * FROM con_ses",
    "conform_alerts": "SELECT * FROM con_ale",
    "latest_transactions": "SELECT * FROM lat_txn",
    "latest_risk": "SELECT * FROM lat_risk",
    "latest_devices": "SELECT * FROM con_dev",
    "quality_split_transactions": _split(
        "ver_txn", "TransactionID", "invalid key, timestamp, or amount"),
    "quality_split_risk": _split(
        "ver_risk", "TransactionID", "risk score outside 0..100 or orphan TransactionID"),
    "quality_split_merchants": _split(
        "ver_mer", "MerchantID", "missing merchant business key or name"),
    "quality_split_sessions": _split(
        "ver_ses", "SessionID", "missing key, device, customer, or valid login timestamp"),
    "quality_split_devices": _split(
        "ver_dev", "DeviceID", "missing device or customer business key"),
    "quality_split_alerts": _split(
        "ver_ale", "AlertID", "missing key/timestamp or invalid severity"),
    "json_text_events": """
        SELECT event_id, '{"k":' || k || ',"kind":"' || event_type || '"}' AS detail_text,
               props AS props_text FROM ev""",
    "with_lineage": """
        SELECT *, 'source' AS source_system, 'run-1' AS pipeline_run_id,
               DATE '2024-01-31' AS run_date FROM con_mer""",
    "source_validation": " UNION ALL ".join(
        f"SELECT 'run-1' AS pipeline_run_id, '2024-01-31' AS run_date, 'source' AS source, "
        f"'{name}' AS object, count(*) AS source_count, "
        "'source_read_and_schema' AS validation_type, "
        "CASE WHEN count(*) > 0 THEN 'PASS' ELSE 'FAIL' END AS status, "
        "CASE WHEN count(*) > 0 THEN 'readable and complete' "
        "ELSE 'no rows' END AS notes "
        f"FROM con_{step}" for name, step, _ in _ENTITIES),
    "batch_validation": _batch_checks(),
    "duplicate_keys": """
        SELECT TRANSACTION_ID, count(*) AS row_count FROM src_txn
        GROUP BY TRANSACTION_ID HAVING count(*) > 1""",
    "reconciliation": _reconciliation(),
    "audit_log_upsert": _audit(),
    "audit_log_failure": f"""
        SELECT 'run-1' AS pipeline_run_id, '2024-01-31' AS run_date, stage, 'Failed' AS status,
               CAST(rows_read AS BIGINT) AS rows_read, CAST(rows_written AS BIGINT) AS rows_written,
               'source validation failed for 1 object(s)' AS error_message
        FROM (SELECT 'pipeline' AS stage, 0 AS rows_read, 0 AS rows_written UNION ALL
              SELECT 'source_validation', {_source_total()} - (SELECT count(*) FROM con_mer), 6)""",
    "source_validation_failures": " UNION ALL ".join(
        f"SELECT 'run-1' AS pipeline_run_id, '2024-01-31' AS run_date, 'source' AS source, "
        f"'{name}' AS object, {size} AS source_count, 'source_read_and_schema' AS validation_type, "
        f"'{'FAIL' if problem else 'PASS'}' AS status, '{problem or 'readable and complete'}' AS notes"
        for name, size, problem in [
            *((name, f"(SELECT count(*) FROM con_{step})", None) for name, step, _ in _ENTITIES
              if step in ("txn", "risk", "ses")),
            ("DEVICES", "(SELECT count(*) FROM con_dev)", "columns absent: TRUSTED"),
            ("MERCHANTS", "CAST(0 AS BIGINT)", "no rows"),
            ("FRAUD_ALERTS", "CAST(0 AS BIGINT)", "OSError: no such object")]),
    "orphan_alerts": """
        SELECT AlertID, TransactionID FROM ale
        WHERE TransactionID IS NOT NULL AND TransactionID NOT IN (SELECT TransactionID FROM txn)""",
    "joined_alerts": """
        SELECT count(*) AS joined_alerts FROM con_ale a JOIN src_txn t
        ON a.TransactionID = t.TRANSACTION_ID""",
    "dim_customer": "SELECT * FROM dimcust",
    "dim_account": "SELECT * FROM dimacct",
    "dim_date": """
        SELECT FullDate, CAST(strftime(FullDate, '%Y%m%d') AS INTEGER) AS DateKey,
               CAST(year(FullDate) AS INTEGER) AS Year, CAST(month(FullDate) AS INTEGER) AS Month,
               CAST(day(FullDate) AS INTEGER) AS Day, dayname(FullDate) AS DayName
        FROM dimdate""",
    "fact_transactions":
        "SELECT * EXCLUDE (MerchantName, MerchantRiskCategory) FROM facttxn",
    "fact_sessions": "SELECT * FROM factses",
    "fact_alerts": "SELECT * FROM factale",
    "orphan_date_keys": """
        SELECT DateKey, count(*) AS row_count FROM factale
        WHERE CreatedTimestamp::DATE NOT BETWEEN
              (SELECT min(TransactionTimestamp)::DATE FROM txn)
          AND (SELECT max(TransactionTimestamp)::DATE FROM txn)
        GROUP BY DateKey""",
    "domain_watermarks": """
        SELECT 'transactions' AS domain, min(TransactionTimestamp)::DATE AS first_date,
               max(TransactionTimestamp)::DATE AS last_date FROM txn
        UNION ALL SELECT 'sessions', min(LoginTimestamp)::DATE, max(LoginTimestamp)::DATE
        FROM ses""",
    "txn_profile_30d": """
        SELECT * REPLACE (round(AverageTransactionRiskScore, 4) AS AverageTransactionRiskScore)
        FROM txn30""",
    "session_profile_30d": "SELECT * FROM ses30",
    "untrusted_devices": "SELECT * FROM untrust",
    "alerts_per_customer": "SELECT * FROM alertcnt",
    "customer_risk_profile": "SELECT * FROM prof",
    "risk_leaderboard_top25": """
        SELECT * FROM prof ORDER BY CustomerRiskScore DESC, FraudAlertCount DESC, CustomerID
        LIMIT 25""",
    "risk_band_summary": f"""
        SELECT CustomerRiskBand, count(CustomerID) AS CustomerCount,
               {_HALF_UP.format('(CAST(sum(CAST(CustomerRiskScore AS DECIMAL(18,2))) AS DOUBLE)'
                                ' / count(CustomerRiskScore))')} AS AverageCustomerRiskScore,
               CAST(sum(TotalTransactionAmount30D) AS DECIMAL(38,2)) AS TotalTransactionAmount30D,
               CAST(sum(FraudAlertCount) AS BIGINT) AS FraudAlertCount
        FROM prof GROUP BY CustomerRiskBand""",
    "alert_drillthrough": """
        SELECT a.AlertID, a.TransactionID, a.Severity, a.Status, a.CreatedTimestamp, f.Amount,
               f.RiskScore, f.RiskBand, f.MerchantName, f.MerchantRiskCategory
        FROM ale a LEFT JOIN facttxn f ON a.TransactionID = f.TransactionID
        ORDER BY a.CreatedTimestamp DESC, a.AlertID LIMIT 25""",
    "suspicious_transactions": """
        SELECT t.TransactionID, t.CustomerID, t.MerchantID, t.DeviceID, t.TransactionTimestamp,
               t.Amount, r.RiskScore, d.Trusted AS DeviceTrusted, m.MerchantRiskCategory,
               coalesce(s.FailedLoginCount, 0) AS FailedLoginCount,
               coalesce(s.GeographicAnomalyCount, 0) AS GeographicAnomalyCount,
               coalesce(a.LinkedAlertCount, 0) AS LinkedAlertCount
        FROM txn t JOIN risk r ON t.TransactionID = r.TransactionID AND r.RiskScore >= 80
        LEFT JOIN dev d ON t.DeviceID = d.DeviceID
        LEFT JOIN mer m ON t.MerchantID = m.MerchantID
        LEFT JOIN ses30 s ON t.CustomerID = s.CustomerID
        LEFT JOIN (SELECT TransactionID, count(AlertID) AS LinkedAlertCount FROM ale
                   GROUP BY TransactionID) a ON t.TransactionID = a.TransactionID""",
    "rls_filtered_profile": """
        SELECT 'branch.analyst' AS viewer, CustomerID, CustomerRiskBand, CustomerRiskScore
        FROM prof WHERE CustomerRiskBand <> 'High'
        UNION ALL SELECT 'lead.investigator', CustomerID, CustomerRiskBand, CustomerRiskScore
        FROM prof""",
    "visible_profile_counts": """
        SELECT 'branch.analyst' AS effective_user, count(*) AS visible_profiles,
               CAST(0 AS BIGINT) AS visible_high_risk_profiles
        FROM prof WHERE CustomerRiskBand <> 'High'
        UNION ALL SELECT 'lead.investigator', count(*),
               count(*) FILTER (CustomerRiskBand = 'High') FROM prof""",
    "masked_customers": """
        SELECT left(CustomerID, 5) || '******' || right(CustomerID, 2) AS CustomerID
        FROM dimcust""",
    "masked_devices": """
        SELECT DeviceID, CustomerID, left(DeviceFingerprint, 3) || '********'
               || right(DeviceFingerprint, 3) AS DeviceFingerprint FROM dev""",
    "column_allowlist_devices": """
        SELECT *, 'run-1' AS pipeline_run_id, DATE '2024-01-31' AS run_date FROM dev""",
}

ORACLE: dict[str, str] = {name: _statement(final) for name, final in _FINAL.items()}
ORACLE["secret_scan_documents"] = _scan("documents", "doc_id", "doc_id")
ORACLE["secret_scan_conversations"] = _scan(
    "conversations", "CAST(conv_id AS VARCHAR) || '/' || CAST(turn AS VARCHAR)", "label")

# What ``secret_scan_planted`` plants, by the customer's number; written down here and not
# worked out from the patterns.
_PLANTED = ("azure-storage-key", "sas-signature", "github-token", "databricks-token", "jwt", "private-key",
            "literal-secret", "literal-bearer", "live-environment-guid", "snowflake-snowsight-account-url",
            "snowflake-account-host")
_PLANTED_ROWS = (f"SELECT 'c' || CAST(c_custkey AS VARCHAR) AS label, CAST(2 AS INTEGER) AS line, "
                 f"{list(_PLANTED)}[c_custkey % 12 + 1] AS rule FROM customer WHERE c_custkey % 12 < 11")
ORACLE["secret_scan_planted"] = _PLANTED_ROWS
ORACLE["rule_table_scan"] = r"""
    SELECT DISTINCT label, line, 'mail-host-' || host AS rule FROM (
        SELECT 'd' || CAST(doc_id AS VARCHAR) AS label, CAST(i AS INTEGER) AS line,
               unnest(regexp_extract_all(parts[i], '[a-z.]+[0-9]{2}@mail([0-9]+)\.example\.com', 1)) AS host
        FROM (SELECT doc_id, regexp_split_to_array(text, '\r\n|[\n\x0b\f\r\x1c\x1d\x1e\x{85}\x{2028}\x{2029}]') AS parts
              FROM documents), unnest(generate_series(1, len(parts))) AS n(i))
    WHERE CAST(host AS INTEGER) < 1000 AND host = CAST(CAST(host AS INTEGER) AS VARCHAR)
    UNION ALL """ + f"SELECT * FROM ({_PLANTED_ROWS}) WHERE rule <> 'live-environment-guid'"
