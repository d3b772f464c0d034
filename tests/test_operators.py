import datetime as dt
import hashlib
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark import contracts as c
from tidemark.functions.risk import risk_band
from tidemark.functions.text import json_text, partial_mask, zero_padded
from tidemark.operators import consume, profile, reconcile, scan, secure, star
from tidemark.operators.conform import (
    RunInfo,
    batch_rank,
    conform,
    latest,
    latest_conformed,
    with_lineage,
)
from tidemark.operators.quality import (
    FLAG,
    duplicate_keys,
    flag_entity,
    flag_quality,
    split_quality,
)
from tidemark.operators.rule_scan import RuleError, library_rules, scan_with_rules
from tidemark.operators.upsert import DuplicateKeyError, upsert, upsert_newest
from tidemark.operators.validation import (
    ValidationError,
    raise_on_failure,
    validate_batch,
    validate_sources,
)


def source_rows(spark, source, *rows):
    """Rows given as dictionaries; columns not given are NULL."""
    columns = list(c.SOURCE_COLUMNS[source])
    schema = ", ".join(f"{name} string" for name in columns)
    return spark.createDataFrame([tuple(r.get(n) for n in columns) for r in rows], schema)


def transaction(number, **changes):
    return {"TRANSACTION_ID": f"TXN-{number:09d}", "ACCOUNT_ID": "ACCT000000001",
            "CUSTOMER_ID": "CUST-000001", "MERCHANT_ID": "MER000001",
            "TRANSACTION_TIMESTAMP": "2024-01-10T00:00:00Z", "AMOUNT": "10.00",
            "CURRENCY": "usd", "SOURCE_BATCH": "initial", **changes}


# --- conform, latest -----------------------------------------------------------

def test_names_follow_from_the_source_names():
    assert c.pascal_case("INVESTIGATOR_NOTES_JSON") == "InvestigatorNotesJSON"
    assert c.TRANSACTION_RISK.conformed_name("RISK_FACTORS_JSON") == "RiskFactors"
    assert c.SESSIONS.conformed_name("MFA_USED") == "MfaUsed"
    assert [e.key for e in c.ENTITIES] == [
        "TransactionID", "TransactionID", "MerchantID", "SessionID", "DeviceID", "AlertID"]


def test_malformed_text_becomes_null_and_is_quarantined(spark):
    raw = source_rows(
        spark, "TRANSACTIONS", transaction(1),
        transaction(2, TRANSACTION_TIMESTAMP="soon"), transaction(3, AMOUNT="ten"),
        transaction(4, AMOUNT="-0.01"), transaction(5, CUSTOMER_ID=None),
        transaction(6, TRANSACTION_ID="TXN-1"), transaction(7, CARD_PRESENT="maybe"),
        transaction(8, TRANSACTION_ID=None))
    verdicts = {r["TransactionID"]: (r[FLAG], r["failed_rules"]) for r in flag_entity(
        raw, c.TRANSACTIONS, detail=True).collect()}
    assert verdicts == {
        "TXN-000000001": (True, []), "TXN-000000002": (False, ["timestamp"]),
        "TXN-000000003": (False, ["amount"]), "TXN-000000004": (False, ["amount"]),
        "TXN-000000005": (False, ["customer"]), "TXN-1": (False, ["key"]),
        "TXN-000000007": (True, []), None: (False, ["key"])}


def test_generator_spellings_are_read(spark):
    row = conform(source_rows(spark, "TRANSACTIONS", transaction(
        1, CARD_PRESENT="True", AMOUNT="12.345")), c.TRANSACTIONS).first()
    assert row["CardPresent"] is True
    assert row["Amount"] == Decimal("12.35")
    assert row["Currency"] == "USD"
    assert row["TransactionTimestamp"].replace(tzinfo=None) == dt.datetime(2024, 1, 10)


def test_keys_are_trimmed_before_they_are_deduplicated(spark):
    raw = source_rows(spark, "TRANSACTIONS", transaction(1, AMOUNT="1.00"),
                      transaction(1, TRANSACTION_ID="TXN-000000001 ", AMOUNT="2.00",
                                  TRANSACTION_TIMESTAMP="2024-01-11T00:00:00Z"))
    rows = latest_conformed(raw, c.TRANSACTIONS).collect()
    assert [(r["TransactionID"], r["Amount"]) for r in rows] == [
        ("TXN-000000001", Decimal("2.00"))]


def test_newest_row_wins_nulls_are_oldest_and_ties_are_stable(spark):
    rows = [(1, "2024-01-01", "a"), (1, None, "z"), (2, None, "x"), (3, "2024-01-01", "b"),
            (3, "2024-01-01", "c")]
    df = spark.createDataFrame(rows, "k int, t string, v string")
    for parts in (1, 3, 7):
        kept = latest(df.repartition(parts), ["k"], ["t"]).collect()
        assert sorted((r.k, r.v) for r in kept) == [(1, "a"), (2, "x"), (3, "c")]
    kept = latest(df, ["k"], ["t"], keep_partitioning=True).collect()
    assert sorted((r.k, r.v) for r in kept) == [(1, "a"), (2, "x"), (3, "c")]


def test_newer_batch_wins_for_merchants(spark):
    def row(batch, name):
        return {"MERCHANT_ID": "MER000001", "MERCHANT_NAME": name, "SOURCE_BATCH": batch}
    raw = source_rows(spark, "MERCHANTS", row("initial", "old"), row("incremental", "new"),
                      row("zzz", "unknown"))
    assert latest_conformed(raw, c.MERCHANTS).first()["MerchantName"] == "new"
    ranks = raw.select(batch_rank("SOURCE_BATCH").alias("r")).collect()
    assert [r.r for r in ranks] == [1, 2, 0]


def test_lineage(spark):
    row = with_lineage(spark.range(1), RunInfo("r", "2024-02-29"), "src").first()
    assert (row.source_system, row.pipeline_run_id, row.run_date) == (
        "src", "r", dt.date(2024, 2, 29))
    assert row.silver_loaded_at is not None
    today = with_lineage(spark.range(1), RunInfo("r"), "src").select(
        (F.col("run_date") == F.current_date()).alias("t")).first()
    assert today.t


def test_json_text_leaves_strings_alone(spark):
    df = spark.range(1).select(F.lit("x").alias("s"), F.array(F.lit(1)).alias("a"))
    row = df.select(json_text(df, "s").alias("s"), json_text(df, "a").alias("a")).first()
    assert (row.s, row.a) == ("x", "[1]")


# --- quality ---------------------------------------------------------------------

def test_split_is_exhaustive_and_disjoint(spark):
    df = spark.createDataFrame([(1, 5.0), (2, None), (3, float("nan")), (4, 100.0), (5, 101.0)],
                               "k int, score double")
    good, bad = split_quality(df, {"score": "score BETWEEN 0 AND 100"}, "why")
    assert sorted(r.k for r in good.collect()) == [1, 4]
    assert sorted((r.k, r.quarantine_reason) for r in bad.collect()) == [
        (2, "why"), (3, "why"), (5, "why")]
    assert good.columns == ["k", "score"]


def test_a_score_of_a_quarantined_transaction_is_quarantined(spark):
    parent = spark.createDataFrame([("TXN-000000001",)], "TransactionID string")
    raw = source_rows(spark, "TRANSACTION_RISK",
                      {"TRANSACTION_ID": "TXN-000000001", "RISK_SCORE": "50"},
                      {"TRANSACTION_ID": "TXN-000000002", "RISK_SCORE": "50"},
                      {"TRANSACTION_ID": None, "RISK_SCORE": "50"})
    flags = {r["TransactionID"]: r[FLAG] for r in flag_entity(
        raw, c.TRANSACTION_RISK, parent).collect()}
    assert flags == {"TXN-000000001": True, "TXN-000000002": False, None: False}
    with pytest.raises(ValueError):
        flag_entity(raw, c.TRANSACTION_RISK)


def test_null_severity_is_invalid(spark):
    base = {"CUSTOMER_ID": "CUST-000001", "CREATED_TIMESTAMP": "2024-01-01T00:00:00Z"}
    raw = source_rows(spark, "FRAUD_ALERTS", {"ALERT_ID": "a", "SEVERITY": "HIGH", **base},
                      {"ALERT_ID": "b", **base}, {"ALERT_ID": "c", "SEVERITY": "odd", **base})
    flags = {r["AlertID"]: r[FLAG] for r in flag_entity(raw, c.ALERTS).collect()}
    assert flags == {"a": True, "b": False, "c": False}


def test_duplicate_keys(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "k int")
    assert sorted((str(r.k), r.row_count) for r in duplicate_keys(df, ["k"]).collect()) == [
        ("1", 2), ("None", 2)]


# --- validation --------------------------------------------------------------------

def test_source_validation_reports_every_kind_of_failure(spark):
    good = source_rows(spark, "MERCHANTS", {"MERCHANT_ID": "m"})
    loaders = {
        "MERCHANTS": lambda: good,
        "DEVICES": lambda: good,
        "TRANSACTIONS": lambda: source_rows(spark, "TRANSACTIONS").filter(F.lit(False)),
        "FRAUD_ALERTS": lambda: spark.read.parquet("/nowhere"),
    }
    results = validate_sources(spark, loaders, RunInfo("r"))
    found = {r.object: (r.status, r.source_count, r.notes) for r in results.collect()}
    assert found["MERCHANTS"] == ("PASS", 1, "readable and complete")
    assert found["DEVICES"][0] == "FAIL" and "DEVICE_ID" in found["DEVICES"][2]
    assert found["TRANSACTIONS"][:2] == ("FAIL", 0)
    assert "AnalysisException" in found["FRAUD_ALERTS"][2]
    assert len(found) == 6
    with pytest.raises(ValidationError, match="5 object"):
        raise_on_failure(results, "source validation")


def test_batch_validation_counts_each_kind_of_failure(spark):
    tables = {
        "TRANSACTIONS": source_rows(
            spark, "TRANSACTIONS", transaction(1), transaction(1), transaction(2, MERCHANT_ID="M")),
        "TRANSACTION_RISK": source_rows(spark, "TRANSACTION_RISK",
                                        {"TRANSACTION_ID": "TXN-000000009"}),
        "MERCHANTS": source_rows(spark, "MERCHANTS", {"MERCHANT_ID": "MER000001"}),
    }
    expected = spark.createDataFrame(
        [("TRANSACTIONS", 3), ("TRANSACTION_RISK", 2), ("MERCHANTS", 1), ("DEVICES", 4)],
        "object string, expected bigint")
    found = {(r["check"], r["object"]): r["failures"]
             for r in validate_batch(tables, expected).collect() if r["failures"]}
    assert found == {
        ("duplicate_key", "TRANSACTIONS"): 1, ("pattern:MERCHANT_ID", "TRANSACTIONS"): 1,
        ("row_count", "TRANSACTION_RISK"): 1, ("row_count", "DEVICES"): 4,
        ("orphan:TRANSACTION_ID", "TRANSACTION_RISK"): 1, ("orphan:MERCHANT_ID", "TRANSACTIONS"): 1}
    later = validate_batch(tables, expected, first_batch=False)
    assert later.filter(F.col("check").startswith("orphan")).count() == 0


# --- upsert -------------------------------------------------------------------------

def test_upsert_replaces_adds_and_rejects_duplicate_changes(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    changes = spark.createDataFrame([("B", 2), ("C", 3)], "v string, k int")
    result = upsert(target, changes, ["k"])
    assert sorted(tuple(r) for r in result.collect()) == [(1, "a"), (2, "B"), (3, "C")]
    assert sorted(tuple(r) for r in upsert(result, changes, ["k"]).collect()) == [
        (1, "a"), (2, "B"), (3, "C")]
    with pytest.raises(DuplicateKeyError):
        upsert(target, changes.unionByName(changes), ["k"])
    with pytest.raises(ValueError):
        upsert(target, changes.withColumn("x", F.lit(1)), ["k"])


def test_newest_policy_ignores_late_rows(spark):
    target = spark.createDataFrame([(1, 5, "new")], "k int, t int, v string")
    changes = spark.createDataFrame([(1, 3, "late"), (2, 1, "add")], "k int, t int, v string")
    rows = upsert_newest(target, changes, ["k"], ["t"]).collect()
    assert sorted((r.k, r.v) for r in rows) == [(1, "new"), (2, "add")]


# --- gold ----------------------------------------------------------------------------

def silver(spark, transactions=(), risk=(), sessions=(), devices=(), alerts=(), merchants=()):
    def table(entity, rows):
        return conform(source_rows(spark, entity.source, *rows), entity)
    return {"transactions": table(c.TRANSACTIONS, transactions),
            "transaction_risk": table(c.TRANSACTION_RISK, risk),
            "sessions": table(c.SESSIONS, sessions), "devices": table(c.DEVICES, devices),
            "fraud_alerts": table(c.ALERTS, alerts), "merchants": table(c.MERCHANTS, merchants)}


def session(number, customer="CUST-000001", at="2024-01-30T10:00:00Z", **changes):
    return {"SESSION_ID": f"S{number}", "CUSTOMER_ID": customer, "DEVICE_ID": "D",
            "LOGIN_TIMESTAMP": at, "FAILED_ATTEMPTS": "0", "COUNTRY": "US", **changes}


def test_score_reaches_exactly_its_maximum(spark):
    tables = silver(
        spark, [transaction(1)], [{"TRANSACTION_ID": "TXN-000000001", "RISK_SCORE": "100"}],
        [session(n, FAILED_ATTEMPTS="9", COUNTRY="GB") for n in range(5)],
        [{"DEVICE_ID": f"D{n}", "CUSTOMER_ID": "CUST-000001", "TRUSTED": "False"}
         for n in range(5)],
        [{"ALERT_ID": f"A{n}", "CUSTOMER_ID": "CUST-000001",
          "CREATED_TIMESTAMP": "2020-01-01T00:00:00Z", "SEVERITY": "low"} for n in range(5)])
    row = profile.customer_risk_profile(tables).first()
    assert (row.CustomerRiskScore, row.CustomerRiskBand) == (100.0, "High")
    assert row.TotalTransactionAmount30D == Decimal("10.00")


def test_customer_without_activity_scores_zero(spark):
    tables = silver(spark, devices=[{"DEVICE_ID": "D", "CUSTOMER_ID": "CUST-000009"}])
    row = profile.customer_risk_profile(tables).first()
    assert row.CustomerRiskScore == 0 and row.CustomerRiskBand == "Low"
    assert row.UntrustedDeviceCount == 0 and row.TransactionCount30D == 0


def test_window_edges_and_independent_domains(spark):
    tables = silver(
        spark,
        [transaction(1, TRANSACTION_TIMESTAMP="2024-01-30T23:59:59Z"),
         transaction(2, TRANSACTION_TIMESTAMP="2024-01-01T00:00:00Z"),
         transaction(3, TRANSACTION_TIMESTAMP="2023-12-31T23:59:59Z")],
        sessions=[session(1, at="2020-06-30T00:00:00Z", FAILED_ATTEMPTS="1"),
                  session(2, at="2020-06-01T00:00:00Z", FAILED_ATTEMPTS="1"),
                  session(3, at="2020-05-31T23:00:00Z", FAILED_ATTEMPTS="1")])
    dates = profile.as_of(tables)
    assert (dates.transactions, dates.sessions) == (dt.date(2024, 1, 30), dt.date(2020, 6, 30))
    row = profile.customer_risk_profile(tables, dates).first()
    assert (row.TransactionCount30D, row.FailedLoginCount) == (2, 2)


def test_unknown_country_and_trust_count_as_no_anomaly(spark):
    tables = silver(spark, sessions=[session(1, COUNTRY=None), session(2, COUNTRY="GB")],
                    devices=[{"DEVICE_ID": "D", "CUSTOMER_ID": "CUST-000001", "TRUSTED": None}])
    row = profile.customer_risk_profile(tables).first()
    assert (row.GeographicAnomalyCount, row.UntrustedDeviceCount) == (1, 0)


def test_average_is_the_same_for_every_partitioning(spark):
    scores = [(float(i % 977) / 7,) for i in range(5000)]
    df = spark.createDataFrame(scores, "s double")
    results = {df.repartition(n).agg(profile.exact_average("s").alias("a")).first().a
               for n in (1, 2, 5, 13)}
    assert len(results) == 1
    assert abs(results.pop() - sum(s for s, in scores) / 5000) < 1e-9


def test_empty_silver_gives_empty_gold(spark):
    tables = silver(spark)
    assert star.dim_date(tables).count() == 0
    assert profile.customer_risk_profile(tables).count() == 0
    assert star.fact_transactions(tables).count() == 0


def test_date_dimension_and_its_wider_range(spark):
    tables = silver(spark, [transaction(1, TRANSACTION_TIMESTAMP="2024-02-28T05:00:00Z")],
                    sessions=[session(1, at="2024-03-01T00:00:00Z")],
                    alerts=[{"ALERT_ID": "a", "CUSTOMER_ID": "x", "SEVERITY": "low",
                             "CREATED_TIMESTAMP": "2024-02-26T00:00:00Z"}])
    days = star.dim_date(tables).orderBy("DateKey").collect()
    assert [(d.DateKey, d.DayName) for d in days] == [
        (20240228, "Wednesday"), (20240229, "Thursday"), (20240301, "Friday")]
    alerts = star.fact_alerts(tables)
    assert [r.DateKey for r in star.orphan_date_keys(alerts, star.dim_date(tables)).collect()] \
        == [20240226]
    wide = star.dim_date(tables, tables["fraud_alerts"].select(
        F.col("CreatedTimestamp").alias("d")))
    assert wide.count() == 5
    assert star.orphan_date_keys(alerts, wide).count() == 0


def test_fact_keys_resolve_in_their_dimensions(spark):
    tables = silver(
        spark,
        [transaction(1), transaction(2, MERCHANT_ID="MER000404"), transaction(3, ACCOUNT_ID=None)],
        merchants=[{"MERCHANT_ID": "MER000001", "MERCHANT_NAME": "m"}])
    fact = star.fact_transactions(tables)
    assert sorted((r.TransactionID, r.MerchantSK is None) for r in fact.collect()) == [
        ("TXN-000000001", False), ("TXN-000000002", True)]
    for dimension, key in ((star.dim_customer(tables), "CustomerSK"),
                           (star.dim_account(tables), "AccountSK")):
        assert fact.join(dimension, key, "left_anti").count() == 0
    kept = star.fact_transactions(tables, keep_unknown_accounts=True)
    assert kept.filter(F.col("AccountSK").isNull()).count() == 1
    assert reconcile.unresolved_accounts(tables["transactions"]).first()[0] == 1
    inner = star.lookup_key(tables["transactions"], star.dim_merchant(tables), "MerchantID",
                            "MerchantSK", "inner")
    assert inner.count() == 2


def test_shared_account_belongs_to_the_lowest_customer(spark):
    tables = silver(spark, [transaction(1, CUSTOMER_ID="CUST-000002"),
                            transaction(2, CUSTOMER_ID="CUST-000001")])
    rows = star.dim_account(tables).collect()
    assert [r.CustomerID for r in rows] == ["CUST-000001"]


def test_dimension_keys_are_unique(spark):
    tables = silver(spark, [transaction(n, CUSTOMER_ID=f"CUST-{n:06d}") for n in range(200)])
    rows = star.dim_customer(tables)
    assert rows.select("CustomerSK").distinct().count() == rows.count() == 200


# --- reports ------------------------------------------------------------------------

def test_leaderboard_order_and_limit(spark):
    columns = ", ".join(f"{name} {kind}" for name, kind in {
        **{name: "double" for name in consume.LEADERBOARD_COLUMNS},
        "CustomerID": "string", "CustomerRiskBand": "string"}.items())
    rows = [tuple(f"c{i:02d}" if n == "CustomerID" else "Low" if n == "CustomerRiskBand"
                  else float(i % 2) if n == "CustomerRiskScore" else 0.0
                  for n in consume.LEADERBOARD_COLUMNS) for i in range(40)]
    top = consume.risk_leaderboard(spark.createDataFrame(rows, columns), 25).collect()
    assert len(top) == 25
    assert [r.CustomerID for r in top[:3]] == ["c01", "c03", "c05"]
    assert top[20].CustomerID == "c00"


def test_bands(spark):
    df = spark.createDataFrame([(79.99,), (80.0,), (45.0,), (44.99,)], "s double")
    assert [r.b for r in df.select(risk_band(F.col("s")).alias("b")).collect()] == [
        "Medium", "High", "Medium", "Low"]


# --- security -------------------------------------------------------------------------

def test_row_filter_hides_high_and_unbanded_profiles(spark):
    rows = spark.createDataFrame([("a", "High"), ("b", "Low"), ("c", None)],
                                 "CustomerID string, CustomerRiskBand string")
    listed = spark.createDataFrame([("ann",)], "PrincipalName string")

    def seen(user):
        return sorted(r.CustomerID for r in secure.visible_profiles(rows, listed, user).collect())

    assert seen("bob") == ["b"]
    assert seen("ann") == ["a", "b", "c"]
    assert seen(None) == ["b"]
    bob = secure.visible_profile_counts(secure.visible_profiles(rows, listed, "bob"), "bob")
    assert tuple(bob.first()) == ("bob", 1, 0)
    twice = secure.add_investigator(secure.add_investigator(listed, "bob"), "bob")
    assert sorted(r[0] for r in twice.collect()) == ["ann", "bob"]
    for unset in (" ", "$(PRINCIPAL)"):
        with pytest.raises(ValueError):
            secure.add_investigator(listed, unset)


def test_masks(spark):
    df = spark.createDataFrame([("CUST-000042",), ("short",), (None,)], "v string")
    masked = [r.m for r in df.select(
        partial_mask(F.col("v"), 5, "******", 2).alias("m")).collect()]
    assert masked == ["CUST-******42", "******", None]


def test_allow_list_keeps_its_order_and_drops_the_rest(spark):
    df = spark.createDataFrame([(1, 2, 3)], "Secret int, CustomerID int, DeviceID int")
    assert secure.allowed_columns(df).columns == ["DeviceID", "CustomerID"]


# --- text -------------------------------------------------------------------------------

def findings(spark, text, **options):
    df = spark.createDataFrame([("f", text)], "label string, text string")
    return sorted((r.line, r.rule) for r in scan.scan_text(df, "label", "text", **options).collect())


def test_scanner_finds_what_it_should(spark):
    text = "\n".join([
        "-----BEGIN " + "ENCRYPTED PRIVATE KEY-----",
        "github_" + "pat_" + "a" * 30,
        "-".join(("12345678", "1234", "4123", "8123", "123456789abc")),
        "https://app." + "snowflake.com/example-org/example-account/",
        "example-org-example-account.privatelink." + "snowflakecomputing.com",
        "AccountKey=" + "A" * 40 + "==", "sig=" + "b" * 20, "dapi" + "0" * 20,
        "eyJ" + "a" * 12 + "." + "b" * 12 + "." + "c" * 8,
        "Password = '" + "hunter22x" + "'", 'authorization: "bearer ' + "t" * 16,
        'token = "' + "0f" * 20 + '"', "nothing here",
    ])
    assert findings(spark, text, extra_rules=scan.HEX_TOKEN_RULE) == [
        (1, "private-key"), (2, "github-token"), (3, "live-environment-guid"),
        (4, "snowflake-snowsight-account-url"), (5, "snowflake-account-host"),
        (6, "azure-storage-key"), (7, "sas-signature"), (8, "databricks-token"), (9, "jwt"),
        (10, "literal-secret"), (11, "literal-bearer"), (12, "hex-token")]


def test_scanner_keeps_to_lines_and_known_literals(spark):
    assert findings(spark, "password = \n'longenough'") == []
    assert findings(spark, "acme-demo.snowflakecomputing.com") == []
    assert findings(spark, "a\r\nb\x0bc sig=" + "x" * 20) == [(4, "sas-signature")]
    assert findings(spark, "xsig=" + "x" * 20) == []
    long_text = "word " * 200_000 + "\n" + "dapi" + "a" * 20
    assert findings(spark, long_text) == [(2, "databricks-token")]


def test_every_required_word_is_in_its_matches():
    assert set(scan.REQUIRED_WORDS) <= set(scan.SECRET_RULES) | set(scan.HEX_TOKEN_RULE)
    assert "live-environment-guid" not in scan.REQUIRED_WORDS


def test_findings_as_text(spark):
    df = spark.createDataFrame([("a.txt", 3, "jwt")], "label string, line int, rule string")
    assert scan.format_findings(df, "label").first()[0] == "a.txt:3: jwt"


def test_padding_never_truncates(spark):
    df = spark.createDataFrame([(7,), (1234567,)], "n bigint")
    assert [r.p for r in df.select(zero_padded(F.col("n"), 6).alias("p")).collect()] == [
        "000007", "1234567"]


def test_flagging_keeps_every_row(spark):
    df = spark.range(100)
    flagged = flag_quality(df, {"even": "id % 2 = 0", "null": F.lit(None).cast("boolean")}, "r")
    assert flagged.count() == 100
    assert flagged.filter(F.col(FLAG)).count() == 0


def test_rows_without_a_key_are_all_quarantined(spark):
    raw = source_rows(spark, "TRANSACTIONS", transaction(1), *(
        transaction(2, TRANSACTION_ID=None) for _ in range(5)))
    flagged = flag_entity(raw, c.TRANSACTIONS)
    assert flagged.filter(FLAG).count() == 1
    assert flagged.filter(~F.col(FLAG)).count() == 5


def test_wide_identifiers_are_valid(spark):
    raw = source_rows(spark, "TRANSACTIONS", transaction(1, TRANSACTION_ID="TXN-123456789012"))
    assert flag_entity(raw, c.TRANSACTIONS).filter(FLAG).count() == 1


def test_anchored_rules_of_a_caller_see_every_line(spark):
    rules = {"begin": "^BEGIN", "end": "here$"}
    assert findings(spark, "first\nBEGIN\nit is here\nlast", extra_rules=rules) == [(2, "begin"), (3, "end")]


def test_a_callers_rule_may_reuse_a_name(spark):
    df = spark.createDataFrame([("a", "mykey = ABC123")], "name string, text string")
    assert [r.rule for r in scan.scan_text(df, "name", "text", extra_rules={"jwt": "mykey = [A-Z0-9]+"}).collect()] == ["jwt"]


def test_rule_tables_find_what_single_rules_find(spark):
    texts = [("a", "x\nAccountKey=" + "k" * 40 + "\r\nghp_" + "a" * 30), ("b", None), ("c", ""), ("d", "İİ dapi" + "0" * 30 + "\u2028DAPI" + "f" * 24),
             ("e", "acme-demo.snowflakecomputing.com and real.snowflakecomputing.com"), ("f", "ghp_short\n" * 50)]
    df = spark.createDataFrame(texts, "name string, text string")
    rules = library_rules(spark)
    found = sorted(map(tuple, scan_with_rules(df, "name", "text", rules).collect()))
    assert found == sorted(map(tuple, scan.scan_text(df, "name", "text").collect())) and len(found) == 5
    more = spark.range(3000).selectExpr("'r' || id as rule", "'none' || id as pattern", "array('none' || id) as words")
    assert sorted(map(tuple, scan_with_rules(df, "name", "text", rules.union(more)).collect())) == found
    assert scan_with_rules(df, "name", "text", rules.limit(0)).count() == 0


@pytest.mark.parametrize("rule", [("x", "x", []), ("x", "x", None), ("jwt", "x", ["x"]), ("x", "x" * 2500, ["x"])])
def test_rule_tables_that_cannot_be_held_are_refused(spark, rule):
    rules = library_rules(spark).union(spark.createDataFrame([rule], "rule string, pattern string, words array<string>"))
    df = spark.createDataFrame([("a", "x")], "name string, text string")
    with pytest.raises(RuleError):
        scan_with_rules(df, "name", "text", rules, most_rule_bytes=2500)
