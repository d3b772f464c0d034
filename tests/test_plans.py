"""Plans and hot keys: what must hold when the data grows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.contracts import TRANSACTIONS
from tidemark.operators import profile, reconcile, secure, star
from tidemark.operators.conform import latest
from tidemark.operators.quality import flag_entity
from tidemark.operators.scan import scan_text
from tidemark.session import materialise
from tidemark.sources import fixtures
from tests.conftest import DATA

FOLDER = f"{DATA}/sf0.001"


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def count(plan, node):
    return sum(line.lstrip(" :+-*()0123456789").startswith(node) for line in plan.splitlines())


@pytest.fixture
def small_broadcasts_off(spark):
    """Plans as they are for sides too large to broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_copies_of_a_key_are_dropped_before_the_shuffle(spark):
    rows = spark.range(90_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").alias("t"))
    df = latest(materialise(rows.repartition(6), "hot"), ["k"], ["t"])
    plan = physical(df)
    before_shuffle = plan[plan.index("Exchange"):]
    assert "WindowGroupLimit" in before_shuffle
    result = df.filter("k = 'hot'").collect()
    assert [r.t for r in result] == [89_997]
    assert df.count() == 60_001


def test_risk_rows_are_shuffled_once_before_their_parent_join(spark, small_broadcasts_off):
    from tidemark.contracts import TRANSACTION_RISK
    parent = materialise(spark.createDataFrame([("x",)], "TransactionID string"), "parent")
    raw = materialise(fixtures.transaction_risk(spark, FOLDER), "risk")
    plan = physical(flag_entity(raw, TRANSACTION_RISK, parent))
    assert count(plan, "Exchange") == 2  # the risk rows once, the parent's ids once


def test_quality_flags_need_no_shuffle_of_their_own(spark):
    raw = materialise(fixtures.transactions(spark, FOLDER), "raw")
    assert count(physical(flag_entity(raw, TRANSACTIONS)), "Exchange") == 1


def silver(spark):
    tables = {}
    for name in ("transactions", "transaction_risk", "sessions", "devices", "fraud_alerts",
                 "merchants"):
        tables[name] = materialise(_valid(spark, name, tables), f"plan-{name}")
    return tables


def _valid(spark, name, tables):
    from tidemark.contracts import BY_TABLE
    from tidemark.operators.quality import valid_rows
    entity = BY_TABLE[name]
    parent = tables[entity.parent[0]] if entity.parent else None
    return valid_rows(flag_entity(fixtures.BUILDERS[entity.source](spark, FOLDER), entity, parent))


def test_window_filter_reaches_the_scan(spark):
    tables = silver(spark)
    recent = tables["sessions"].filter(
        profile.within_window("LoginTimestamp", dt.date(2024, 1, 30)))
    text = spark._jvm.PythonSQLUtils.explainString(recent._jdf.queryExecution(), "formatted")
    assert "PushedFilters" in text
    assert "GreaterThanOrEqual(LoginTimestamp" in text
    assert "LessThan(LoginTimestamp" in text


def test_facts_look_up_only_what_can_be_missing(spark, small_broadcasts_off):
    tables = silver(spark)
    plan = physical(star.fact_transactions(tables))
    assert count(plan, "SortMergeJoin") == 2  # the score and the merchant
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert count(physical(star.fact_alerts(tables)), "Exchange") == 0
    columns = physical(star.fact_alerts(tables))
    assert "InvestigatorNotesJSON" not in columns


def test_profile_joins_reuse_the_customer_partitioning(spark, small_broadcasts_off):
    tables = silver(spark)
    dates = profile.as_of(tables)
    plan = physical(profile.customer_risk_profile(tables, dates))
    # customers; recent transactions, scores and their profile; devices per
    # customer (twice, for the distinct count); trust; alerts
    assert count(plan, "Exchange") == 8
    assert count(plan, "SortMergeJoin") == 5
    assert "NestedLoop" not in plan


def test_reader_check_is_evaluated_once_and_filters_pass_through(spark):
    rows = materialise(spark.createDataFrame(
        [("a", "High"), ("b", "Low")], "CustomerID string, CustomerRiskBand string"), "profile")
    listed = spark.createDataFrame([("ann",)], "PrincipalName string")
    seen = secure.visible_profiles(rows, listed, "bob").filter("CustomerID = 'b'")
    text = seen._jdf.queryExecution().toString()
    assert "EqualTo(CustomerID,b)" in text
    assert "ExistenceJoin" not in text


def test_scan_neither_joins_nor_shuffles(spark):
    plan = physical(scan_text(fixtures.table(spark, FOLDER, "documents"), "doc_id", "text"))
    assert "Exchange" not in plan and "Join" not in plan
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan


def test_joined_alerts_with_a_hot_transaction(spark):
    ids = F.when(F.col("id") < 1000, "hot").otherwise(F.col("id").cast("string"))
    alerts = spark.range(3000).select(ids.alias("TRANSACTION_ID"))
    transactions = spark.range(3000).select(ids.alias("TRANSACTION_ID"))
    df = reconcile.joined_alert_count(alerts, transactions)
    assert df.first()[0] == 1000 * 1000 + 2000
    assert "HashAggregate" in physical(df)


def test_a_hot_customer_and_a_hot_merchant_give_whole_results(spark):
    n = 30_000
    base = spark.range(n).select(
        F.concat(F.lit("TXN-"), F.lpad(F.col("id").cast("string"), 9, "0")).alias("TransactionID"),
        F.when(F.col("id") % 3 == 0, "C-hot").otherwise(
            F.concat(F.lit("C"), F.col("id").cast("string"))).alias("CustomerID"),
        F.lit("A").alias("AccountID"),
        F.when(F.col("id") % 3 == 1, "M-hot").when(F.col("id") % 3 == 0, None)
        .otherwise("M2").alias("MerchantID"),
        F.lit("D").alias("DeviceID"), F.lit("2024-01-30").cast("timestamp")
        .alias("TransactionTimestamp"), F.lit(1).cast("decimal(18,2)").alias("Amount"),
        F.lit("USD").alias("Currency"), F.lit("Web").alias("Channel"),
        F.lit("ok").alias("TransactionStatus"))
    risk = base.select("TransactionID", F.lit(10.0).alias("RiskScore"),
                       F.lit("Low").alias("RiskBand"))
    merchants = spark.createDataFrame([("M-hot", "hot")], "MerchantID string, MerchantName string")
    tables = {"transactions": base, "transaction_risk": risk, "merchants": merchants}
    fact = star.fact_transactions(tables)
    assert fact.count() == n
    assert fact.filter(F.col("MerchantSK").isNotNull()).count() == n // 3
    per_customer = profile.transaction_profile(tables, dt.date(2024, 1, 30))
    hot = per_customer.filter("CustomerID = 'C-hot'").first()
    assert hot.TransactionCount30D == n // 3
    assert star.dim_account(tables).count() == 1


def test_bucketed_silver_joins_without_moving_either_side(spark, store, small_broadcasts_off):
    from tidemark.plans.medallion import Settings, build_silver, silver_tables
    raw = {name: materialise(build(spark, FOLDER), "raw")
           for name, build in fixtures.BUILDERS.items()}
    settings = Settings(buckets=8)
    written = build_silver(store, raw, settings)
    tables = silver_tables(store)
    joined = tables["transactions"].join(
        tables["transaction_risk"].select("TransactionID", "RiskScore"), "TransactionID", "left")
    assert count(physical(joined), "Exchange") == 0
    assert joined.count() == 4466
    assert count(physical(star.fact_transactions(tables)), "Exchange") == 2  # the merchants' join
    files = [f for f in tables["transactions"].inputFiles()]
    assert len(files) <= 8
    # the same rows as without buckets
    build_silver(store, raw, Settings())
    again = silver_tables(store)
    assert sum(t.count() for t in again.values()) == written
    assert again["transaction_risk"].exceptAll(
        store.spark.createDataFrame(joined.collect(), joined.schema).select("TransactionID")
        .join(again["transaction_risk"], "TransactionID").select(
            *again["transaction_risk"].columns)).isEmpty()


def test_bucketed_silver_quarantines_rows_without_a_key(spark, store):
    from tidemark.contracts import BY_TABLE
    from tidemark.plans.medallion import Settings, build_silver
    raw = {name: materialise(build(spark, FOLDER), "raw")
           for name, build in fixtures.BUILDERS.items()}
    shared = [BY_TABLE["transactions"], BY_TABLE["transaction_risk"]]
    for entity in shared:
        rows = raw[entity.source]
        raw[entity.source] = rows.unionByName(rows.limit(5).withColumn("TRANSACTION_ID", F.lit(None).cast("string")))
    found = []
    for buckets in (0, 8):
        build_silver(store, raw, Settings(buckets=buckets))
        found.append([(
            store.read("silver", e.table).count(), store.read("silver", e.quarantine).count(),
            store.read("silver", e.quarantine).filter(F.col(e.key).isNull()).count()) for e in shared])
    assert found[1] == found[0]
    assert all(unkeyed >= 5 for _, _, unkeyed in found[1])


@pytest.fixture
def small_data_counts_as_skewed(spark, small_broadcasts_off):
    changed = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    }
    before = {name: spark.conf.get(name, None) for name in changed}
    for name, value in changed.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        if value is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, value)


def test_a_hot_merchant_is_split_over_tasks(spark, small_data_counts_as_skewed):
    n = 60_000
    fact = materialise(spark.range(n).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").otherwise(
            F.concat(F.lit("M"), F.col("id").cast("string"))).alias("MerchantID"))
        .repartition(6), "fact")
    merchants = materialise(spark.range(n).select(
        F.when(F.col("id") == 0, "hot").otherwise(
            F.concat(F.lit("M"), F.col("id").cast("string"))).alias("MerchantID"),
        F.col("id").alias("MerchantSK")), "merchants")
    joined = star.lookup_key(fact, merchants, "MerchantID", "MerchantSK")
    assert len(joined.collect()) == n
    assert "SortMergeJoin(skew=true)" in physical(joined)


def test_partitioned_writes_are_rebalanced(spark):
    df = spark.range(100).withColumn("d", F.col("id") % 3)
    assert "REBALANCE_PARTITIONS_BY_COL" in physical(df.hint("rebalance", F.col("d")))


@pytest.mark.parametrize("buckets", [0, 8])
def test_silver_files_are_sorted_by_event_time(spark, store, buckets):
    import pyarrow.parquet as pq
    from tidemark.plans.medallion import Settings, build_silver
    raw = {name: materialise(build(spark, FOLDER), "raw")
           for name, build in fixtures.BUILDERS.items()}
    build_silver(store, raw, Settings(buckets=buckets))
    for file in store.read("silver", "transactions").inputFiles():
        times = pq.read_table(file.removeprefix("file://"), columns=["TransactionTimestamp"])
        values = times.column(0).to_pylist()
        assert values == sorted(values)


def test_a_date_range_skips_most_of_the_sorted_files(spark, store):
    from tidemark.contracts import TRANSACTIONS
    from tidemark.plans.medallion import Settings, build_silver
    raw = {"TRANSACTIONS": fixtures.transactions(spark, f"{DATA}/sf0.01")}
    total = build_silver(store, raw, Settings(), [TRANSACTIONS])
    tables = {"transactions": store.read("silver", "transactions")}
    last = tables["transactions"].agg(F.to_date(F.max("TransactionTimestamp"))).first()[0]
    recent = tables["transactions"].filter(
        profile.within_window("TransactionTimestamp", last)).select("CustomerID")
    assert len(recent.collect()) == 701
    scan = recent._jdf.queryExecution().executedPlan().collectLeaves().head()
    assert total == 44_816
    assert scan.metrics().get("numOutputRows").get().value() < 0.6 * total


def test_ranges_of_time_are_in_few_files(spark, store):
    before = {c: spark.conf.get(c, None) for c in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        rows = spark.range(200_000).select(
            F.col("id"), (F.col("id") % 20 > 0).alias("is_valid"),
            F.expr("timestamp '2024-01-01' + make_dt_interval(cast(pmod(xxhash64(id), 300) as int))").alias("t"))
        held = {}
        for cluster in (False, True):
            location = store.stage_flagged(rows.repartition(30), "silver", f"t{cluster}", sort_by="t", by_range=cluster)
            valid = spark.read.parquet(store.half(location, True))
            recent = valid.filter("t >= timestamp '2024-10-01'").select(F.input_file_name().alias("f"))
            held[cluster] = (recent.distinct().count(), valid.select(F.input_file_name()).distinct().count(), recent.count())
    finally:
        for c, value in before.items():
            spark.conf.set(c, value) if value else spark.conf.unset(c)
    assert held[False][2] == held[True][2] and held[False][0] == held[False][1] == 30
    assert held[True][1] == 40 and held[True][0] <= 6


def test_chosen_keys_are_joined_before_copies_are_compared(spark, small_broadcasts_off):
    from tidemark.operators.conform import latest_conformed
    raw = materialise(fixtures.transactions(spark, FOLDER), "raw")
    keys = spark.createDataFrame([(k,) for k in ("TXN-000000011", "TXN-000000021")], "id string")
    for partitioned in (False, True):
        rows = latest_conformed(raw, TRANSACTIONS, partitioned, keys)
        plan = physical(rows)
        assert plan.index("Window") < plan.index("LeftSemi")
        expected = latest_conformed(raw, TRANSACTIONS).filter(F.col("TransactionID").isin("TXN-000000011", "TXN-000000021"))
        assert sorted(map(str, rows.collect())) == sorted(map(str, expected.collect()))


def test_only_few_alerts_are_broadcast(spark, small_broadcasts_off):
    from tidemark.operators import consume
    alerts = spark.createDataFrame([("a", "t", "low", "open", dt.datetime(2024, 1, 1))],
                                   "AlertID string, TransactionID string, Severity string, Status string, CreatedTimestamp timestamp")
    facts = spark.createDataFrame([("t", 1, 1.0, 1.0, "Low")], "TransactionID string, MerchantSK long, Amount double, RiskScore double, RiskBand string")
    names = spark.createDataFrame([(1, "m", "Low")], "MerchantSK long, MerchantName string, MerchantRiskCategory string")
    for top, broadcasts in ((25, 1), (10 ** 6, 0)):
        report = consume.alert_drillthrough(alerts, facts, names, top)
        assert count(physical(report), "BroadcastExchange") == broadcasts and report.count() == 1
