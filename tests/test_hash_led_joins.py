"""Text keys with a long shared prefix are joined by their hash first."""

import pytest
from pyspark.sql import functions as F

from tidemark.contracts import BY_TABLE
from tidemark.operators.conform import join_by_hash
from tidemark.operators.quality import flag_entity


@pytest.mark.parametrize("how", ["left", "left_anti"])
def test_same_rows_as_a_join_on_the_key(spark, how):
    left = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), ("b", 4), ("c", 5)], "k string, l int")
    right = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3), (None, 4)], "k string, r int")
    plain, led = left.join(right, "k", how), join_by_hash(left, right, "k", how)
    assert led.columns == plain.columns
    assert sorted(map(str, led.collect())) == sorted(map(str, plain.collect()))
    plan = join_by_hash(left.hint("merge"), right, "k", how)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [hash(k" in plan


def test_parent_check_sorts_by_hash_and_does_not_send_the_key_twice(spark):
    rows = [("TXN-000000001", 5.0), ("TXN-000000001", 5.0), ("TXN-000000002", 7.0), (None, 1.0), (None, 1.0)]
    raw = spark.createDataFrame(rows, "TRANSACTION_ID string, RISK_SCORE double").select(
        "TRANSACTION_ID", "RISK_SCORE", F.lit("Low").alias("RISK_BAND"), F.lit("m").alias("MODEL_VERSION"),
        F.lit("2024-01-01T00:00:00Z").alias("SCORED_TIMESTAMP"), F.lit("[]").alias("RISK_FACTORS_JSON"),
        F.lit("initial").alias("SOURCE_BATCH"))
    parent = spark.createDataFrame([("TXN-000000001",), ("TXN-000000009",)], "TransactionID string")
    results = [flag_entity(raw, BY_TABLE["transaction_risk"], parent, unique_parent=unique) for unique in (False, True)]
    for flagged in results:
        assert flagged.columns[0] == "TransactionID" and not {"_group", "_hash"} & set(flagged.columns)
        assert sorted((r["TransactionID"] or "", r["is_valid"]) for r in flagged.collect()) == [
            ("", False), ("", False), ("TXN-000000001", True), ("TXN-000000002", False)]
    plan = results[1]._jdf.queryExecution().executedPlan().toString()
    shuffled = next(line for line in plan.splitlines() if "Exchange hashpartitioning(_hash" in line)
    assert "_group" in shuffled and "HashAggregate" not in plan
