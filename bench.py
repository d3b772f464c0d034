"""Time the headline queries on one machine and print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores.  Each query
is run once to the no-op sink, so that every row and column is computed; the
flagship query runs once beforehand to warm the session.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.plans.queries import REGISTRY  # noqa: E402
from tidemark.session import discard_intermediates  # noqa: E402

HEADLINE = (
    "customer_risk_profile", "latest_transactions", "quality_split_transactions",
    "quality_split_risk", "fact_transactions", "fact_sessions", "dim_customer",
    "txn_profile_30d", "session_profile_30d", "suspicious_transactions", "alert_drillthrough",
    "risk_band_summary", "batch_validation", "reconciliation", "audit_log_upsert",
    "csv_contract_load", "incremental_apply", "stream_upsert_events",
    "secret_scan_documents",
)


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="bench-warehouse-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def timed(spark: SparkSession, name: str, folder: str) -> float:
    start = time.perf_counter()
    REGISTRY[name](spark, folder).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    timed(spark, HEADLINE[0], folder)
    seconds = {name: timed(spark, name, folder) for name in HEADLINE}
    print(json.dumps({
        "metric": "headline queries, total wall time", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
    }))
    discard_intermediates(spark)
    spark.stop()


if __name__ == "__main__":
    main()
