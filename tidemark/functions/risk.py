"""The explainable customer risk score."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weight per unit and the most points each part can give.  With an
# average transaction risk of 100 the parts add up to exactly 100.
AVERAGE_RISK_WEIGHT = 0.45
CAPPED_PARTS: tuple[tuple[str, float, float], ...] = (
    ("FraudAlertCount", 12.0, 24.0),
    ("FailedLoginCount", 2.0, 12.0),
    ("UntrustedDeviceCount", 5.0, 10.0),
    ("GeographicAnomalyCount", 3.0, 9.0),
)
HIGH_FROM = 80
MEDIUM_FROM = 45


def customer_risk_score() -> Column:
    points = F.coalesce(F.col("AverageTransactionRiskScore"), F.lit(0.0)) * AVERAGE_RISK_WEIGHT
    for measure, weight, cap in CAPPED_PARTS:
        points = points + F.least(F.col(measure) * weight, F.lit(cap))
    return F.round(F.least(F.lit(100.0), points), 2)


def risk_band(score: Column) -> Column:
    return (F.when(score >= HIGH_FROM, "High")
            .when(score >= MEDIUM_FROM, "Medium")
            .otherwise("Low"))
