"""Row filters, masks and column allow-lists as view definitions.

These are views: they protect the rows only as far as readers have no access to
the files below.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.contracts import READER_DEVICE_COLUMNS
from tidemark.functions.text import partial_mask

# Table -> masked column and its (prefix, padding, suffix).
MASKS = {
    "DimCustomer": ("CustomerID", 5, "******", 2),
    "DimDevice": ("DeviceFingerprint", 3, "********", 3),
}
PROTECTED_BAND = "High"


def visible_profiles(profile: DataFrame, investigators: DataFrame,
                     user: str | None = None) -> DataFrame:
    """Profiles a reader may see; High ones only for listed investigators.

    ``investigators`` has one column ``PrincipalName``.  ``user`` defaults to
    the session user.  A profile without a band is hidden like a High one.  The
    test for the reader does not refer to the profile row, so it is evaluated
    once and not per row.
    """
    reader = F.current_user() if user is None else F.lit(user)
    listed = investigators.filter(F.col("PrincipalName") == reader).exists()
    return profile.filter((F.col("CustomerRiskBand") != PROTECTED_BAND) | listed)


def visible_profile_counts(visible: DataFrame, user: str) -> DataFrame:
    return visible.agg(
        F.count("*").alias("visible_profiles"),
        F.count_if(F.col("CustomerRiskBand") == PROTECTED_BAND)
        .alias("visible_high_risk_profiles"),
    ).select(F.lit(user).alias("effective_user"), "visible_profiles",
             "visible_high_risk_profiles")


def masked(df: DataFrame, table: str) -> DataFrame:
    """The table with its sensitive column masked."""
    column, prefix, padding, suffix = MASKS[table]
    return df.withColumn(column, partial_mask(F.col(column), prefix, padding, suffix))


def allowed_columns(df: DataFrame, allowed: Sequence[str] = READER_DEVICE_COLUMNS) -> DataFrame:
    """Only the listed columns, in their listed order; absent ones are skipped."""
    return df.select(*[c for c in allowed if c in df.columns])


def add_investigator(investigators: DataFrame, principal: str) -> DataFrame:
    """The list with a principal added once; blank or unset names are refused."""
    if not principal.strip() or principal.startswith("$("):
        raise ValueError("name the principal to add")
    added = investigators.sparkSession.range(1).select(F.lit(principal).alias("PrincipalName"))
    return investigators.unionByName(added).distinct()
