"""Keyed upsert as a DataFrame expression."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.conform import latest


class DuplicateKeyError(ValueError):
    """A change set holds more than one row for a key."""


def require_unique(df: DataFrame, keys: Sequence[str]) -> None:
    twice = df.groupBy(*keys).count().filter(F.col("count") > 1).limit(1).collect()
    if twice:
        raise DuplicateKeyError(f"change set has several rows for key {twice[0].asDict()}")


def upsert(target: DataFrame, changes: DataFrame, keys: Sequence[str],
           check: bool = True) -> DataFrame:
    """Changed rows replace target rows with the same key; the rest are added.

    Columns go by name and must be the same on both sides.  The last load wins
    whatever its timestamps say; see ``upsert_newest`` for the other policy.
    """
    if set(target.columns) != set(changes.columns):
        raise ValueError("target and changes must have the same columns")
    if check:
        require_unique(changes, keys)
    kept = target.join(changes.select(*keys), list(keys), "left_anti").select(*target.columns)
    return kept.unionByName(changes)


def upsert_newest(target: DataFrame, changes: DataFrame, keys: Sequence[str],
                  newest_first: Sequence[str]) -> DataFrame:
    """Upsert in which an older row never replaces a newer one."""
    return latest(target.unionByName(changes), keys, newest_first)
