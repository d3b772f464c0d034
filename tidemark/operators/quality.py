"""Quality rules, the valid / quarantined split, duplicate detection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.contracts import Entity
from tidemark.operators.conform import HASH, conform, latest_conformed, unkeyed_rows

FLAG = "is_valid"
REASON = "quarantine_reason"


def passes(rules: Mapping[str, str | Column]) -> Column:
    """True only if every rule is true; a rule that is NULL is a failed rule."""
    verdict = F.lit(True)
    for rule in rules.values():
        verdict = verdict & (F.expr(rule) if isinstance(rule, str) else rule)
    return F.coalesce(verdict, F.lit(False))


def failed_rules(rules: Mapping[str, str | Column]) -> Column:
    """Names of the rules a row breaks."""
    return F.array_compact(F.array(*[
        F.when(~passes({name: rule}), F.lit(name)) for name, rule in rules.items()]))


def flag_quality(df: DataFrame, rules: Mapping[str, str | Column], reason: str,
                 detail: bool = False) -> DataFrame:
    """Mark each row; nothing is dropped, so the two halves are exhaustive.

    ``detail`` adds an array naming the broken rules.
    """
    flagged = df.withColumn(FLAG, passes(rules)).withColumn(
        REASON, F.when(~F.col(FLAG), F.lit(reason)))
    return flagged.withColumn("failed_rules", failed_rules(rules)) if detail else flagged


def valid_rows(flagged: DataFrame) -> DataFrame:
    return flagged.filter(F.col(FLAG)).drop(FLAG, REASON, "failed_rules")


def quarantined_rows(flagged: DataFrame) -> DataFrame:
    return flagged.filter(~F.col(FLAG)).drop(FLAG)


def split_quality(df: DataFrame, rules: Mapping[str, str | Column],
                  reason: str) -> tuple[DataFrame, DataFrame]:
    flagged = flag_quality(df, rules, reason)
    return valid_rows(flagged), quarantined_rows(flagged)


def flag_entity(raw: DataFrame, entity: Entity, parent: DataFrame | None = None,
                detail: bool = False, check_parent: bool = True,
                joined_next: bool = False, only: DataFrame | None = None,
                unique_parent: bool = False) -> DataFrame:
    """Latest conformed rows of an entity with their verdict.

    For an entity with a parent, ``parent`` holds the parent's valid rows; a
    row whose parent was itself quarantined is quarantined too.  A plan that
    only joins the rows to valid parents makes that check by its join and may
    leave it out here.  ``joined_next`` says that the plan goes on to join on the
    entity's key, so the rows should stay partitioned by it; rows without a key are
    then left to ``flag_unkeyed``.  ``only`` limits the rows to those of its keys.
    ``unique_parent`` says that ``parent`` has no key twice, as written silver has not.
    """
    checked = entity.parent is not None and check_parent
    rules: dict[str, str | Column] = dict(entity.rules)
    if not checked:
        rows = latest_conformed(raw, entity, joined_next, only)
        return flag_quality(rows, rules, entity.reason, detail)
    if parent is None:
        raise ValueError(f"{entity.table} needs the valid rows of {entity.parent[0]}")
    key = entity.parent[1]
    present = parent.select(key)
    rules["parent"] = F.col("_parent")
    if joined_next or key != entity.key:
        joined = [key]
        rows = latest_conformed(raw, entity, joined_next, only)
    else:
        joined = [HASH, "_group"]
        rows = latest_conformed(raw, entity, only=only, group="_group")
        present = present.select(F.hash(key).alias(HASH), F.col(key).alias("_group"))
    if not unique_parent:
        present = present.distinct()
    rows = rows.join(present.withColumn("_parent", F.lit(True)), joined, "left").drop(HASH, "_group")
    return flag_quality(rows, rules, entity.reason, detail).drop("_parent")


def flag_unkeyed(raw: DataFrame, entity: Entity) -> DataFrame:
    """The rows that ``flag_entity`` with ``joined_next`` leaves out, all of them invalid."""
    rows = unkeyed_rows(conform(raw, entity), [entity.key])
    return flag_quality(rows, {"key": F.lit(False)}, entity.reason)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row counts."""
    return df.groupBy(*keys).agg(F.count("*").alias("row_count")).filter(F.col("row_count") > 1)
