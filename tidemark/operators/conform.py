"""Typing and renaming of source rows, lineage columns, latest row per key."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.contracts import BATCH_ORDER, Entity

HASH = "_hash"


@dataclass(frozen=True)
class RunInfo:
    """Identity of one run; ``run_date`` (yyyy-MM-dd) defaults to today."""

    run_id: str = "manual"
    run_date: str | None = None


def conform(df: DataFrame, entity: Entity) -> DataFrame:
    """Rename, type, trim and fold the source columns in one projection.

    Conversions never raise: text that does not parse becomes NULL and is left
    to the quality rules.
    """
    columns = []
    for name, data_type in entity.columns.items():
        if name == "SOURCE_BATCH" and not entity.keeps_batch:
            continue
        value = F.col(name).try_cast(data_type)
        if name in entity.trimmed:
            value = F.trim(value)
        if name in entity.uppered:
            value = F.upper(value)
        if name in entity.lowered:
            value = F.lower(value)
        columns.append(value.alias(entity.conformed_name(name)))
    return df.select(*columns)


def batch_rank(batch: str | Column, order: Sequence[str] = BATCH_ORDER) -> Column:
    """Position of a batch label from oldest (1) to newest; unknown labels 0."""
    label = F.col(batch) if isinstance(batch, str) else batch
    return F.coalesce(F.array_position(F.array(*[F.lit(b) for b in order]), label), F.lit(0))


def latest(df: DataFrame, keys: Sequence[str], newest_first: Sequence[str | Column],
           keep_partitioning: bool = False, group: str | None = None) -> DataFrame:
    """One row per key: the newest by ``newest_first``, NULLs oldest.

    Columns not named follow as tie-breakers, so the kept row is the same on
    every run.  Spark turns the rank filter into a per-task group limit ahead of
    the shuffle: a task sends at most one row per key, however many copies of a
    key there are.

    The key's hash leads the sort, because ids share a long common prefix and
    would be compared in full; four bytes of hash decide nearly every
    comparison.  ``keep_partitioning`` leaves it out, so that the result is
    partitioned by the key alone and a join on the key needs no further shuffle.

    Rows without a whole key are no copies of each other: every one is kept, in the
    same pass.  They are grouped by their content and input partition, and as only
    rows with a key have a last tie-breaker, equal ones share the first rank.
    ``group`` names a text column to add that is a single text key, or where that is
    missing such a group; the result is then partitioned and sorted by its hash (column
    ``HASH``) and it, for a join with texts on both.  The key itself does not travel.
    """
    order = [F.col(c) if isinstance(c, str) else c for c in newest_first]
    named = {c for c in newest_first if isinstance(c, str)}
    plain = [f.name for f in df.schema.fields if f.dataType.typeName() not in ("map", "variant")]
    order += [F.col(c) for c in plain if c not in named and c not in keys]
    order = [c.desc_nulls_last() for c in order]
    groups = [F.col(k) for k in keys]
    unkeyed = reduce(or_, [F.col(k).isNull() for k in keys])
    if keep_partitioning:
        # A join on the key finds none of the rows without one, so they would only
        # cost the partitioning; see ``unkeyed_rows`` for a plan that wants them.
        window = Window.partitionBy(*groups).orderBy(*order)
        numbered = df.filter(~unkeyed).withColumn("_row_number", F.row_number().over(window))
        return numbered.filter(F.col("_row_number") == 1).drop("_row_number")
    content = F.xxhash64(F.spark_partition_id(), *plain)
    marked = df.withColumn("_copy", F.when(~unkeyed, F.monotonically_increasing_id()))
    if group:
        # No text key starts with a NUL.
        marked = marked.withColumn(group, F.coalesce(*groups, F.concat(F.lit("\0"), content.cast("string"))))
        marked = marked.withColumn(HASH, F.hash(group)).drop(*keys)
        window = Window.partitionBy(HASH, group)
    else:
        marked = marked.withColumn("_content", F.when(unkeyed, content))
        window = Window.partitionBy(F.hash(*keys), *groups, "_content")
    ranked = marked.withColumn("_rank", F.rank().over(window.orderBy(*order, "_copy")))
    kept = ranked.filter(F.col("_rank") == 1).drop("_rank", "_copy", "_content")
    if group:
        key = F.when(~F.startswith(group, F.lit("\0")), F.col(group))
        kept = kept.select(*[key.alias(c) if c in keys else F.col(c) for c in df.columns], group, HASH)
    return kept


def join_by_hash(left: DataFrame, right: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Join on a text key, with its hash ahead of it.

    Keys that share a long prefix are then sorted by four bytes and not compared in
    full.  The hash is computed on both sides and does not travel.
    """
    side = right.withColumnRenamed(key, "_side_key")
    same = (F.hash(key) == F.hash("_side_key")) & (F.col(key) == F.col("_side_key"))
    return left.join(side, same, how).drop("_side_key")


def unkeyed_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows that ``latest`` with ``keep_partitioning`` leaves out."""
    return df.filter(reduce(or_, [F.col(k).isNull() for k in keys]))


def latest_conformed(df: DataFrame, entity: Entity, keep_partitioning: bool = False,
                     only: DataFrame | None = None, group: str | None = None) -> DataFrame:
    """Conform first, then keep the latest row of each conformed key.

    ``only`` holds the keys that are wanted, if not all are: the rows of other keys
    are left out before any are compared or shuffled.
    """
    order = [batch_rank(c) if c == "SourceBatch" else c for c in entity.newest_first]
    rows = conform(df, entity)
    if only is not None:
        wanted = only.select(F.col(only.columns[0]).alias(entity.key))
        rows = rows.join(wanted, entity.key, "left_semi").select(*rows.columns)
    return latest(rows, [entity.key], order, keep_partitioning, group)


def lineage_columns(run: RunInfo, source_system: str | Column,
                    loaded_at: str = "silver_loaded_at") -> dict[str, Column]:
    run_date = F.lit(run.run_date).cast("date") if run.run_date else F.current_date()
    system = F.lit(source_system) if isinstance(source_system, str) else source_system
    return {
        "source_system": system,
        "pipeline_run_id": F.lit(run.run_id),
        "run_date": run_date,
        loaded_at: F.current_timestamp(),
    }


def with_lineage(df: DataFrame, run: RunInfo, source_system: str | Column,
                 loaded_at: str = "silver_loaded_at") -> DataFrame:
    return df.withColumns(lineage_columns(run, source_system, loaded_at))


def with_gold_lineage(df: DataFrame, run: RunInfo) -> DataFrame:
    columns = lineage_columns(run, "", "gold_loaded_at")
    del columns["source_system"]
    return df.withColumns(columns)
