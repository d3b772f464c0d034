"""Checks on source objects and on whole batches before they are used."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.contracts import (
    BATCH_REFERENCES,
    BY_SOURCE,
    ID_PATTERNS,
    REQUIRED_COLUMNS,
    VALIDATION_SCHEMA,
)
from tidemark.operators.conform import RunInfo
from tidemark.session import concurrently

Loaders = Mapping[str, Callable[[], DataFrame]]


class ValidationError(RuntimeError):
    pass


def validate_sources(spark: SparkSession, loaders: Loaders, run: RunInfo,
                     source: str = "source") -> DataFrame:
    """One row per expected object.

    An object passes if it can be read, has rows and has its required columns.  One
    that cannot be read is a finding like any other and carries the whole error.
    """
    def finding(name: str) -> tuple[int, str | None]:
        try:
            rows = loaders[name]()
            absent = [c for c in REQUIRED_COLUMNS[name] if c not in rows.columns]
            size = rows.count()
        except Exception as error:  # whatever went wrong is the result
            return 0, f"{type(error).__name__}: {error}"
        if absent:
            return size, "columns absent: " + ", ".join(sorted(absent))
        return size, None if size else "no rows"

    found = concurrently({name: lambda name=name: finding(name) for name in REQUIRED_COLUMNS})
    return spark.createDataFrame(
        [(run.run_id, run.run_date, source, name, size, "source_read_and_schema",
          "FAIL" if problem else "PASS", problem or "readable and complete")
         for name, (size, problem) in found.items()], VALIDATION_SCHEMA)


def raise_on_failure(results: DataFrame, what: str) -> None:
    failed = results.filter(F.col("status") == "FAIL").count()
    if failed:
        raise ValidationError(f"{what} failed for {failed} object(s)")


def validate_batch(tables: Mapping[str, DataFrame], expected_counts: DataFrame,
                   first_batch: bool = True) -> DataFrame:
    """(check, object, failures) rows for a batch; all zero means it is good.

    ``expected_counts`` has columns ``object`` and ``expected``.  Each table is
    scanned once for its count, key and spelling checks; references are checked
    on a first batch only.
    """
    measures = [_measure_table(df, name) for name, df in tables.items()]
    checks = measures[0]
    for other in measures[1:]:
        checks = checks.unionByName(other)
    expected = expected_counts.select(F.lit("row_count").alias("check"), "object", "expected")
    off_by = F.abs(F.coalesce("failures", F.lit(0)) - F.coalesce("expected", F.lit(0)))
    result = checks.join(expected, ["check", "object"], "full_outer").select(
        "check", "object",
        F.when(F.col("check") == "row_count", off_by).otherwise(F.col("failures"))
        .alias("failures"))
    if first_batch:
        for child, column, parent in BATCH_REFERENCES:
            if child in tables and parent in tables:
                result = result.unionByName(_orphans(tables[child], child, column,
                                                     tables[parent], parent))
    return result


def _measure_table(df: DataFrame, name: str) -> DataFrame:
    key = F.coalesce(F.col(BY_SOURCE[name].source_key), F.lit(""))
    measures = {
        "row_count": F.count("*"),
        "duplicate_key": F.count("*") - F.count_distinct(key),
    }
    for column, pattern in ID_PATTERNS.items():
        if column in df.columns:
            wrong = (F.col(column) != "") & ~F.col(column).rlike(pattern)
            measures[f"pattern:{column}"] = F.count_if(wrong)
    pairs = F.array(*[F.struct(F.lit(check).alias("check"), value.alias("failures"))
                      for check, value in measures.items()])
    return df.agg(pairs.alias("pairs")).select(
        F.explode("pairs").alias("p")).select(
            "p.check", F.lit(name).alias("object"), "p.failures")


def _orphans(child_df: DataFrame, child: str, column: str, parent_df: DataFrame,
             parent: str) -> DataFrame:
    """Child rows whose reference is absent from the parent, counted per id first."""
    per_id = child_df.groupBy(F.coalesce(F.col(column), F.lit("")).alias("id")).agg(
        F.count("*").alias("rows"))
    known = parent_df.select(F.col(BY_SOURCE[parent].source_key).alias("id"))
    return per_id.join(known, "id", "left_anti").agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("failures")).select(
            F.lit(f"orphan:{column}").alias("check"), F.lit(child).alias("object"), "failures")
