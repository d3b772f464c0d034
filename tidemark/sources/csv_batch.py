"""CSV batches with a header contract and a manifest gate."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.contracts import BY_SOURCE, SOURCE_COLUMNS
from tidemark.session import concurrently
from tidemark.sources.keyed import KeyedLayer, Staged

# Fixed value: the only manifest classification that may be loaded.
CLASSIFICATION = "SYNTHETIC_TEST_DATA"


class ContractError(ValueError):
    pass


def read_csv(spark: SparkSession, table: str, path: str, multi_line: bool = True) -> DataFrame:
    """A source CSV as text columns; the header must be the contract's exactly.

    Only the header line is read before the check: a missing, extra, repeated
    or foreign column name fails before any row does.  Every file of a folder is
    held to the header (``enforceSchema`` off).  An empty field is NULL.  A line with
    more or fewer fields than the contract fails the read.  Quoted fields may hold
    line breaks; a file is then read by one task, so write large tables as several
    files, or turn ``multi_line`` off where no field has a line break: one that has
    fails the read.
    """
    if table not in SOURCE_COLUMNS:
        raise ContractError(f"unsupported table: {table}")
    expected = list(SOURCE_COLUMNS[table])
    head = spark.read.option("header", False).csv(path).limit(1).collect()
    header = [str(v).upper() for v in head[0]] if head else []
    if header != expected:
        raise ContractError(f"{path} header must exactly match the {table} contract")
    rows = (spark.read.schema(", ".join(f"{c} string" for c in expected))
            .option("header", True).option("enforceSchema", False)
            .option("escape", '"').option("multiLine", multi_line).option("mode", "FAILFAST")
            .csv(path))
    return rows.select(*[F.nullif(F.col(c), F.lit("")).alias(c) for c in expected])


def read_manifest(spark: SparkSession, batch_folder: str) -> dict:
    """The batch manifest as a dictionary (control data: one small document)."""
    rows = spark.read.option("multiLine", True).json(f"{batch_folder}/manifest.json").collect()
    if len(rows) != 1:
        raise ContractError(f"{batch_folder} needs one manifest")
    return rows[0].asDict(recursive=True)


def load_batch(spark: SparkSession, batch_folder: str,
               multi_line: bool = True) -> dict[str, DataFrame]:
    """Every table of a batch, all of them checked before any is returned.

    A table without a file is not part of the batch.
    """
    manifest = read_manifest(spark, batch_folder)
    if manifest.get("classification") != CLASSIFICATION:
        raise ContractError(f"refusing a batch that is not classified {CLASSIFICATION}")
    tables = {}
    for table in SOURCE_COLUMNS:
        try:
            tables[table] = read_csv(spark, table, f"{batch_folder}/{table}.csv", multi_line)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    return tables


def merge_batch(layer: KeyedLayer, batch_folder: str, multi_line: bool = True,
                workers: int = 4) -> dict[str, DataFrame]:
    """Merge a batch into the layer's tables by their keys; returns the tables as merged.

    The whole batch is checked before any row is written, every table's rows are
    written before any table changes, and all tables change in one switch.  If a
    table fails, what was written is deleted and no table has changed.
    """
    tables = load_batch(layer.spark, batch_folder, multi_line)
    staged: list[Staged] = []

    def stage(name: str, rows: DataFrame) -> None:
        staged.append(layer.stage(name, rows, [BY_SOURCE[name].source_key]))

    try:
        concurrently({name: lambda name=name, rows=rows: stage(name, rows)
                      for name, rows in tables.items()}, workers)
    except Exception:
        layer.discard(staged)
        raise
    layer.commit(staged)
    return {name: layer.read(name) for name in tables}


def manifest_counts(spark: SparkSession, manifest: Mapping) -> DataFrame:
    rows = [(k, v) for k, v in (manifest.get("counts") or {}).items() if v is not None]
    return spark.createDataFrame(rows, "object string, expected bigint")


def write_batch(tables: Mapping[str, DataFrame], batch_folder: str, batch: str,
                classification: str = CLASSIFICATION) -> None:
    """Write tables as a CSV batch; the manifest comes last and closes it.

    Rows are counted as they are handed to the writer, in the same pass, so the
    manifest is a check on the files and not a description of them.
    """
    def write(table: str, df: DataFrame) -> int:
        text = df.select(*[F.col(c).cast("string").alias(c) for c in SOURCE_COLUMNS[table]])
        handed = Observation()
        (text.observe(handed, F.count(F.lit(1)).alias("rows"))
         .write.option("header", True).option("escape", '"').csv(f"{batch_folder}/{table}.csv"))
        return handed.get["rows"]

    counts = concurrently({table: lambda table=table, df=df: write(table, df)
                           for table, df in tables.items()})
    spark = next(iter(tables.values())).sparkSession
    struct = ", ".join(f"{t}: bigint" for t in counts)
    manifest = spark.createDataFrame(
        [(classification, batch, tuple(counts.values()))],
        f"classification string, batch string, counts struct<{struct}>")
    manifest.coalesce(1).write.json(f"{batch_folder}/manifest.json")
