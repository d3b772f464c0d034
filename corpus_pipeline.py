"""From raw documents to packed training windows, stage by stage.

Each stage takes what its predecessor kept and returns the columns of documents; the
last returns packed pieces.  Between stages the rows are written and read again, so
a lost executor costs one stage at most.  Null and empty texts pass through every
stage that judges texts and are packed as an end token.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import jaccard, line_dedup, quality, substring
from tidemark.llm.common import Scratch, read
from tidemark.llm.packing import pack

OTHERS = ("lang", "source", "n_chars")
COLUMNS = ("doc_id", "text", *OTHERS)


def _with_text(docs: DataFrame, changed: str, text: str) -> DataFrame:
    """Columns of documents, with ``text`` and its length where ``changed`` holds."""
    return docs.select(
        "doc_id", F.expr(f"if({changed}, {text}, text)").alias("text"), "lang", "source",
        F.expr(f"if({changed}, cast(length({text}) as long), n_chars)").alias("n_chars"))


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    classifier = quality.train(docs, read(spark, sf_dir, "labels"))
    return quality.score(docs, classifier, keep=COLUMNS[1:]).where("is_good").select(*COLUMNS)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _with_text(line_dedup.dedup_lines(docs, keep=OTHERS), "n_removed > 0", "text")


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    first = jaccard.similar(docs).where("is_first").select(F.col("doc_id").alias("first")).distinct()
    return docs.join(first, docs["doc_id"].eqNullSafe(first["first"]), "left_semi").select(*COLUMNS)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _with_text(substring.dedup_passages(docs, keep=COLUMNS[1:]), "n_removed > 0", "kept_text")


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality", keep_good),
    ("lines", drop_repeated_lines),
    ("near_duplicates", keep_one_of_each_group),
    ("passages", drop_repeated_passages),
    ("packing", pack_windows),
]
# Classifying and packing are beyond SQL; the stages are tested against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, scratch = read(spark, sf_dir, "documents"), Scratch(spark)
    for name, stage in STAGES:
        docs = scratch.write(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
