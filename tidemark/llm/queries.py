"""The registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    filter_audit,
    hnsw,
    html_text,
    jaccard,
    licenses,
    line_dedup,
    personal_data,
    pq_dedup,
    quality,
    substring,
    whitening,
)
from tidemark.llm.bpe import decode, encode
from tidemark.llm.common import read
from tidemark.llm.digests import ids_crc32, sha256
from tidemark.llm.packing import pack

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {"op4_line_dedup": line_dedup.SQL, "op5_licenses": licenses.SQL, "op13_filter_audit": filter_audit.SQL}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    REGISTRY[function.__name__] = function
    return function


@query
def op1_quality(spark: SparkSession, folder: str) -> DataFrame:
    documents = read(spark, folder, "documents")
    return quality.score(documents, quality.train(documents, read(spark, folder, "labels")))


@query
def op2_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = pack(read(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return ids_crc32(pieces).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


@query
def op3_html(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.extract(read(spark, folder, "pages")).withColumn("n_chars", F.length("text").cast("long"))


@query
def op4_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.dedup_lines(read(spark, folder, "documents"))


@query
def op5_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(read(spark, folder, "documents"))


@query
def op6_pq_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return pq_dedup.near_duplicates(read(spark, folder, "embeddings"))


@query
def op7_hnsw(spark: SparkSession, folder: str) -> DataFrame:
    return hnsw.nearest(read(spark, folder, "embeddings"))


@query
def op8_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring.dedup_passages(read(spark, folder, "documents")).select(
        "doc_id", "n_words", "n_removed", sha256("kept_text").alias("kept_sha256"))


@query
def op9_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.similar(read(spark, folder, "documents")).select("doc_id", "n_shingles", "component_id")


@query
def op10_bpe(spark: SparkSession, folder: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    decoded = decode(encode(read(spark, folder, "documents"), vocabulary), vocabulary)
    return decoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ",").cast("binary"), 256).alias("ids_sha256"),
        sha256("text").alias("decoded_sha256"))


@query
def op11_whitening(spark: SparkSession, folder: str) -> DataFrame:
    rows = whitening.whiten(read(spark, folder, "embeddings"))
    return rows.withColumn("deviation", F.col("deviation").cast("long"))


@query
def op12_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    rows = personal_data.find(read(spark, folder, "documents"))
    listed = lambda rule: F.expr(
        f"array_join(transform(filter(spans, s -> {rule}), s -> concat_ws(':', s.kind, s.start, s.end)), ',')")
    counts = [F.expr(f"cast(size(filter(spans, s -> s.base and s.kind = '{kind}')) as long)").alias(f"n_{kind}")
              for kind in personal_data.BASE]
    return rows.select("doc_id", *counts, F.sha2(listed("s.base").cast("binary"), 256).alias("base_sha256"),
                       listed("true").alias("spans"))


@query
def op13_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return filter_audit.audit(read(spark, folder, "documents"), read(spark, folder, "labels"))
