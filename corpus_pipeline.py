"""The corpus pipeline: STAGES, each over all documents that the stage before it kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read
again as the next one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tokenloom.llm import byte_bpe, decontaminate, jaccard_join, language_id, secret_scan
from tokenloom.session import shared_dir

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTE_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language, or with too uncertain a one, go."""
    return language_id.keep_identified(docs, PIECES)


def remove_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked documents stays."""
    return jaccard_join.keep_one(docs)


def remove_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return decontaminate.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; every document stays."""
    return secret_scan.redact(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, ids) of every document."""
    return byte_bpe.encode_documents(docs, BYTE_RANKS, public_tokenizers.PATTERN)


STAGES = [
    ("language_id", identify_language),
    ("jaccard_join", remove_near_copies),
    ("decontamination", remove_leaks),
    ("secret_scans", redact_secrets),
    ("byte_bpe", encode),
]

# Language scores and token ids have no SQL; tests/llm compares run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = shared_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
