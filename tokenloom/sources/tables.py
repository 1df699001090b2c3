"""Stored vocabularies, merge ranks and token chunks."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom import schemas


def read_vocab(spark: SparkSession, path: str) -> DataFrame:
    """(id, ch); empty when nothing is stored at `path`."""
    try:
        return spark.read.schema(schemas.VOCAB).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schemas.VOCAB)


def read_chunks(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    """(split, chunk_id, tokens); one split reads only its own folder."""
    chunks = spark.read.schema(schemas.TOKEN_CHUNKS).parquet(path)
    return chunks if split is None else chunks.filter(F.col("split") == split)


def read_ranks(spark: SparkSession, path: str) -> DataFrame:
    """(token, rank) from lines of `base64-token rank`."""
    fields = F.split("value", " ")
    return (
        spark.read.text(path)
        .filter(F.col("value") != "")
        .select(
            F.unbase64(fields.getItem(0)).alias("token"), fields.getItem(1).cast("int").alias("rank")
        )
    )
