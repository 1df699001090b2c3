"""Losses over tables of logits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.functions.logits import cross_entropy

IGNORED_TARGET = -1


def row_losses(logits: DataFrame, ignore: int = IGNORED_TARGET) -> DataFrame:
    """Add `loss`; null for ignored targets."""
    return logits.withColumn("loss", cross_entropy(F.col("logits"), F.col("target"), ignore))


def batch_losses(logits: DataFrame, ignore: int = IGNORED_TARGET) -> DataFrame:
    """(split, batch_id, loss): mean over the counted targets of each batch, null if none."""
    return row_losses(logits, ignore).groupBy("split", "batch_id").agg(F.avg("loss").alias("loss"))


def split_losses(logits: DataFrame, ignore: int = IGNORED_TARGET) -> DataFrame:
    """(split, loss, batches): the mean of batch means, not of tokens."""
    return batch_losses(logits, ignore).groupBy("split").agg(
        F.avg("loss").alias("loss"), F.count("*").alias("batches")
    )
