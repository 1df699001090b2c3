"""One generation step over a table of sequences and their logits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.functions.arrays import append_id, keep_last
from tokenloom.functions.core import hashed_uniform
from tokenloom.functions.logits import next_id


def model_context(sequences: DataFrame, block_size: int) -> DataFrame:
    """Replace `ids` by what a model of `block_size` may see of it."""
    return sequences.withColumn("ids", keep_last(F.col("ids"), block_size))


def generate_step(
    sequences: DataFrame,
    *,
    key: str,
    step: int,
    temperature: float = 1.0,
    top_k: int | None = None,
    seed: int = 0,
) -> DataFrame:
    """Draw the next id from `logits` (of the last position) and append it to `ids`.

    Map-only; the draw depends on seed, step and key, so it can be repeated.
    """
    uniform = hashed_uniform(seed, step, F.col(key))
    drawn = next_id(F.col("logits"), uniform, temperature, top_k)
    return sequences.withColumn("next_id", drawn).withColumn(
        "ids", append_id(F.col("ids"), F.col("next_id"))
    )
