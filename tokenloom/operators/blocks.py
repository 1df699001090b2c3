"""Training blocks: random starts and the (x, y) windows behind them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.functions.core import hashed_bits, int_div

DRAW = ["split", "batch_id", "row_id", "start"]
# Draws up to this many rows (about 50 bytes each) may be broadcast.
BROADCAST_DRAWS = 200_000


def draw_starts(
    spark: SparkSession,
    n_tokens: Mapping[str, int],
    *,
    block_size: int,
    batch_size: int,
    batches: int | Mapping[str, int],
    seed: int | str = 0,
) -> DataFrame:
    """(split, batch_id, row_id, start): uniform starts in [0, n - block_size), with
    replacement; the same seed always gives the same starts."""
    parts = []
    for split in sorted(n_tokens):
        room = n_tokens[split] - block_size
        if room <= 0:
            raise ValueError(
                f"split {split!r} has {n_tokens[split]} tokens, too few for blocks of {block_size}"
            )
        count = batches if isinstance(batches, int) else batches[split]
        draws = spark.range(count * batch_size)
        parts.append(
            draws.select(
                F.lit(split).alias("split"),
                int_div(F.col("id"), batch_size).alias("batch_id"),
                (F.col("id") % batch_size).cast("int").alias("row_id"),
                (hashed_bits(seed, split, F.col("id")) % room).alias("start"),
            )
        )
    starts = parts[0]
    for part in parts[1:]:
        starts = starts.unionAll(part)
    return starts


def cut_blocks(
    starts: DataFrame,
    chunks: DataFrame,
    block_size: int,
    *,
    chunk_size: int | None = None,
    n_starts: int | None = None,
) -> DataFrame:
    """(split, batch_id, row_id, start, x, y) for every start; y is x moved by one token.

    Chunks of `chunk_size` tokens (block_size if not given) that carry the block_size tokens after
    them as `halo` hold every block that starts in them, so this is an equi-join on one key per
    start and tokens are shuffled once. Chunks of block_size tokens without a halo are joined by two keys. When
    the starts are few (`n_starts`, or counted here) they are broadcast and the chunk table is only
    scanned; otherwise both sides shuffle. Chunks are never broadcast.
    """
    chunk_size = chunk_size or block_size
    small = (starts.count() if n_starts is None else n_starts) <= BROADCAST_DRAWS
    joined = _beside_halo if "halo" in chunks.columns else _beside_following
    offset = (F.col("start") % chunk_size).cast("int")
    # block_size + 1 tokens, those beyond the chunk from its halo.
    own = F.slice("tokens", offset + 1, F.lit(block_size + 1))
    more = F.greatest(offset + block_size + 1 - F.size("tokens"), F.lit(0))
    both = F.concat(own, F.slice("halo", F.lit(1), more))
    window = joined(starts, chunks, chunk_size, small).select(*DRAW, both.alias("both"))
    return window.select(
        *DRAW, F.slice("both", 1, block_size).alias("x"), F.slice("both", 2, block_size).alias("y")
    )


def _sided(wanted: DataFrame, small: bool) -> DataFrame:
    """Starts to broadcast if they are few; otherwise no side is. Spark reckons an array column as
    one element, so it would take many chunks for a small table and collect them all on the driver."""
    return F.broadcast(wanted) if small else wanted.hint("merge")


def _beside_halo(starts: DataFrame, chunks: DataFrame, size: int, small: bool) -> DataFrame:
    """Every start with the tokens and the halo of its chunk."""
    wanted = starts.withColumn("chunk_id", int_div(F.col("start"), size))
    return chunks.select("split", "chunk_id", "tokens", "halo").join(_sided(wanted, small), ["split", "chunk_id"])


def _beside_following(starts: DataFrame, chunks: DataFrame, size: int, small: bool) -> DataFrame:
    """The same with the next chunk as halo: two keys per start, met again by start."""
    first = int_div(F.col("start"), size)
    wanted = starts.withColumn("chunk_id", F.explode(F.array(first, first + 1)))
    pairs = chunks.select("split", "chunk_id", "tokens").join(_sided(wanted, small), ["split", "chunk_id"])
    is_own = F.col("chunk_id") == first
    return pairs.groupBy(*DRAW).agg(
        F.first(F.when(is_own, F.col("tokens")), ignorenulls=True).alias("tokens"),
        F.coalesce(
            F.first(F.when(~is_own, F.col("tokens")), ignorenulls=True), F.array().cast("array<int>")
        ).alias("halo"),
    )
