"""Token shards and vocabularies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.sources.files import join, refuse_existing
from tokenloom.sources.token_files import TokenFileSource


def write_chunks(chunks: DataFrame, path: str) -> str:
    """Parquet of (split, chunk_id, tokens) in one folder per split.

    `pack_chunks` has already put whole shards into tasks, so only a sort inside each
    task is added; a file covers whole shards in order.
    """
    keys = ["split", "shard", "chunk_id"] if "shard" in chunks.columns else ["split", "chunk_id"]
    if "shard" not in chunks.columns:
        chunks = chunks.repartitionByRange("split", "chunk_id")
    chunks.sortWithinPartitions(*keys).select("split", "chunk_id", "tokens").write.partitionBy(
        "split"
    ).parquet(path)
    return path


def write_token_files(chunks: DataFrame, folder: str, *, chunk_size: int, ordered: bool = False) -> str:
    """Flat 16-bit files below `folder/<split>/` with a manifest each; in its order they hold the stream.

    `chunks` should be a stored table: it is read once per split. With `ordered` its files hold
    runs of chunks in order, as `write_chunks` leaves them: then tasks write what they
    read, a file per run, and nothing is shuffled. A folder that already holds files is
    refused, for files of another division would stay beside the stream.
    """
    chunks.sparkSession.dataSource.register(TokenFileSource)
    for split in ("train", "val"):
        target = join(folder, split)
        refuse_existing(target)
        part = chunks.filter(F.col("split") == split).select("chunk_id", "tokens")
        if not ordered:
            part = part.repartitionByRange("chunk_id").sortWithinPartitions("chunk_id")
        part.write.format("token_file").option("path", target).option(
            "chunk_size", str(chunk_size)
        ).mode("append").save()
    return folder


def write_vocab(vocab: DataFrame, path: str) -> str:
    vocab.write.parquet(path)
    return path
