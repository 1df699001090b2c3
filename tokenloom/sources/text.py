"""Text corpora."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.functions.text import normalise_newlines
from tokenloom.sources.files import list_files
from tokenloom.sources.ranged_text import read_ranged


def read_text(
    spark: SparkSession,
    paths: str | list[str],
    *,
    range_bytes: int = 64 << 20,
    piece_bytes: int = 1 << 20,
) -> DataFrame:
    """(doc_id, text) of UTF-8 text files, with `\\r\\n` and `\\r` read as `\\n`.

    Files are read in pieces of about `piece_bytes` whatever their size, a small file in one.
    `doc_id` follows the sorted file names and, inside a file, the byte offset, so it orders the
    corpus as if the files were one after another; it is known where a piece is read, and
    nothing is joined or shuffled. A byte that is not valid UTF-8 is an error. Tasks open the
    files by themselves, so paths must be ones that pyarrow reaches.
    """
    files = [f for f in list_files(spark, paths) if f[1]]
    if not files:
        return spark.createDataFrame([], "doc_id bigint, text string")
    pieces = read_ranged(
        spark,
        files,
        unit="piece",
        range_bytes=range_bytes,
        piece_bytes=piece_bytes,
        file_bits=max(length for _, length in files).bit_length(),
    )
    return pieces.select(F.col("position").alias("doc_id"), normalise_newlines(F.col("text")).alias("text"))
