"""Corpus to stored training data."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from tokenloom.operators.blocks import cut_blocks, draw_starts
from tokenloom.operators.bpe import encode_bpe
from tokenloom.operators.chunks import count_tokens, pack_chunks
from tokenloom.operators.layout import spread_small
from tokenloom.operators.split import split_corpus
from tokenloom.operators.vocab import build_vocab, encode_chars
from tokenloom.session import shared_dir
from tokenloom.sinks.tokens import write_chunks, write_token_files, write_vocab
from tokenloom.sources.files import join
from tokenloom.sources.tables import read_chunks


@dataclass(frozen=True)
class Prepared:
    """Where the data lies, and the number of tokens per split."""

    chunks: str
    vocab: str
    token_files: str | None
    n_tokens: dict[str, int]
    chunk_size: int


def prepare_corpus(
    corpus: DataFrame,
    folder: str,
    *,
    ranks: DataFrame | None = None,
    train_ratio: float = 0.9,
    chunk_size: int = 256,
    token_files: bool = False,
) -> Prepared:
    """Split (doc_id, text), encode it and write token chunks and the character vocabulary.

    With `ranks` the ids are byte-pair ids, otherwise character ids. Encoded documents
    are stored once, because their positions depend on all counts before them.
    """
    spark = corpus.sparkSession
    corpus = spread_small(corpus, "doc_id")
    vocab_path = write_vocab(build_vocab(corpus), join(folder, "vocab"))
    pieces = split_corpus(corpus, train_ratio)
    if ranks is None:
        encoded = encode_chars(pieces, spark.read.parquet(vocab_path))
    else:
        encoded = encode_bpe(pieces, ranks)
    stored = shared_dir(spark, "encoded")
    encoded.write.parquet(stored)
    encoded = spark.read.parquet(stored)
    sizes = {row["split"]: row["n_tokens"] for row in count_tokens(encoded).collect()}
    chunks = write_chunks(pack_chunks(encoded, chunk_size), join(folder, "chunks"))
    flat = join(folder, "tokens")
    if token_files:
        write_token_files(read_chunks(spark, chunks), flat, chunk_size=chunk_size, ordered=True)
    return Prepared(chunks, vocab_path, flat if token_files else None, sizes, chunk_size)


def sample_blocks(
    chunks: DataFrame,
    data: Prepared,
    *,
    batch_size: int,
    batches: int,
    seed: int = 0,
) -> DataFrame:
    """(split, batch_id, row_id, start, x, y): random training blocks of every split."""
    starts = draw_starts(
        chunks.sparkSession,
        data.n_tokens,
        block_size=data.chunk_size,
        batch_size=batch_size,
        batches=batches,
        seed=seed,
    )
    return cut_blocks(
        starts, chunks, data.chunk_size, n_starts=batches * batch_size * len(data.n_tokens)
    )
