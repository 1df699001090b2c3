"""Queries over `documents`: split, vocabulary, character tokens, chunks, blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.catalog.registry import query, table
from tokenloom.functions.arrays import chunk_array, flatten_once
from tokenloom.functions.text import characters
from tokenloom.operators.blocks import cut_blocks, draw_starts
from tokenloom.operators.chunks import count_tokens, pack_chunks, token_positions, unpack_chunks
from tokenloom.operators.layout import spread_small
from tokenloom.operators.filters import remove_rows
from tokenloom.operators.split import (
    Cut,
    count_characters,
    document_offsets,
    locate_cut,
    split_corpus,
)
from tokenloom.operators.vocab import (
    build_vocab,
    char_decoder,
    encode_chars,
    lookup_ids,
    vocab_maps,
    vocab_size,
    widen_id,
)

BLOCK_SIZE = 256
# Chunks that carry a halo of one block, so a quarter of their tokens is stored twice.
HALO_CHUNK = 4 * BLOCK_SIZE
BATCH_SIZE = 6
SEED = 1337

# SQL shared by several oracles.
SPLIT_SQL = """
WITH positioned AS (
  SELECT doc_id, text, length(text)::BIGINT AS n,
         (coalesce(sum(length(text)) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING
                                           AND 1 PRECEDING), 0))::BIGINT AS start,
         (floor((sum(length(text)) OVER ())::DOUBLE * 0.9::DOUBLE))::BIGINT AS cut
  FROM documents
), pieces AS (
  SELECT 'train' AS split, doc_id,
         substring(text, 1, greatest(least(n, cut - start), 0)::BIGINT) AS text FROM positioned
  UNION ALL
  SELECT 'val' AS split, doc_id,
         substring(text, (greatest(least(n, cut - start), 0) + 1)::BIGINT) AS text FROM positioned
), split_text AS (SELECT * FROM pieces WHERE text <> '')
"""

VOCAB_SQL = """
, vocab AS (
  SELECT (row_number() OVER (ORDER BY ch) - 1)::INTEGER AS id, ch
  FROM (SELECT DISTINCT unnest(string_split(text, '')) AS ch FROM documents) WHERE ch <> ''
)
"""

# One row per token, numbered inside its split.
TOKENS_SQL = (
    SPLIT_SQL
    + VOCAB_SQL
    + """
, stream AS (
  SELECT split, row_number() OVER (PARTITION BY split ORDER BY doc_id, i) - 1 AS pos, id AS token_id
  FROM (SELECT split, doc_id, unnest(string_split(text, '')) AS ch,
               generate_subscripts(string_split(text, ''), 1) AS i FROM split_text)
  JOIN vocab USING (ch)
)
"""
)

CHUNKS_SQL = (
    TOKENS_SQL
    + f"""
, chunks AS (
  SELECT split, pos // {BLOCK_SIZE} AS chunk_id, list(token_id ORDER BY pos) AS tokens
  FROM stream GROUP BY split, pos // {BLOCK_SIZE}
)
"""
)

STARTS_SQL = f"""
, sizes AS (
  SELECT split, sum(length(text))::BIGINT AS n FROM split_text GROUP BY split
), draws AS (
  SELECT split, n,
         unnest(range(0, {BATCH_SIZE} * greatest(n // ({BATCH_SIZE} * {BLOCK_SIZE}), 1))) AS id
  FROM sizes
), starts AS (
  SELECT split, (id // {BATCH_SIZE})::BIGINT AS batch_id, (id % {BATCH_SIZE})::INTEGER AS row_id,
         ('0x' || substr(md5('{SEED}:' || split || ':' || id::VARCHAR), 1, 13))::BIGINT
           % (n - {BLOCK_SIZE}) AS start
  FROM draws
)
"""


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread_small(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")


def split_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_corpus(documents(spark, sf_dir))


def char_tokens(spark: SparkSession, sf_dir: str, cut: Cut | None = None) -> DataFrame:
    """(split, doc_id, n_tokens, tokens) with character ids."""
    docs = documents(spark, sf_dir)
    return encode_chars(split_corpus(docs, cut=cut), build_vocab(docs))


def char_chunks(
    spark: SparkSession, sf_dir: str, cut: Cut | None = None, *, size: int = BLOCK_SIZE, halo: int = 0
) -> DataFrame:
    return pack_chunks(char_tokens(spark, sf_dir, cut), size, halo=halo)


def epoch_batches(sizes: dict[str, int]) -> dict[str, int]:
    """Batches per split that draw about one epoch."""
    return {s: max(n // (BATCH_SIZE * BLOCK_SIZE), 1) for s, n in sizes.items()}


@query("corpus_split", SPLIT_SQL + "SELECT split, doc_id, text FROM split_text")
def corpus_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_documents(spark, sf_dir)


@query(
    "split_sizes",
    SPLIT_SQL
    + """
SELECT split, count(*)::BIGINT AS pieces, sum(length(text))::BIGINT AS n_chars,
       (SELECT sum(length(text)) FROM documents)::BIGINT AS corpus_chars
FROM split_text GROUP BY split""",
)
def split_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    total = count_characters(documents(spark, sf_dir))
    return (
        split_documents(spark, sf_dir)
        .groupBy("split")
        .agg(F.count("*").alias("pieces"), F.sum(F.char_length("text")).alias("n_chars"))
        .withColumn("corpus_chars", total.scalar())
    )


@query(
    "document_offsets",
    """
SELECT doc_id, length(text)::BIGINT AS n,
       coalesce(sum(length(text)) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING
                                        AND 1 PRECEDING), 0)::BIGINT AS start
FROM documents""",
)
def char_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_offsets(documents(spark, sf_dir))


@query(
    "char_vocab",
    """
SELECT (row_number() OVER (ORDER BY ch) - 1)::INTEGER AS id, ch
FROM (SELECT DISTINCT unnest(string_split(text, '')) AS ch FROM documents) WHERE ch <> ''""",
)
def char_vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_vocab(documents(spark, sf_dir))


@query(
    "vocab_size",
    """
SELECT count(DISTINCT ch)::BIGINT AS vocab_size
FROM (SELECT unnest(string_split(text, '')) AS ch FROM documents) WHERE ch <> ''""",
)
def char_vocab_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vocab_size(build_vocab(documents(spark, sf_dir)))


@query(
    "vocab_maps",
    """
WITH vocab AS (
  SELECT (row_number() OVER (ORDER BY ch) - 1)::INTEGER AS id, ch
  FROM (SELECT DISTINCT unnest(string_split(text, '')) AS ch FROM documents) WHERE ch <> ''
)
SELECT ch, id AS stoi_id, ch AS itos_ch, (SELECT count(*) FROM vocab)::BIGINT AS vocab_size
FROM vocab""",
)
def char_vocab_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    maps = vocab_maps(build_vocab(documents(spark, sf_dir)))
    return maps.select("vocab_size", "itos", F.explode("stoi").alias("ch", "stoi_id")).select(
        "ch", "stoi_id", F.element_at("itos", F.col("stoi_id")).alias("itos_ch"), "vocab_size"
    )


@query(
    "char_histogram",
    VOCAB_SQL.replace(",", "WITH", 1)
    + """
SELECT id AS token_id, ch, count(*)::BIGINT AS n
FROM (SELECT unnest(string_split(text, '')) AS ch FROM documents) JOIN vocab USING (ch) GROUP BY id, ch""",
)
def char_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    chars = docs.select(F.explode(characters(F.col("text"))).alias("ch")).filter("ch <> ''")
    counts = chars.groupBy("ch").agg(F.count("*").alias("n"))
    return lookup_ids(counts, build_vocab(docs))


@query(
    "char_encode",
    SPLIT_SQL
    + VOCAB_SQL
    + """
SELECT split, doc_id, count(*)::BIGINT AS n_tokens,
       md5(string_agg(id::VARCHAR, ',' ORDER BY i)) AS ids_md5
FROM (SELECT split, doc_id, unnest(string_split(text, '')) AS ch,
             generate_subscripts(string_split(text, ''), 1) AS i FROM split_text)
JOIN vocab USING (ch) GROUP BY split, doc_id""",
)
def char_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = F.col("tokens").cast("array<string>")
    return char_tokens(spark, sf_dir).select(
        "split", "doc_id", "n_tokens", F.md5(F.array_join(ids, ",")).alias("ids_md5")
    )


@query("char_decode", SPLIT_SQL + "SELECT split, doc_id, text FROM split_text")
def char_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    vocab = build_vocab(docs)
    encoded = encode_chars(split_corpus(docs), vocab)
    return encoded.select("split", "doc_id", char_decoder(vocab)("tokens").alias("text"))


@query(
    "char_token_counts",
    SPLIT_SQL + "SELECT split, sum(length(text))::BIGINT AS n_tokens FROM split_text GROUP BY split",
)
def char_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        char_tokens(spark, sf_dir)
        .groupBy("split")
        .agg(F.sum(F.size("tokens")).cast("bigint").alias("n_tokens"))
    )


@query(
    "token_positions",
    SPLIT_SQL
    + """
SELECT split, doc_id, length(text)::BIGINT AS n_tokens,
       coalesce(sum(length(text)) OVER (PARTITION BY split ORDER BY doc_id ROWS BETWEEN
                UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
FROM split_text""",
)
def positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = locate_cut(documents(spark, sf_dir))
    return token_positions(char_tokens(spark, sf_dir, cut).select("split", "doc_id", "n_tokens"))


@query(
    "token_chunks",
    CHUNKS_SQL + "SELECT split, chunk_id::BIGINT AS chunk_id, tokens FROM chunks",
)
def token_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return char_chunks(spark, sf_dir).select("split", "chunk_id", "tokens")


@query(
    "token_stream",
    TOKENS_SQL + "SELECT split, pos::BIGINT AS pos, token_id::BIGINT AS token_id FROM stream",
)
def token_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = unpack_chunks(char_chunks(spark, sf_dir), BLOCK_SIZE)
    return stream.withColumn("token_id", widen_id(F.col("token_id")))


@query(
    "chunk_flatten",
    f"""
SELECT doc_id, ((length(text) + {BLOCK_SIZE} - 1) // {BLOCK_SIZE})::BIGINT AS n_chunks,
       text FROM documents""",
)
def chunk_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunked = documents(spark, sf_dir).select(
        "doc_id", chunk_array(characters(F.col("text")), BLOCK_SIZE).alias("chunks")
    )
    return chunked.select(
        "doc_id",
        F.size("chunks").cast("bigint").alias("n_chunks"),
        F.array_join(flatten_once(F.col("chunks")), "").alias("text"),
    )


@query(
    "block_starts",
    SPLIT_SQL + STARTS_SQL + "SELECT split, batch_id, row_id, start FROM starts",
)
def block_starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = char_tokens(spark, sf_dir)
    sizes = {row["split"]: row["n_tokens"] for row in count_tokens(encoded).collect()}
    return draw_starts(
        spark,
        sizes,
        block_size=BLOCK_SIZE,
        batch_size=BATCH_SIZE,
        batches=epoch_batches(sizes),
        seed=SEED,
    )


BLOCKS_SQL = (
    TOKENS_SQL
    + STARTS_SQL
    + f"""
SELECT split, batch_id, row_id, start,
       list(token_id ORDER BY pos) FILTER (WHERE pos < start + {BLOCK_SIZE}) AS x,
       list(token_id ORDER BY pos) FILTER (WHERE pos > start) AS y
FROM (SELECT *, start + unnest(range(0, {BLOCK_SIZE} + 1)) AS pos FROM starts)
JOIN stream USING (split, pos)
GROUP BY split, batch_id, row_id, start"""
)


def epoch_blocks(spark: SparkSession, sf_dir: str, *, counted: bool) -> DataFrame:
    """About one epoch of blocks; `counted` tells the join how many starts there are."""
    # One character is one token, so the cut already gives the tokens per split.
    cut = locate_cut(documents(spark, sf_dir))
    batches = epoch_batches(cut.sizes)
    starts = draw_starts(
        spark, cut.sizes, block_size=BLOCK_SIZE, batch_size=BATCH_SIZE, batches=batches, seed=SEED
    )
    n_starts = BATCH_SIZE * sum(batches.values()) if counted else None
    chunks = char_chunks(spark, sf_dir, cut, size=HALO_CHUNK, halo=BLOCK_SIZE)
    return cut_blocks(starts, chunks, BLOCK_SIZE, chunk_size=HALO_CHUNK, n_starts=n_starts)


@query("training_blocks", BLOCKS_SQL)
def training_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return epoch_blocks(spark, sf_dir, counted=True)


@query("training_blocks_shuffled", BLOCKS_SQL)
def training_blocks_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The join that is used where the starts are too many to broadcast."""
    return epoch_blocks(spark, sf_dir, counted=False)


@query(
    "filter_words",
    """
SELECT doc_id, text FROM documents
WHERE NOT regexp_matches(text, 'the[rn]e?', 'i') AND NOT regexp_matches(text, 'nicht', 'i')
  AND NOT regexp_matches(text, 'EAUX', 'i')""",
)
def filter_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_rows(documents(spark, sf_dir), "text", ["the[rn]e?", "nicht", "EAUX"])
