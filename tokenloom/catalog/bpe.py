"""Byte-pair encoding of `documents`.

No rank table can be fetched here, so one is derived from the documents: the 256 bytes,
then the LEARNED most frequent byte strings of 2 to LONGEST bytes anywhere in pre-tokens. These
two are the parameters of the table; whole texts are counted and encoded. Pre-tokens are counted
once, and ranks, dictionary and totals come from that table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tokenloom.catalog.corpus import SPLIT_SQL, split_documents
from tokenloom.catalog.registry import query
from tokenloom.operators.bpe import (
    bpe_token_counts,
    encode_bpe,
    piece_counts,
    piece_dictionary,
    pretokens,
)
from tokenloom.operators.chunks import pack_chunks
from tokenloom.session import shared_dir
from tokenloom.sources.tables import read_ranks

LEARNED = 2000
LONGEST = 6
CHUNK = 128

# The SQL engine has no lookahead: a mark is put before the last blank of every run that
# precedes a non-blank, which is where the run is divided.
PIECES_SQL = """
, occurrences AS (
  SELECT split, doc_id, unnest(pieces) AS piece, generate_subscripts(pieces, 1) AS i
  FROM (SELECT split, doc_id, regexp_extract_all(
          regexp_replace(text, '(\\s+)(\\s\\S)', '\\1' || chr(1) || '\\2', 'g'),
          '''s|''t|''re|''ve|''m|''ll|''d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}\\x01]+|\\s+') AS pieces
        FROM split_text)
), words AS (SELECT piece, hex(encode(piece)) AS h, count(*) AS n FROM occurrences GROUP BY piece)
"""

RANKS_SQL = (
    PIECES_SQL
    + f"""
, strings AS (
  SELECT substr(h, 2 * i + 1, 2 * k) AS token, sum(n) AS n
  FROM (SELECT h, n, k, unnest(range(0, length(h) // 2 - k + 1)) AS i
        FROM (SELECT h, n, unnest(range(2, least({LONGEST}, length(h) // 2) + 1)) AS k FROM words))
  GROUP BY 1
), ranks AS (
  SELECT printf('%02X', b) AS token, b::INTEGER AS rank FROM (SELECT unnest(range(0, 256)) AS b)
  UNION ALL
  SELECT token, (255 + row_number() OVER (ORDER BY n DESC, token))::INTEGER AS rank
  FROM (SELECT * FROM strings ORDER BY n DESC, token LIMIT {LEARNED})
)
"""
)

MERGE_SQL = (
    RANKS_SQL
    + """
, merging AS (
  SELECT piece, 0 AS step, list_transform(range(0, length(h) // 2),
                                          lambda i: substr(h, 2 * i + 1, 2)) AS parts
  FROM words WHERE h NOT IN (SELECT token FROM ranks)
  UNION ALL
  SELECT piece, step + 1, list_concat(list_concat(list_slice(parts, 1, hit - 1),
                                                  [parts[hit] || parts[hit + 1]]),
                                      list_slice(parts, hit + 2, len(parts)))
  FROM (SELECT piece, step, parts, arg_min(i, rank * 100000 + i) AS hit
        FROM (SELECT piece, step, parts, unnest(range(1, len(parts))) AS i FROM merging)
        JOIN ranks ON token = parts[i] || parts[i + 1]
        GROUP BY piece, step, parts)
), merged AS (
  SELECT piece, arg_max(parts, step) AS parts FROM merging GROUP BY piece
  UNION ALL SELECT piece, [h] FROM words WHERE h IN (SELECT token FROM ranks)
), dictionary AS (
  SELECT piece, list(rank ORDER BY i) AS ids
  FROM (SELECT piece, unnest(parts) AS token, generate_subscripts(parts, 1) AS i FROM merged)
  JOIN ranks USING (token) GROUP BY piece
)
"""
)

BPE_SQL = SPLIT_SQL.replace("WITH", "WITH RECURSIVE", 1) + MERGE_SQL


def derived_ranks(counts: DataFrame) -> DataFrame:
    """(token, rank) from (piece, n): single bytes, then frequent byte strings inside pieces."""
    spark = counts.sparkSession
    h = F.hex(F.col("piece").cast("binary"))
    n_bytes = (F.length("h") / 2).cast("int")
    longest = F.least(F.lit(LONGEST), n_bytes)
    lengths = F.when(longest >= 2, F.sequence(F.lit(2), longest))
    frequent = (
        counts.select(h.alias("h"), "n")
        .select("h", "n", F.explode(lengths).alias("k"))
        .select("h", "n", "k", F.explode(F.sequence(F.lit(0), n_bytes - F.col("k"))).alias("i"))
        .groupBy(F.substring("h", F.col("i") * 2 + 1, F.col("k") * 2).alias("token"))
        .agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "token")
        .limit(LEARNED)
    )
    number = F.row_number().over(Window.orderBy(F.desc("n"), "token"))
    single = spark.range(256).select(
        F.unhex(F.lpad(F.hex("id"), 2, "0")).alias("token"), F.col("id").cast("int").alias("rank")
    )
    return single.unionAll(
        frequent.select(F.unhex("token").alias("token"), (number + 255).cast("int").alias("rank"))
    )


def counted_pieces(spark: SparkSession, split_text: DataFrame) -> DataFrame:
    path = shared_dir(spark, "pieces")
    piece_counts(split_text).write.parquet(path)
    return spark.read.parquet(path)


def stored_ranks(spark: SparkSession, counts: DataFrame) -> DataFrame:
    """The derived table written as a rank file and read like any other."""
    path = shared_dir(spark, "ranks")
    line = F.concat_ws(" ", F.base64("token"), F.col("rank").cast("string"))
    derived_ranks(counts).select(line.alias("value")).write.text(path)
    return read_ranks(spark, path)


@query(
    "pretokens",
    SPLIT_SQL
    + PIECES_SQL
    + """
SELECT split, doc_id, count(*)::BIGINT AS n_pieces, string_agg(piece, '|' ORDER BY i) AS pieces
FROM occurrences GROUP BY split, doc_id""",
)
def pretoken_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = split_documents(spark, sf_dir).select(
        "split", "doc_id", pretokens(F.col("text")).alias("p")
    )
    return pieces.select(
        "split",
        "doc_id",
        F.size("p").cast("bigint").alias("n_pieces"),
        F.array_join("p", "|").alias("pieces"),
    )


@query(
    "bpe_dictionary",
    BPE_SQL + "SELECT piece, ids FROM dictionary",
)
def bpe_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = counted_pieces(spark, split_documents(spark, sf_dir))
    return piece_dictionary(counts.select("piece").distinct(), stored_ranks(spark, counts))


@query(
    "bpe_encode",
    BPE_SQL
    + """
SELECT split, doc_id, sum(len(ids))::BIGINT AS n_tokens, flatten(list(ids ORDER BY i)) AS tokens
FROM occurrences JOIN dictionary USING (piece) GROUP BY split, doc_id""",
)
def bpe_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    split_text = split_documents(spark, sf_dir)
    return encode_bpe(split_text, stored_ranks(spark, counted_pieces(spark, split_text)))


@query(
    "bpe_token_counts",
    BPE_SQL
    + """
SELECT split, sum(len(ids))::BIGINT AS n_tokens
FROM occurrences JOIN dictionary USING (piece) GROUP BY split""",
)
def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = counted_pieces(spark, split_documents(spark, sf_dir))
    return bpe_token_counts(counts, stored_ranks(spark, counts))


@query(
    "bpe_chunks",
    BPE_SQL
    + f"""
SELECT split, chunk_id::BIGINT AS chunk_id, list(token_id ORDER BY pos) AS tokens FROM (
  SELECT split, token_id, pos, pos // {CHUNK} AS chunk_id FROM (
    SELECT split, token_id, row_number() OVER (PARTITION BY split ORDER BY doc_id, i, j) - 1 AS pos
    FROM (SELECT split, doc_id, i, unnest(ids) AS token_id, generate_subscripts(ids, 1) AS j
          FROM occurrences JOIN dictionary USING (piece)))) GROUP BY split, chunk_id""",
)
def bpe_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    split_text = split_documents(spark, sf_dir)
    path = shared_dir(spark, "encoded")
    ranks = stored_ranks(spark, counted_pieces(spark, split_text))
    encode_bpe(split_text, ranks).write.parquet(path)
    return pack_chunks(spark.read.parquet(path), CHUNK).select("split", "chunk_id", "tokens")
