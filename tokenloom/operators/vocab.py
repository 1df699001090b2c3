"""Character vocabulary and character token ids."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tokenloom.functions.text import characters
from tokenloom.session import bound_batches

# Fixed value: there are 0x110000 Unicode code points, the bound on any vocabulary.
CODE_POINTS = 0x110000


def build_vocab(corpus: DataFrame) -> DataFrame:
    """(id, ch): the distinct characters in code-point order, numbered from 0.

    Duplicates are removed inside each document and then map-side, so the shuffle
    and the numbering window see at most one row per code point.
    """
    distinct = corpus.select(F.explode(F.array_distinct(characters(F.col("text")))).alias("ch"))
    distinct = distinct.filter(F.col("ch") != "").distinct()
    number = F.row_number().over(Window.orderBy("ch")) - 1
    return distinct.select(number.cast("int").alias("id"), "ch")


def vocab_size(vocab: DataFrame) -> DataFrame:
    return vocab.agg(F.count("*").alias("vocab_size"))


def vocab_maps(vocab: DataFrame) -> DataFrame:
    """One row (vocab_size, stoi, itos) with the two lookups as maps."""
    pairs = F.array_sort(F.collect_list(F.struct("id", "ch")))
    return vocab.agg(
        F.count("*").alias("vocab_size"),
        F.map_from_entries(
            F.transform(pairs, lambda p: F.struct(p["ch"], p["id"]))
        ).alias("stoi"),
        F.map_from_entries(pairs).alias("itos"),
    )


def char_encoder(vocab: DataFrame):
    """A function text column -> array<int> column of character ids.

    The vocabulary is fetched once: it has at most one row per Unicode code point, so
    its size is bounded whatever the corpus. Inside the tasks a whole Arrow batch is
    encoded by one gather from a code-point table. A character outside the
    vocabulary is an error.
    """
    bound_batches(vocab.sparkSession)
    table = np.full(CODE_POINTS, -1, dtype=np.int32)
    for row in vocab.select("id", "ch").collect():
        table[ord(row["ch"])] = row["id"]
    used = np.flatnonzero(table >= 0)
    table = table[: used[-1] + 1].copy() if len(used) else table[:1].copy()
    shared = vocab.sparkSession.sparkContext.broadcast(table)

    @F.arrow_udf(T.ArrayType(T.IntegerType(), containsNull=False))
    def encode(texts: pa.Array) -> pa.Array:
        lookup = shared.value
        texts = texts.cast(pa.large_string())
        joined = "".join(t for t in texts.to_pylist() if t is not None)
        codes = np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32)
        if len(codes) and codes.max() >= len(lookup):
            raise KeyError(f"character {chr(codes.max())!r} is not in the vocabulary")
        ids = lookup[codes]
        if len(ids) and ids.min() < 0:
            raise KeyError(f"character {chr(codes[ids.argmin()])!r} is not in the vocabulary")
        lengths = pc.fill_null(pc.utf8_length(texts), 0).to_numpy(zero_copy_only=False)
        offsets = np.zeros(len(texts) + 1, dtype=np.int32)
        np.cumsum(lengths, out=offsets[1:])
        mask = pc.is_null(texts) if texts.null_count else None
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids), mask=mask)

    return encode


def encode_chars(pieces: DataFrame, vocab: DataFrame) -> DataFrame:
    """Replace `text` by `n_tokens` and `tokens`. Map-only.

    `n_tokens` is computed from the text alone, so plans that need only counts or
    positions never run the encoder.
    """
    encode = char_encoder(vocab)
    others = [c for c in pieces.columns if c != "text"]
    return pieces.select(
        *others,
        F.char_length("text").cast("bigint").alias("n_tokens"),
        encode("text").alias("tokens"),
    )


def char_decoder(vocab: DataFrame):
    """A function array<int> column -> text column, the inverse of `char_encoder`."""
    bound_batches(vocab.sparkSession)
    rows = sorted((row["id"], row["ch"]) for row in vocab.select("id", "ch").collect())
    if [number for number, _ in rows] != list(range(len(rows))):
        raise ValueError("the vocabulary's ids are not 0, 1, 2, ...")
    shared = vocab.sparkSession.sparkContext.broadcast([ch for _, ch in rows])

    @F.arrow_udf(T.StringType())
    def decode(ids: pa.Array) -> pa.Array:
        chars = pa.array(shared.value, type=pa.string())
        strings = chars.take(ids.flatten())
        lengths = pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False)
        offsets = np.zeros(len(ids) + 1, dtype=np.int32)
        np.cumsum(lengths, out=offsets[1:])
        mask = pc.is_null(ids) if ids.null_count else None
        lists = pa.ListArray.from_arrays(pa.array(offsets), strings, mask=mask)
        return pc.binary_join(lists, pa.scalar("", type=pa.string()))

    return decode


def lookup_ids(chars: DataFrame, vocab: DataFrame, ch: str = "ch") -> DataFrame:
    """Join ids to a table with one character per row (at most one vocabulary row per
    code point, hence the broadcast)."""
    renamed = vocab.select(F.col("ch").alias(ch), F.col("id").alias("token_id"))
    return chars.join(F.broadcast(renamed), ch, "inner")


def narrow_id(token_id: Column) -> Column:
    """An int between 0 and 65535; anything else fails the query instead of wrapping."""
    ok = token_id.between(0, 65535)
    return F.when(ok, token_id.cast("int")).otherwise(
        F.raise_error(F.concat(F.lit("token id out of range: "), token_id.cast("string"))).cast("int")
    )


def widen_id(token_id: Column) -> Column:
    return token_id.cast("bigint")
