"""Byte-pair encoding with a given rank table.

Pre-tokenising is a JVM expression. Merging is the only Python step: it works on the
distinct pre-tokens of an Arrow batch and the ids are gathered back by index, so
documents are encoded where they are read, without a shuffle and without a row per
occurrence. Counting jobs join a dictionary of distinct pre-tokens instead.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the pre-token pattern, read with Unicode classes.
PRETOKEN = (
    r"(?U)'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)

# Ids are stored in 16 bits, which bounds the rank table.
MAX_RANKS = 1 << 16

# Merged pre-tokens remembered per task.
MEMO_SIZE = 1 << 18


class Merger:
    """Bytes -> ids for one pre-token; remembers what it has merged."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.memo: dict[str, list[int]] = {}

    def encode(self, piece: str) -> list[int]:
        ids = self.memo.get(piece)
        if ids is None:
            if len(self.memo) >= MEMO_SIZE:
                self.memo.clear()
            ids = self.memo[piece] = self.merge(piece.encode())
        return ids

    def merge(self, raw: bytes) -> list[int]:
        """Join the adjacent pair of lowest rank, leftmost first, until none is left.

        Tokens are spans: `end[i]` closes the span that starts at i (0 once i is inside
        another span) and `before[i]` is the start of the span to its left.
        """
        ranks, size = self.ranks, len(raw)
        if raw in ranks:
            return [ranks[raw]]
        end = list(range(1, size + 1))
        before = list(range(-1, size))
        pairs = [(ranks[raw[i : i + 2]], i, i + 2) for i in range(size - 1) if raw[i : i + 2] in ranks]
        heapify(pairs)
        while pairs:
            _, i, stop = heappop(pairs)
            middle = end[i]
            if not i < middle < stop or end[middle] != stop:
                continue
            end[i], end[middle], before[stop] = stop, 0, i
            left = before[i]
            if left >= 0 and (rank := ranks.get(raw[left:stop])) is not None:
                heappush(pairs, (rank, left, stop))
            if stop < size and (rank := ranks.get(raw[i : end[stop]])) is not None:
                heappush(pairs, (rank, i, end[stop]))
        ids, i = [], 0
        while i < size:
            ids.append(ranks[raw[i : end[i]]])
            i = end[i]
        return ids


def pretokens(text: Column) -> Column:
    """The pieces of a text that are merged on their own; joined they give the text."""
    return F.regexp_extract_all(text, F.lit(PRETOKEN), F.lit(0))


def merger_of(ranks: DataFrame) -> Callable[[], Merger]:
    """Broadcast a (token, rank) table, which may hold at most 65,536 rows; the result
    gives each task its merger."""
    rows = ranks.select("token", "rank").limit(MAX_RANKS + 1).collect()
    if len(rows) > MAX_RANKS:
        raise ValueError("more ranks than 16-bit ids")
    table = {bytes(row["token"]): row["rank"] for row in rows}
    shared = ranks.sparkSession.sparkContext.broadcast(table)
    ready: list[Merger] = []

    def merger() -> Merger:
        if not ready:
            ready.append(Merger(shared.value))
        return ready[0]

    return merger


def bpe_encoder(ranks: DataFrame):
    """A function array<string> column of pre-tokens -> array<int> column of ids."""
    merger = merger_of(ranks)

    @F.arrow_udf(T.ArrayType(T.IntegerType(), containsNull=False))
    def encode(pieces: pa.Array) -> pa.Array:
        words = pieces.flatten().dictionary_encode()
        ids, counts = _merge_all(merger(), words.dictionary)
        first = np.cumsum(counts) - counts
        index = words.indices.to_numpy(zero_copy_only=False)
        lengths = counts[index]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        # Position of every output id in `ids`: start of its word plus its place in it.
        source = np.arange(ends[-1]) + np.repeat(first[index] - ends[:-1], lengths)
        n_pieces = pc.fill_null(pc.list_value_length(pieces), 0).to_numpy(zero_copy_only=False)
        rows = np.concatenate([[0], np.cumsum(n_pieces)])
        offsets = pa.array(ends[rows].astype(np.int32))
        mask = pc.is_null(pieces) if pieces.null_count else None
        return pa.ListArray.from_arrays(offsets, pa.array(ids[source]), mask=mask)

    return encode


def _merge_all(merger: Merger, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words one after another, and the number of ids per word."""
    encoded = [merger.encode(word) for word in words.to_pylist()]
    counts = np.array([len(ids) for ids in encoded], dtype=np.int64)
    flat = np.fromiter((i for ids in encoded for i in ids), dtype=np.int32, count=int(counts.sum()))
    return flat, counts


def encode_bpe(pieces: DataFrame, ranks: DataFrame) -> DataFrame:
    """Replace `text` by `n_tokens` and `tokens`. Map-only. Each document piece is encoded
    as a string of its own; special tokens are plain text.

    Store the result before chunking it: positions need `n_tokens` first.
    """
    encode = bpe_encoder(ranks)
    others = [c for c in pieces.columns if c != "text"]
    encoded = pieces.select(*others, encode(pretokens(F.col("text"))).alias("tokens"))
    return encoded.select(*others, F.size("tokens").cast("bigint").alias("n_tokens"), "tokens")


def piece_counts(pieces: DataFrame) -> DataFrame:
    """(split, piece, n): how often each distinct pre-token occurs in each split."""
    return (
        pieces.select("split", F.explode(pretokens(F.col("text"))).alias("piece"))
        .groupBy("split", "piece")
        .agg(F.count("*").alias("n"))
    )


def piece_dictionary(distinct: DataFrame, ranks: DataFrame) -> DataFrame:
    """(piece, ids) for a table of distinct pre-tokens: each is merged once."""
    merger = merger_of(ranks)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column("piece")
            ids, counts = _merge_all(merger(), words)
            offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
            lists = pa.ListArray.from_arrays(offsets, pa.array(ids))
            yield pa.RecordBatch.from_arrays([words, lists], names=["piece", "ids"])

    return distinct.select("piece").mapInArrow(merge, "piece string, ids array<int>")


def bpe_token_counts(counts: DataFrame, ranks: DataFrame) -> DataFrame:
    """(split, n_tokens) from `piece_counts`: they are joined to the number of ids that each
    distinct pre-token has. No document is encoded, and every join key is unique on the
    dictionary side and once per split on the other, so no key is hot.

    `counts` is read twice: store it first.
    """
    dictionary = piece_dictionary(counts.select("piece").distinct(), ranks)
    return (
        counts.join(dictionary, "piece")
        .groupBy("split")
        .agg(F.sum(F.col("n") * F.size("ids")).cast("bigint").alias("n_tokens"))
    )
