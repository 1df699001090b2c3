"""Fixed-size chunks of a token stream: the packed form tokens are stored in."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tokenloom.operators.ranges import store_ranges, sum_before
from tokenloom.operators.vocab import narrow_id
from tokenloom.session import bound_batches

# Tokens that one task puts in order (64 MB).
TOKENS_PER_SHARD = 1 << 24
CHUNK_SCHEMA = "split string, shard int, chunk_id bigint, tokens array<int>"


def count_tokens(encoded: DataFrame) -> DataFrame:
    """(split, n_tokens)."""
    return encoded.groupBy("split").agg(F.sum("n_tokens").cast("bigint").alias("n_tokens"))


def token_positions(encoded: DataFrame) -> DataFrame:
    """Add `start`: the position of a document's first token in its split.

    (split, doc_id) must be unique; ids may be as sparse as they like.
    """
    return _positions(_narrow_ranges(encoded)).select(*encoded.columns, "start")


def _narrow_ranges(encoded: DataFrame) -> DataFrame:
    return store_ranges(encoded, ["split", "doc_id"])


def _positions(ranged: DataFrame) -> DataFrame:
    return sum_before(ranged, partition=["split"], order=["doc_id"], value="n_tokens", out="start")


@dataclass(frozen=True)
class Shards:
    """How the streams are divided: shard k of a split holds the positions from k * span on, and
    `halo` more. By split: its tokens, the number of its first shard, and per shard the documents
    that its first and its last position lie in, with their first positions."""

    span: int
    halo: int
    sizes: dict[str, int]
    first: dict[str, int]
    heads: dict[str, np.ndarray]
    tails: dict[str, np.ndarray]

    @property
    def count(self) -> int:
        return sum(len(h) for h in self.heads.values())

    def plain(self) -> tuple:
        """The fields, for a broadcast: tasks have no package to find this class in."""
        return (self.span, self.halo, self.sizes, self.first, self.heads, self.tails)

    def owner(self, number: int) -> tuple[str, int]:
        """The split of a shard and its number there."""
        split = max((s for s in self.first if self.first[s] <= number and len(self.heads[s])), key=self.first.get)
        return split, number - self.first[split]

    def slices(self, split: str, doc_id: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
        """(row, shard, from, tokens) of the slices of documents that shards need, row by row.

        Only documents that several shards need are cut; their positions are known from the
        shards' ends.
        """
        heads, tails = self.heads[split], self.tails[split]
        low = np.searchsorted(tails[:, 0], doc_id, side="left")
        high = np.searchsorted(heads[:, 0], doc_id, side="right") - 1
        copies = np.maximum(high - low + 1, 0)
        row = np.repeat(np.arange(len(doc_id)), copies)
        shard = np.arange(copies.sum()) - np.repeat(np.cumsum(copies) - copies, copies) + low[row]
        # A document at a shard's end has its position there; any other one is whole in one shard.
        start = np.full(len(row), -1, dtype=np.int64)
        for ends in (heads, tails):
            at = ends[:, 0][shard] == doc_id[row]
            start[at] = ends[:, 1][shard[at]]
        inner = start < 0
        begin = np.maximum(shard * self.span, start)
        stop = np.minimum(np.minimum((shard + 1) * self.span + self.halo, self.sizes[split]), start + n[row])
        begin, stop = np.where(inner, 0, begin - start), np.where(inner, n[row], stop - start)
        return row, shard + self.first[split], begin, stop - begin


def divide_stream(encoded: DataFrame, size: int, halo: int, tokens_per_shard: int) -> Shards:
    """Shards of about `tokens_per_shard` tokens, whole chunks each, fewer for small streams.

    Reads (split, doc_id, n_tokens) alone. The driver holds a row for both ends of a shard.
    """
    spark = encoded.sparkSession
    ranged = _narrow_ranges(encoded.filter("n_tokens > 0").select("split", "doc_id", F.col("n_tokens").cast("bigint")))
    sizes = {r[0]: r[1] for r in count_tokens(ranged).collect()}
    even = -(-sum(sizes.values()) // int(spark.conf.get("spark.sql.shuffle.partitions")))
    span = -(-min(tokens_per_shard, max(even, size)) // size) * size
    start, end = F.col("start"), F.col("start") + F.col("n_tokens")

    def ends_inside(offset: int) -> Column:
        """The shards k whose position k * span + offset lies in the document, if any."""
        first = F.expr(f"(greatest(start - {offset}, 0) + {span - 1}) div {span}")
        last = F.expr(f"(start + n_tokens - 1 - {offset}) div {span}")
        inside = (first <= last) & (end > offset)
        return F.when(inside, F.sequence(first, last)).otherwise(F.array().cast("array<bigint>"))

    tail = span + halo - 1
    ends = _positions(ranged).select(
        "split",
        "doc_id",
        "start",
        (end == _size_of(sizes)).alias("final"),
        ends_inside(0).alias("heads"),
        ends_inside(tail).alias("tails"),
    )
    rows = ends.filter("final or size(heads) > 0 or size(tails) > 0").collect()
    heads, tails, first = {}, {}, {}
    for split, tokens in sorted(sizes.items()):
        count = -(-tokens // span)
        heads[split], tails[split] = (np.zeros((count, 2), dtype=np.int64) for _ in range(2))
        first[split] = sum(len(h) for h in heads.values()) - count
        own = [r for r in rows if r["split"] == split]
        for r in own:
            if r["final"]:
                tails[split][:] = r["doc_id"], r["start"]
        for r in own:
            for k in r["heads"]:
                heads[split][k] = r["doc_id"], r["start"]
            for k in r["tails"]:
                tails[split][k] = r["doc_id"], r["start"]
    return Shards(span, halo, sizes, first, heads, tails)


def _size_of(sizes: dict[str, int]) -> Column:
    size = F.lit(None).cast("bigint")
    for split, n in sizes.items():
        size = F.when(F.col("split") == split, n).otherwise(size)
    return size


def _slices(spark: SparkSession, shards: Shards):
    """A column of the slices (shard, from, n) of a document."""
    fields = [T.StructField("shard", T.IntegerType()), T.StructField("from", T.LongType()), T.StructField("n", T.LongType())]
    shared = spark.sparkContext.broadcast(shards.plain())

    @F.arrow_udf(T.ArrayType(T.StructType(fields)))
    def cut(split: pa.Array, doc_id: pa.Array, n_tokens: pa.Array) -> pa.Array:
        known = Shards(*shared.value)
        ids, n = np.asarray(doc_id, dtype=np.int64), np.asarray(n_tokens, dtype=np.int64)
        coded = split.dictionary_encode()
        code = np.asarray(coded.indices)
        found = []
        for c, name in enumerate(coded.dictionary.to_pylist()):
            rows = np.flatnonzero(code == c)
            own = known.slices(name, ids[rows], n[rows])
            found.append((rows[own[0]], *own[1:]))
        row, *columns = (np.concatenate(c) for c in zip(*found)) if found else [np.zeros(0, np.int64)] * 4
        order = np.argsort(row, kind="stable")
        offsets = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(ids)))]).astype(np.int32)
        kinds = (pa.int32(), pa.int64(), pa.int64())
        parts = [pa.array(c[order], k) for c, k in zip(columns, kinds)]
        return pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(parts, ["shard", "from", "n"]))

    return cut


def _cut_shards(spark: SparkSession, size: int, shards: Shards):
    """The chunks of whole shards, whose slices come in order."""
    halo = shards.halo
    shared = spark.sparkContext.broadcast(shards.plain())

    def lists(ids: np.ndarray, begins: np.ndarray, stops: np.ndarray) -> pa.Array:
        offsets = np.concatenate([[0], np.cumsum(stops - begins)]).astype(np.int32)
        values = np.concatenate([ids[a:b] for a, b in zip(begins, stops)])
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int32()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Shards(*shared.value)
        current, held, done, got = None, np.zeros(0, np.int32), 0, 0

        def chunks(count: int) -> pa.RecordBatch:
            """The next `count` chunks of the current shard."""
            split, k = known.owner(current)
            begins = np.arange(count) * size
            stops = np.minimum(begins + size, len(held))
            numbers = np.arange(count, dtype=np.int64) + done + k * (known.span // size)
            columns = [pa.array([split] * count), pa.array([current] * count, pa.int32()), pa.array(numbers), lists(held, begins, stops)]
            if halo:
                columns.append(lists(held, stops, np.minimum(stops + halo, len(held))))
            return pa.record_batch(columns, ["split", "shard", "chunk_id", "tokens", "halo"][: len(columns)])

        def rest() -> Iterator[pa.RecordBatch]:
            split, k = known.owner(current)
            after = known.sizes[split] - k * known.span
            if got != min(known.span + halo, after):
                raise ValueError(f"shard {k} of {split!r} has {got} tokens: the documents have changed")
            left = -(-min(known.span, after) // size) - done
            if left:
                yield chunks(left)

        for b in batches:
            shard, tokens = np.asarray(b["shard"]), b["tokens"]
            ends = np.cumsum(np.asarray(tokens.value_lengths(), dtype=np.int64))
            flat = np.asarray(tokens.flatten(), dtype=np.int32)
            breaks = np.flatnonzero(np.diff(shard)) + 1
            for low, high in zip([0, *breaks], [*breaks, len(shard)]):
                if low == high:
                    continue
                if shard[low] != current:
                    if current is not None:
                        yield from rest()
                    current, held, done, got = int(shard[low]), held[:0], 0, 0
                piece = flat[ends[low - 1] if low else 0 : ends[high - 1]]
                got += len(piece)
                held = np.concatenate([held, piece])
                ready = min((len(held) - halo) // size, known.span // size - done)
                if ready > 0:
                    yield chunks(ready)
                    held, done = held[ready * size :], done + ready
        if current is not None:
            yield from rest()

    return run


def pack_chunks(
    encoded: DataFrame, size: int, *, halo: int = 0, tokens_per_shard: int = TOKENS_PER_SHARD
) -> DataFrame:
    """(split, shard, chunk_id, tokens): `size` consecutive tokens per chunk, the last of a
    split may be short; with `halo`, also up to so many tokens that follow the chunk.

    A shard is a fixed range of positions, so shards are equal in size whatever the documents
    look like. Which documents its ends lie in is found from (split, doc_id, n_tokens) alone;
    a document is then dealt to its shard by comparing ids, and only one that several shards need
    is cut. Tokens move once. A shard is cut into chunks in order by one task, which holds a
    batch of it. (split, doc_id) must be unique and `encoded` must give the same rows each
    time it is read.
    """
    if size < 1:
        raise ValueError("size must be at least 1")
    spark = encoded.sparkSession
    bound_batches(spark)
    shards = divide_stream(encoded, size, halo, tokens_per_shard)
    schema = CHUNK_SCHEMA + (", halo array<int>" if halo else "")
    if not shards.count:
        return spark.createDataFrame([], schema)
    present = encoded.filter("n_tokens > 0").select("split", "doc_id", "n_tokens", "tokens")
    dealt = present.withColumn("s", F.explode(_slices(spark, shards)("split", "doc_id", "n_tokens")))
    whole = (F.col("s.from") == 0) & (F.col("s.n") == F.col("n_tokens"))
    part = F.slice("tokens", (F.col("s.from") + 1).cast("int"), F.col("s.n").cast("int"))
    slices = dealt.select("s.shard", "doc_id", F.when(whole, F.col("tokens")).otherwise(part).alias("tokens"))
    return (
        slices.repartition(shards.count, "shard")
        .sortWithinPartitions("shard", "doc_id")
        .select("shard", "tokens")
        .mapInArrow(_cut_shards(spark, size, shards), schema)
    )


def unpack_chunks(chunks: DataFrame, size: int) -> DataFrame:
    """(split, pos, token_id): one row per token."""
    return chunks.select(
        "split", "chunk_id", F.posexplode("tokens").alias("offset", "token_id")
    ).select(
        "split",
        (F.col("chunk_id") * size + F.col("offset")).alias("pos"),
        narrow_id(F.col("token_id")).alias("token_id"),
    )
