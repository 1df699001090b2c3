"""Exact duplicates by an exchange of Golomb-coded fingerprints.

1. Send. A sender is a run of at most SLICE rows that a task reads. Of every text it takes a fingerprint
   just wide enough for the table (FALSE_BITS more bits than its rows need), sorts the distinct
   ones, divides them by owner, a range of fingerprints, and codes each owner's share as the
   gaps between them: a Golomb code whose divisor is the power of two next to the mean gap.
2. Owners decode what they got and answer each sender with a bitmap, in the order of its
   fingerprints: which of them another sender sent too.
3. Suspects. Senders turn bitmaps (and repeats among their own rows) into one bit per row. Texts
   are read again with these bits beside them and only suspects' texts move on.
4. Verification. Suspects are grouped by their bytes, combined per task before the shuffle, so a
   text that fills a third of the table crosses the network once per task. False suspects come
   out as groups of one.

A row is named by its file and its position there (`with_rows`), which no retry and no other
division of the scan changes. Tables that are not plain Parquet scans are written out first.

Defined cases: a null text counts as the empty text; of rows with equal text and equal doc_id
the one last in (file, position) stays; a null doc_id is smaller than any other; an empty table gives
no rows; texts of any length are whole. Groups are told apart by SHA-256 once their bytes have been compared:
two texts of one SHA-256 raise an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.llm import common
from tokenloom.llm.common import join_uneven, python_tasks, stored

SLICE = 1 << 16
# Fingerprints of one owner, and bits that keep false suspects below one in 2**FALSE_BITS.
OWNER_PRINTS = 1 << 21
FALSE_BITS = 10
FILE, ROW = "__file", "__row"

SENT = (
    "part bigint, owner int, n int, shift int, gaps binary, rests binary, "
    "files array<bigint>, rows array<bigint>, ranks array<int>, again binary"
)
NAMES = [f.split()[0] for f in SENT.split(", ")]
KINDS = [
    pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary(),
    pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary(),
]


def golomb(values: np.ndarray, start: int) -> tuple[int, bytes, bytes]:
    """(shift, quotients, remainders) of the gaps between ascending values from `start` on.

    Quotients stand in unary (zeros, then a one), remainders in `shift` bits each, each kind
    in a stream of its own so that both are decoded at once.
    """
    gaps = np.diff(values.astype(np.int64), prepend=np.int64(start))
    mean = int(gaps.mean()) if len(gaps) else 0
    shift = max(0, (mean * 7 // 10).bit_length() - 1)
    ones = np.cumsum((gaps >> shift) + 1) - 1
    unary = np.zeros(int(ones[-1]) + 1 if len(ones) else 0, dtype=np.uint8)
    unary[ones] = 1
    rest = ((gaps[:, None] >> np.arange(shift)) & 1).astype(np.uint8)
    return shift, np.packbits(unary).tobytes(), np.packbits(rest.ravel()).tobytes()


def ungolomb(n: int, shift: int, gaps: bytes, rests: bytes, start: int) -> np.ndarray:
    """The n values that `golomb` coded."""
    ones = np.flatnonzero(np.unpackbits(np.frombuffer(gaps, np.uint8)))[:n]
    out = np.diff(ones, prepend=-1) - 1 << shift
    if shift:
        bits = np.unpackbits(np.frombuffer(rests, np.uint8))[: n * shift].reshape(n, shift)
        out += bits.astype(np.int64) @ (np.int64(1) << np.arange(shift, dtype=np.int64))
    return np.cumsum(out) + start


def owner_start(owner: int, owners: int, bits: int) -> int:
    """The smallest fingerprint of an owner."""
    return -(-(owner << bits) // owners)


def _send(owners: int, bits: int):
    starts = np.array([owner_start(o, owners, bits) for o in range(owners)], dtype=np.int64)

    def rows(columns: list[list]) -> pa.RecordBatch:
        return pa.record_batch([pa.array(c, k) for c, k in zip(columns, KINDS)], NAMES)

    def sender(files: np.ndarray, at: np.ndarray, prints: np.ndarray) -> pa.RecordBatch:
        values, ranks, counts = np.unique(prints, return_inverse=True, return_counts=True)
        part = int(files[0]) ^ (int(at[0]) * 0x9E3779B97F4A7C15 & (1 << 63) - 1)
        cuts = np.append(np.searchsorted(values, starts), len(values))
        out: list[list] = [[] for _ in NAMES]
        for o in np.flatnonzero(np.diff(cuts)):
            share = values[cuts[o] : cuts[o + 1]]
            for column, v in zip(out, [part, o, len(share), *golomb(share, int(starts[o])), None, None, None, None]):
                column.append(v)
        own = np.packbits(counts > 1).tobytes()
        for column, v in zip(out, [part, -1, len(values), None, None, None, files, at, ranks, own]):
            column.append(v)
        return rows(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        n = 0
        for b in batches:
            for i in range(0, len(b), SLICE):
                piece = b.slice(i, SLICE)
                if held and n + len(piece) > SLICE:
                    yield sender(*map(np.concatenate, zip(*held)))
                    held, n = [], 0
                held.append([np.asarray(piece[c], dtype=np.int64) for c in (FILE, ROW, "print")])
                n += len(piece)
        if held:
            yield sender(*map(np.concatenate, zip(*held)))

    return run


def _answer(owners: int, bits: int):
    """Bitmaps of the fingerprints that reached an owner from several senders."""

    def owner_replies(owner: int, messages: list[tuple]) -> pa.RecordBatch:
        start = owner_start(owner, owners, bits)
        values = [ungolomb(*m[1:], start) for m in messages]
        _, at, counts = np.unique(np.concatenate(values), return_inverse=True, return_counts=True)
        several = np.split((counts > 1)[at], np.cumsum([len(v) for v in values])[:-1])
        return pa.record_batch(
            [
                pa.array([m[0] for m in messages], pa.int64()),
                pa.array([owner] * len(messages), pa.int32()),
                pa.array([m[1] for m in messages], pa.int32()),
                pa.array([np.packbits(s).tobytes() for s in several], pa.binary()),
            ],
            ["part", "owner", "n", "again"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, messages = None, []
        for b in batches:
            columns = [b[c].to_pylist() for c in ("owner", "part", "n", "shift", "gaps", "rests")]
            for owner, *message in zip(*columns):
                if owner != current:
                    if messages:
                        yield owner_replies(current, messages)
                    current, messages = owner, []
                messages.append(tuple(message))
        if messages:
            yield owner_replies(current, messages)

    return run


def _mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file, word, bits): one bit for every suspect row, from a sender's rows and its bitmaps."""

    def unpacked(bitmap: bytes, n: int) -> np.ndarray:
        return np.unpackbits(np.frombuffer(bitmap, np.uint8))[:n].astype(bool)

    def words(order: tuple, bitmaps: list[np.ndarray]) -> pa.RecordBatch:
        files, rows, ranks, again = order
        suspect = (again | np.concatenate(bitmaps))[ranks]
        files, rows = files[suspect], rows[suspect]
        keys, at = np.unique(np.stack([files, rows >> 6]), axis=1, return_inverse=True)
        bits = np.zeros(keys.shape[1], dtype=np.uint64)
        np.bitwise_or.at(bits, at.ravel(), np.uint64(1) << (rows & 63).astype(np.uint64))
        return pa.record_batch(
            [pa.array(keys[0]), pa.array(keys[1]), pa.array(bits.view(np.int64))], ["file", "word", "bits"]
        )

    order, bitmaps = None, []
    for b in batches:
        for i in range(len(b)):
            r = {c: b[c][i] for c in ("owner", "n", "files", "rows", "ranks", "again")}
            bitmap = unpacked(r["again"].as_py(), r["n"].as_py())
            if r["owner"].as_py() >= 0:
                bitmaps.append(bitmap)
                continue
            if order:
                yield words(order, bitmaps)
            order = (*[np.asarray(r[c].values) for c in ("files", "rows", "ranks")], bitmap)
            bitmaps = []
    if order:
        yield words(order, bitmaps)


def with_rows(table: DataFrame) -> DataFrame:
    """A plain Parquet scan with the columns that name its rows."""
    return table.withColumns({FILE: F.xxhash64("_metadata.file_path"), ROW: F.col("_metadata.row_index")})


def suspect_words(rows: DataFrame, n: int, false_bits: int = FALSE_BITS) -> DataFrame:
    """(file, word, bits): for 64 consecutive rows of a file, those whose fingerprint is repeated."""
    spark = rows.sparkSession
    bits = min(62, max(1, n.bit_length() + false_bits))
    owners = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // OWNER_PRINTS))
    owners = min(owners, 1 << bits)
    prints = F.shiftrightunsigned(F.xxhash64(F.coalesce("text", F.lit(""))), 64 - bits)
    sent = stored(rows.select(FILE, ROW, prints.alias("print")).mapInArrow(_send(owners, bits), SENT), "prints")
    replies = (
        sent.filter("owner >= 0")
        .select("owner", "part", "n", "shift", "gaps", "rests")
        .repartition(owners, "owner")
        .sortWithinPartitions("owner")
        .mapInArrow(_answer(owners, bits), "part bigint, owner int, n int, again binary")
    )
    marks = (
        sent.filter("owner < 0")
        .select("part", "owner", "n", "again", "files", "rows", "ranks")
        .unionByName(replies, allowMissingColumns=True)
        .repartition("part")
        .sortWithinPartitions("part", "owner")
        .mapInArrow(_mark, "file bigint, word bigint, bits bigint")
    )
    return stored(marks.groupBy("file", "word").agg(F.expr("bit_or(bits)").alias("bits")), "suspects")


def _beside_bits(rows: DataFrame, words: DataFrame) -> DataFrame:
    """`rows` with `suspect`. Texts do not move: bits are broadcast, BROADCAST_ROWS words at a time.

    Files are dealt to as many rounds as that takes, each a scan of its own files. Only the words of one file
    that alone passes the bound are joined by a shuffle.
    """
    n = words.count()
    rounds = -(-n // common.BROADCAST_ROWS) or 1
    keyed = rows.withColumns({"__word": F.shiftright(ROW, 6), "__bit": F.expr(f"cast({ROW} % 64 as int)")})
    out = None
    for r in range(rounds):
        here = words.filter(F.pmod("file", F.lit(rounds)) == r)
        part = keyed.filter(F.pmod(FILE, F.lit(rounds)) == r)
        size = n if rounds == 1 else here.count()
        side = here.select(F.col("file").alias(FILE), F.col("word").alias("__word"), "bits")
        side = F.broadcast(side) if size <= 2 * common.BROADCAST_ROWS else side
        found = part.join(side, [FILE, "__word"], "left")
        out = found if out is None else out.unionByName(found)
    return out.withColumn("suspect", F.expr("coalesce(shiftright(bits, __bit) & 1, 0) = 1"))


def find_copies(docs: DataFrame, *, false_bits: int = FALSE_BITS) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of every row of `docs`."""
    python_tasks(docs.sparkSession)
    if FILE not in docs.columns:
        docs = with_rows(stored(docs.select("doc_id", "text"), "texts"))
    rows = docs.select("doc_id", "text", FILE, ROW)
    n = rows.count()
    text = F.coalesce("text", F.lit(""))
    marked = stored(
        _beside_bits(rows, suspect_words(rows, n, false_bits)).select(
            "doc_id", FILE, ROW, F.sha2(text, 256).alias("text_sha256"), F.when(F.col("suspect"), text).alias("text")
        ),
        "suspect-texts",
    )
    suspects = marked.filter("text is not null")
    one = F.assert_true(F.count("*") == 1, "two texts have one SHA-256")
    verified = (
        suspects.groupBy("text_sha256", "text")
        .agg(F.count("*").alias("n"))
        .groupBy("text_sha256")
        .agg(F.sum("n").alias("group_size"), one.alias("one"))
        .filter("one is null")
    )
    last = suspects.groupBy("text_sha256").agg(F.max(F.struct("doc_id", FILE, ROW)).alias("last"))
    groups = stored(verified.drop("one").join(last, "text_sha256"), "copies")
    kept = (F.col(FILE) == F.col(f"last.{FILE}")) & (F.col(ROW) == F.col(f"last.{ROW}"))
    of_suspects = join_uneven(suspects.drop("text"), groups, "text_sha256", "group_size", n).select(
        "doc_id", F.col("last.doc_id").alias("keep_id"), "group_size", kept.alias("kept"), "text_sha256"
    )
    lone = marked.filter("text is null").select(
        "doc_id",
        F.col("doc_id").alias("keep_id"),
        F.lit(1).cast("bigint").alias("group_size"),
        F.lit(True).alias("kept"),
        "text_sha256",
    )
    return of_suspects.unionByName(lone)
