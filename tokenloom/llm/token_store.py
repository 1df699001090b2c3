"""Token ids as one concatenated array with Elias-Fano encoded document boundaries.

Layout of a store (a Parquet folder): the documents in ascending order are cut into parts and
these into blocks of whole documents. A row is one block: its part and number, its document ids,
its token ids as little-endian unsigned 16- or 32-bit integers, and the ends of its documents
in the concatenated array as an Elias-Fano sequence. Of each end the `low_bits` lowest bits are
packed side by side; the rest is a bit vector in which end i sets bit (end >> low_bits) + i, so
about two bits and the low bits are spent on a document and no table of 64-bit offsets exists.
`select(i)` finds the i-th set bit from a sample of every SAMPLE-th one and the bytes after it; all
readers get their boundaries from it, `look_up` those of chosen documents alone.

Encoding happens where a text stands: a batch's distinct words are encoded once by the tokenizers
library and a worker remembers MEMO_WORDS of them. That equals encoding the text as one, because
this kind of tokenizer drops white space and merges only inside words. Ids, not texts, are
shuffled: to ranges of the document order chosen from a bounded sample, in which Spark sorts.

Defined cases: a null text is empty and has the end id alone; equal doc_ids stand together, by a
hash of their text; a null doc_id comes first; an empty table makes an empty store. A text
longer than a block is a block of its own. Blocks hold at most BLOCK_IDS ids besides that.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tokenloom.llm.common import (
    MOST_PARTS,
    cut_points,
    kept,
    part_of,
    parts_for,
    python_tasks,
    small_side,
)
from tokenloom.llm.words import mapped_bytes, small_batches, split_words
from tokenloom.session import shared_dir

END_ID = 2
SAMPLE = 64
BLOCK_IDS = 1 << 18
MEMO_WORDS = 1 << 18
# Text bytes encoded at once.
ENCODE_BYTES = 1 << 22
MEMO_LENGTH = 64
DOCS_PER_PART = 50_000
WORDS_AT_ONCE = 4096
_LOWER = bytes(b | 32 if 65 <= b <= 90 else b for b in range(256))
_LETTERS = r"^[a-zA-ZÀ-ÖØ-öø-ÿ]+$"


# Elias-Fano sequences.


class EliasFano:
    """A non-decreasing sequence of whole numbers in compressed form."""

    def __init__(self, n: int, low_bits: int, low: bytes, high: bytes, samples: list[int]):
        self.n, self.low_bits, self.low, self.high, self.samples = n, low_bits, low, high, samples

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, dtype=np.uint64)
        n = len(values)
        top = int(values[-1]) if n else 0
        low_bits = max(0, (top // n).bit_length() - 1) if n else 0
        shifts = np.arange(low_bits, dtype=np.uint64)
        low = ((values[:, None] >> shifts) & np.uint64(1)).astype(np.uint8)
        places = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        high = np.zeros(int(places[-1]) + 1 if n else 0, dtype=np.uint8)
        high[places] = 1
        return cls(
            n,
            low_bits,
            np.packbits(low.ravel(), bitorder="little").tobytes(),
            np.packbits(high, bitorder="little").tobytes(),
            [int(p) for p in places[::SAMPLE]],
        )

    def select(self, i: int) -> int:
        """The i-th value, from the sample before it."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        place = self.samples[i // SAMPLE]
        left = i % SAMPLE
        byte, bit = divmod(place, 8)
        current = self.high[byte] >> bit << bit
        while left >= current.bit_count():
            left -= current.bit_count()
            byte += 1
            current = self.high[byte]
        for _ in range(left):
            current &= current - 1
        place = byte * 8 + (current & -current).bit_length() - 1
        return ((place - i) << self.low_bits) | self._low(i)

    def _low(self, i: int) -> int:
        first = i * self.low_bits
        last = first + self.low_bits
        word = int.from_bytes(self.low[first // 8 : (last + 7) // 8], "little")
        return (word >> (first % 8)) & ((1 << self.low_bits) - 1)

    def values(self) -> np.ndarray:
        """All values at once."""
        bits = np.unpackbits(np.frombuffer(self.high, np.uint8), bitorder="little")
        places = np.flatnonzero(bits)[: self.n].astype(np.int64)
        out = (places - np.arange(self.n)) << self.low_bits
        if self.low_bits:
            low = np.unpackbits(np.frombuffer(self.low, np.uint8), bitorder="little")
            low = low[: self.n * self.low_bits].reshape(self.n, self.low_bits).astype(np.int64)
            out += low @ (np.int64(1) << np.arange(self.low_bits, dtype=np.int64))
        return out


# Encoding.


class WordEncoder:
    """Ids of whole texts through a memo over distinct words."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size()
        self.dtype = np.dtype("<u2") if size <= 1 << 16 else np.dtype("<u4")
        tokens = [self.tokenizer.id_to_token(i) or "" for i in range(size)]
        self.closes = np.array([t.endswith("</w>") for t in tokens])
        self.known: dict[str, int] = {}
        self.ids = np.zeros(1 << 16, dtype=self.dtype)
        self.ends = np.zeros(1 << 12, dtype=np.int64)

    def texts(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text, without an end id."""
        lowered = texts.cast(pa.large_string()).fill_null("")
        # A lower-cased special token would become one, so such texts keep their case.
        marked = np.asarray(pc.match_substring(lowered, "<|"), dtype=bool)
        mapped = mapped_bytes(lowered, _LOWER)
        if marked.any():
            mapped = pc.if_else(pa.array(marked), lowered, mapped)
        codes, words, offsets = split_words(mapped)
        flat, ends = self.words(words)
        starts = np.concatenate([[0], ends])[:-1]
        lengths = (ends - starts)[codes]
        sums = np.concatenate([[0], np.cumsum(lengths)])
        at = np.arange(sums[-1]) + np.repeat(starts[codes] - sums[:-1], lengths)
        stream = flat[at]
        return [stream[a:b] for a, b in zip(sums[offsets[:-1]], sums[offsets[1:]])]

    def words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, end of each word's ids)."""
        names = words.to_pylist()
        at = np.array([self.known.get(w, -1) for w in names], dtype=np.int64)
        missing = np.flatnonzero(at < 0)
        new = self._encode([names[i] for i in missing]) if len(missing) else []
        n = len(names)
        bounds = np.concatenate([[0], self.ends[: len(self.known)]])
        lengths = np.zeros(n, dtype=np.int64)
        old = np.flatnonzero(at >= 0)
        lengths[old] = bounds[at[old] + 1] - bounds[at[old]]
        lengths[missing] = [len(x) for x in new]
        ends = np.cumsum(lengths)
        starts = ends - lengths
        flat = np.zeros(int(ends[-1]) if n else 0, dtype=self.dtype)
        count = lengths[old]
        inner = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
        flat[np.repeat(starts[old], count) + inner] = self.ids[np.repeat(bounds[at[old]], count) + inner]
        if new:
            count = lengths[missing]
            inner = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
            flat[np.repeat(starts[missing], count) + inner] = np.concatenate(new)
            self._remember([names[i] for i in missing], new)
        return flat, ends

    def _remember(self, names: list[str], new: list[np.ndarray]) -> None:
        n = len(self.known)
        kept = [i for i, w in enumerate(names) if len(w) <= MEMO_LENGTH][: MEMO_WORDS - n]
        if not kept:
            return
        used = int(self.ends[n - 1]) if n else 0
        added = np.concatenate([new[i] for i in kept])
        ends = used + np.cumsum([len(new[i]) for i in kept])
        if used + len(added) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(used + len(added), self.dtype)])
        if n + len(kept) > len(self.ends):
            self.ends = np.concatenate([self.ends, np.zeros(n + len(kept), np.int64)])
        self.ids[used : used + len(added)] = added
        self.ends[n : n + len(kept)] = ends
        self.known.update((names[i], n + k) for k, i in enumerate(kept))

    def _encode(self, words: list[str]) -> list[np.ndarray]:
        """Words of plain letters share calls; the closing pieces show where each ends."""
        plain = np.asarray(pc.match_substring_regex(pa.array(words, pa.string()), _LETTERS), dtype=bool)
        out: list[np.ndarray] = [np.zeros(0, self.dtype)] * len(words)
        rows = np.flatnonzero(plain)
        for a in range(0, len(rows), WORDS_AT_ONCE):
            part = rows[a : a + WORDS_AT_ONCE]
            joined = " ".join([words[i] for i in part])
            ids = np.array(self._call([joined])[0], dtype=self.dtype)
            cuts = np.flatnonzero(self.closes[ids]) + 1
            if len(cuts) != len(part):
                raise ValueError("this tokenizer does not close every word with a </w> piece")
            for i, x in zip(part, np.split(ids, cuts[:-1])):
                out[i] = x
        rows = np.flatnonzero(~plain)
        for a in range(0, len(rows), WORDS_AT_ONCE):
            part = rows[a : a + WORDS_AT_ONCE]
            for i, ids in zip(part, self._call([words[i] for i in part])):
                out[i] = np.array(ids, dtype=self.dtype)
        return out

    def _call(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


def encoder(path: str) -> WordEncoder:
    """One encoder per worker process; the file is read where the task runs."""
    return kept(("words", path), lambda: WordEncoder(path))


def encoded_rows(docs: DataFrame, path: str, cuts: list[tuple], end_id: int) -> DataFrame:
    """(part, doc_id, salt, n, ids) with the end id appended."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        end = np.array([end_id], dtype=own.dtype)
        for b in small_batches(batches, most=ENCODE_BYTES):
            rows = [np.concatenate([x, end]) for x in own.texts(b["text"])]
            pa.default_memory_pool().release_unused()
            keys = zip(b["doc_id"].to_pylist(), b["salt"].to_pylist())
            yield pa.record_batch(
                [
                    pa.array([part_of(cuts, k, s) for k, s in keys], pa.int32()),
                    b["doc_id"],
                    b["salt"],
                    pa.array([len(x) for x in rows], pa.int64()),
                    pa.array([x.tobytes() for x in rows], pa.binary()),
                ],
                ["part", "doc_id", "salt", "n", "ids"],
            )

    return docs.select("doc_id", "text", "salt").mapInArrow(
        run, "part int, doc_id bigint, salt bigint, n bigint, ids binary"
    )


# Store.

STORE_SCHEMA = (
    "part int, block int, width int, n_ids bigint, doc_ids array<bigint>, low_bits int, "
    "low binary, high binary, samples array<int>, ids binary"
)


def _blocks(width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    names = [f.split()[0] for f in STORE_SCHEMA.split(", ")]

    def block(part: int, number: int, rows: list[tuple]) -> pa.RecordBatch:
        ef = EliasFano.of(np.cumsum([n for _, n, _ in rows]))
        data = b"".join([ids for _, _, ids in rows])
        values = [part, number, width, len(data) // width, [d for d, _, _ in rows], ef.low_bits, ef.low, ef.high, ef.samples, data]
        kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.int32()), pa.binary()]
        return pa.record_batch([pa.array([v], k) for v, k in zip(values, kinds)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, rows, held = None, 0, [], 0
        for b in batches:
            blobs = b["ids"]
            narrow = zip(*[b[c].to_pylist() for c in ("part", "doc_id", "n")])
            for i, (p, d, n) in enumerate(narrow):
                if rows and (p != part or held + n > BLOCK_IDS):
                    yield block(part, number, rows)
                    number, rows, held = number + 1, [], 0
                if p != part:
                    part, number = p, 0
                rows.append((d, n, blobs[i].as_py()))
                held += n
        if rows:
            yield block(part, number, rows)

    return run


def write_store(docs: DataFrame, path: str, folder: str, *, end_id: int = END_ID) -> str:
    """Encode (doc_id, text) into a store at `folder`."""
    spark = docs.sparkSession
    python_tasks(spark)
    keyed = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.xxhash64("text").alias("salt")
    )
    rows = keyed.select("doc_id").count()
    parts = parts_for(spark, rows, DOCS_PER_PART)
    cuts = cut_points(keyed, "doc_id", parts, rows)
    width = encoder(path).dtype.itemsize
    (
        encoded_rows(keyed, path, cuts, end_id)
        .repartition(parts, "part")
        .sortWithinPartitions("part", "doc_id", "salt")
        .mapInArrow(_blocks(width), STORE_SCHEMA)
        .write.parquet(folder)
    )
    return folder


def read_store(spark, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, width, ids) of every document of a store.

    start counts the ids of all documents before it; ids are the stored bytes.
    """
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]

    def rows(part: dict, starts: np.ndarray, ends: np.ndarray) -> list:
        size = part["width"]
        cut = [part["ids"][s * size : e * size] for s, e in zip(starts, ends)]
        return [part["doc_ids"], part["first"] + starts, ends - starts, [size] * len(cut), cut]

    return _located(spark, folder).mapInArrow(
        _documents(rows, kinds, ["doc_id", "start", "n_tokens", "width", "ids"]),
        "doc_id bigint, start bigint, n_tokens bigint, width int, ids binary",
    )


def read_sums(spark, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32): the CRC-32 of the ids as 32-bit integers."""
    kinds = [pa.int64()] * 4

    def rows(part: dict, starts: np.ndarray, ends: np.ndarray) -> list:
        ids = np.frombuffer(part["ids"], f"<u{part['width']}")
        sums = [zlib.crc32(ids[s:e].astype("<u4").tobytes()) for s, e in zip(starts, ends)]
        return [part["doc_ids"], part["first"] + starts, ends - starts, sums]

    return _located(spark, folder).mapInArrow(
        _documents(rows, kinds, ["doc_id", "start", "n_tokens", "ids_crc32"]),
        "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint",
    )


def look_up(spark, folder: str, wanted: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, width, ids) of the documents whose doc_id is in `wanted`.

    Only blocks that hold one are read, and in them only the wanted boundaries are selected.
    """
    blocks = spark.read.schema(STORE_SCHEMA).parquet(folder)
    index = blocks.select("part", "block", F.posexplode("doc_ids").alias("at", "doc_id"))
    named = index.join(wanted.select("doc_id").filter("doc_id is not null").distinct(), "doc_id", "left_semi")
    places = named.groupBy("part", "block").agg(F.sort_array(F.collect_list("at")).alias("places"))
    found = _located(spark, folder).join(small_side(places, places.count()), ["part", "block"])
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
    names = ["doc_id", "start", "n_tokens", "width", "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(len(b)):
                part = {f: b[f][i].as_py() for f in b.schema.names}
                ef = EliasFano(len(part["doc_ids"]), part["low_bits"], part["low"], part["high"], part["samples"])
                size, rows = part["width"], []
                for k in part["places"]:
                    start, end = ef.select(k - 1) if k else 0, ef.select(k)
                    rows.append((part["doc_ids"][k], part["first"] + start, end - start, size, part["ids"][start * size : end * size]))
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

    return found.mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, width int, ids binary")


def _located(spark, folder: str) -> DataFrame:
    """The blocks with `first`, the ids before each.

    Blocks are summed inside their part, parts (at most MOST_PARTS) among each other.
    """
    python_tasks(spark)
    blocks = spark.read.schema(STORE_SCHEMA).parquet(folder)
    sizes = blocks.select("part", "block", "n_ids")
    before = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inner = sizes.select("part", "block", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("first"))
    base, total = [], 0
    for row in sorted(sizes.groupBy("part").agg(F.sum("n_ids")).limit(MOST_PARTS).collect()):
        base.append((row[0], total))
        total += row[1]
    bases = F.broadcast(spark.createDataFrame(base, "part int, base bigint"))
    firsts = inner.join(bases, "part").select("part", "block", (F.col("first") + F.col("base")).alias("first"))
    return blocks.join(small_side(firsts, firsts.count()), ["part", "block"])


def _documents(rows: Callable, kinds: list, names: list[str]):
    """Select each document's boundaries in its block and turn the block into rows of documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(len(b)):
                part = {f: b[f][i].as_py() for f in b.schema.names}
                ef = EliasFano(len(part["doc_ids"]), part["low_bits"], part["low"], part["high"], part["samples"])
                ends = np.array([ef.select(k) for k in range(ef.n)], dtype=np.int64)
                starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
                columns = rows(part, starts, ends)
                yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return run


def stored_tokens(docs: DataFrame, path: str, folder: str | None = None) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, read from a new store."""
    spark = docs.sparkSession
    return read_sums(spark, write_store(docs, path, folder or shared_dir(spark, "token-store")))
