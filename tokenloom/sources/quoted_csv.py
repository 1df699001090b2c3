"""CSV files with line breaks inside quotes, read by byte range.

A quote opens a field only where the field begins, that is after a delimiter or a line end; inside
quotes a doubled quote stands for one; a quote elsewhere is text. So only runs of an odd number of quotes
matter: one after a boundary changes between outside and inside, any other one leaves the reader
outside, whatever it was before. A byte range is therefore a function of the state it begins in,
known after one look at the range by itself, and the states of all ranges follow by composing
these functions along each file. Then every range is read from its true state.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tokenloom.session import shared_dir
from tokenloom.sources.files import list_files, resolve

RANGE_BYTES = 32 << 20
READ_BYTES = 4 << 20
# Records of about so many bytes are handed on together.
BATCH_BYTES = 4 << 20
QUOTE, NEWLINE = 0x22, 0x0A
BOM = b"\xef\xbb\xbf"

RANGES = "path string, start bigint, stop bigint"


def odd_runs(data: np.ndarray, delimiter: bytes, first: int, opens: bool) -> tuple[np.ndarray, np.ndarray]:
    """(places, whether after a boundary) of the odd runs of quotes in data[first:].

    What stands before `first` is context; `opens` says that data begins a file.
    """
    quotes = np.flatnonzero(data == QUOTE)
    begins = quotes[np.diff(quotes, prepend=-2) > 1]
    lengths = np.diff(np.append(np.searchsorted(quotes, begins), len(quotes)))
    begins = begins[(lengths % 2 == 1) & (begins >= first)]
    after = (begins > 0) & (data[begins - 1] == NEWLINE)
    if opens:
        after |= begins == (3 if data[:3].tobytes() == BOM else 0)
    match = begins >= len(delimiter)
    for i, byte in enumerate(delimiter):
        match &= data[np.maximum(begins - len(delimiter) + i, 0)] == byte
    return begins, after | match


def inside_after(boundary: np.ndarray, inside: bool) -> np.ndarray:
    """Whether the reader is inside quotes after each odd run, beginning with `inside`."""
    changes = np.cumsum(boundary)
    last = np.maximum.accumulate(np.where(boundary, -1, np.arange(len(boundary))))
    before = np.where(last >= 0, changes[last], 0)
    return (changes - before + ((last < 0) & inside)) % 2 == 1


class Blocks:
    """The bytes of a range in blocks of whole runs of quotes, each with its context before it."""

    def __init__(self, path: str, start: int, delimiter: bytes):
        self.filesystem, self.name = resolve(path)
        self.delimiter = delimiter
        self.start = start

    def __iter__(self) -> Iterator[tuple[int, np.ndarray, int]]:
        """(place of the first byte, bytes, length of the context)."""
        margin = max(len(self.delimiter), 1)
        base = max(self.start - margin, 0)
        with self.filesystem.open_input_file(self.name) as file:
            file.seek(base)
            held, context = b"", self.start - base
            while block := file.read(READ_BYTES):
                data = held + block
                body = data.rstrip(b'"') if len(data) > context else data
                if len(body) <= context:  # nothing but quotes as yet
                    held = data
                    continue
                yield base, np.frombuffer(body, np.uint8), context
                keep = min(len(body), margin)
                held = data[len(body) - keep :]
                base += len(body) - keep
                context = keep
            if len(held) > context:
                yield base, np.frombuffer(held, np.uint8), context


def range_function(path: str, start: int, stop: int, delimiter: bytes) -> tuple[bool, bool]:
    """Whether the reader is inside quotes at `stop` if it was outside, or inside, at `start`."""
    ends = np.array([False, True])
    for base, data, context in Blocks(path, start, delimiter):
        begins, boundary = odd_runs(data, delimiter, context, base == 0)
        # Runs that begin in the context, or at `stop` and after it, are other ranges' own.
        own = begins < stop - base
        boundary = boundary[own]
        if len(boundary):
            ends = np.array([inside_after(boundary, bool(e))[-1] for e in ends])
        if base + len(data) >= stop:
            break
    return bool(ends[0]), bool(ends[1])


def range_records(path: str, start: int, stop: int, delimiter: bytes, inside: bool) -> Iterator[tuple[int, bytes]]:
    """(place, bytes) of the records that begin in [start, stop), without their line ends."""
    begin = 0 if start == 0 else None
    pieces: list[bytes] = []
    for base, data, context in Blocks(path, start, delimiter):
        if base + context == start and context and data[context - 1] == NEWLINE and not inside:
            begin = start
        begins, boundary = odd_runs(data, delimiter, context, base == 0)
        states = np.concatenate([[inside], inside_after(boundary, inside)])
        ends = np.flatnonzero(data[context:] == NEWLINE) + context
        ends = ends[~states[np.searchsorted(begins, ends)].astype(bool)]
        inside = bool(states[-1])
        raw = data.tobytes()
        at = context
        for end in ends.tolist():
            if begin is not None:
                pieces.append(raw[at:end])
                yield begin, b"".join(pieces).removesuffix(b"\r")
                pieces = []
            begin, at = base + end + 1, end + 1
            if begin >= stop:
                return
        if begin is not None:
            pieces.append(raw[at:])
        elif base + len(data) >= stop:
            return
    if begin is not None and any(pieces):
        yield begin, b"".join(pieces)


def _summarise(batches: Iterator[pa.RecordBatch], delimiter: bytes) -> Iterator[pa.RecordBatch]:
    names = ["path", "start", "stop", "from_outside", "from_inside"]
    for b in batches:
        ranges = list(zip(*[c.to_pylist() for c in b.columns]))
        ends = [range_function(*r, delimiter) for r in ranges]
        columns = [*b.columns, pa.array([e[0] for e in ends], pa.bool_()), pa.array([e[1] for e in ends], pa.bool_())]
        yield pa.record_batch(columns, names)


def _read(batches: Iterator[pa.RecordBatch], delimiter: bytes, encoding: str) -> Iterator[pa.RecordBatch]:
    def batch(path: str, rows: list[tuple[int, str]]) -> pa.RecordBatch:
        places, texts = zip(*rows)
        return pa.record_batch(
            [pa.array([path] * len(rows)), pa.array(places, pa.int64()), pa.array(texts, pa.string())],
            ["path", "byte_offset", "record"],
        )

    for b in batches:
        for path, start, stop, inside in zip(*[c.to_pylist() for c in b.columns]):
            rows: list[tuple[int, str]] = []
            held = 0
            for place, data in range_records(path, start, stop, delimiter, inside):
                if place == 0 or not data:  # the header, an empty line
                    continue
                rows.append((place, data.decode(encoding)))
                held += len(data)
                if held >= BATCH_BYTES:
                    yield batch(path, rows)
                    rows, held = [], 0
            if rows:
                yield batch(path, rows)


def file_ranges(spark: SparkSession, files: list[tuple[str, int]], range_bytes: int) -> DataFrame:
    """(path, start, stop) of all ranges, about one a task, in order."""
    count = sum(-(-length // range_bytes) for _, length in files)
    listing = spark.createDataFrame([f for f in files if f[1]], "path string, length bigint")
    starts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("length") - 1, F.lit(range_bytes).cast("bigint")))
    ranges = listing.select("path", "length", starts.alias("start"))
    stop = F.least(F.col("start") + range_bytes, F.col("length"))
    return ranges.select("path", "start", stop.alias("stop")).repartitionByRange(max(1, count), "path", "start")


def start_states(summaries: DataFrame) -> DataFrame:
    """(path, start, stop, inside): the ranges with the state they begin in."""
    along = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    constant = F.col("from_outside") == F.col("from_inside")
    # The last range that ends in one state whatever came before it, and the changes since.
    fixed = summaries.withColumn("changes", (~constant & F.col("from_outside")).cast("int"))
    known = fixed.withColumn("fixed", F.when(constant, F.struct("start", F.col("from_outside").alias("ends"))))
    seen = known.withColumns({"last": F.last("fixed", ignorenulls=True).over(along), "so_far": F.sum("changes").over(along)})
    at_last = F.last(F.when(constant, F.coalesce("so_far", F.lit(0))), ignorenulls=True).over(along)
    since = F.coalesce("so_far", F.lit(0)) - F.coalesce("at_last", F.lit(0))
    inside = (since + F.coalesce(F.col("last.ends").cast("int"), F.lit(0))) % 2 == 1
    return seen.withColumn("at_last", at_last).select("path", "start", "stop", inside.alias("inside"))


def read_records(
    spark: SparkSession, paths: list[str], delimiter: str, encoding: str, range_bytes: int = RANGE_BYTES
) -> DataFrame:
    """(path, byte_offset, record) of the files' records but the first, each with its quotes.

    Tasks open the files by themselves, so paths must be ones that pyarrow reaches. A file is
    read twice: once for the summaries, which are stored, once for the records.
    """
    mark = delimiter.encode()
    ranges = file_ranges(spark, list_files(spark, paths), range_bytes)
    folder = shared_dir(spark, "quoted-ranges")
    ranges.mapInArrow(partial(_summarise, delimiter=mark), f"{RANGES}, from_outside boolean, from_inside boolean").write.parquet(folder)
    summaries = spark.read.parquet(folder)
    states = start_states(summaries)
    tasks = max(1, summaries.count())
    return states.repartitionByRange(tasks, "path", "start").mapInArrow(
        partial(_read, delimiter=mark, encoding=encoding), "path string, byte_offset bigint, record string"
    )
