"""A data source that reads text files of any size by byte range.

Spark's text reader gives whole files (at most 2 GB each) or lines without any order.
This one plans ranges of about `range_bytes`, many small files or a part of a large one, each with the
number of its first byte, several small ones for a task where there are many, and emits (path, byte_offset, position, text), either line by line or in
pieces that may be tokenised on their own. A stretch of FORCED pieces
without any place for such a cut is cut at the next character, so that no row, and no
reading past a range, is unbounded.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tokenloom.sources.files import resolve

READ_BYTES = 4 << 20
# A range is read to its end and so many bytes further at once; the next cut mostly lies there.
READ_PAST = 1 << 16
# Starting a task costs more than reading a small range: a task takes several of them up to so
# many bytes, as long as there are so many tasks.
TASK_BYTES = 16 << 20
LEAST_TASKS = 64
# Rows and bytes of text that a task hands over at once.
BATCH_ROWS = 1 << 14
BATCH_BYTES = 4 << 20
# A forced cut ends every stretch of so many pieces that has no other.
FORCED = 8
# Bytes kept before a position, enough for the character and the line break around it.
CONTEXT = 8

# After a newline.
_LINE_END = re.compile(rb"\n")
# Between a non-whitespace character and a following newline: the only place where a
# cut cannot change how the text falls into pre-tokens.
_SAFE_CUT = re.compile(rb"[^\x00-\x20\x7f](?=\r?\n)")


@dataclass
class ByteRange:
    path: str
    start: int
    stop: int
    first: int


@dataclass
class ByteRanges(InputPartition):
    ranges: list[ByteRange]


class RangedTextSource(DataSource):
    """Options: `files` (JSON list of [path, length]), `unit` ("line" or "piece"),
    `encoding`, `errors`, `range_bytes`, `piece_bytes`, `file_bits` (a file's first position is
    its number in the list times 2 ** file_bits)."""

    @classmethod
    def name(cls) -> str:
        return "ranged_text"

    def schema(self) -> str:
        return "path string, byte_offset bigint, position bigint, text string"

    def reader(self, schema) -> DataSourceReader:
        return RangedTextReader(self.options)


class RangedTextReader(DataSourceReader):
    def __init__(self, options):
        self.files = json.loads(options["files"])
        self.unit = options.get("unit", "piece")
        self.encoding = options.get("encoding", "utf-8")
        self.errors = options.get("errors", "strict")
        self.range_bytes = int(options.get("range_bytes", 64 << 20))
        self.piece_bytes = int(options.get("piece_bytes", 1 << 20))

        self.file_bits = int(options.get("file_bits", 0))

    def partitions(self) -> list[ByteRanges]:
        planned: list[ByteRanges] = []
        room = 0
        for number, (path, length) in enumerate(self.files):
            for start in range(0, length, self.range_bytes):
                stop = min(start + self.range_bytes, length)
                if stop - start > room:
                    planned.append(ByteRanges([]))
                    room = self.range_bytes
                planned[-1].ranges.append(ByteRange(path, start, stop, number << self.file_bits))
                room -= stop - start
        together = max(min(TASK_BYTES // self.range_bytes, len(planned) // LEAST_TASKS), 1)
        return [
            ByteRanges([r for p in planned[i : i + together] for r in p.ranges])
            for i in range(0, len(planned), together)
        ]

    def read(self, part: ByteRanges) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for own in part.ranges:
            for offset, raw in self._units(own):
                text = raw.decode(self.encoding, self.errors)
                if self.unit == "line":
                    text = text.removesuffix("\n").removesuffix("\r")
                rows.append((own.path, offset, own.first + offset, text))
                held += len(raw)
                if held >= BATCH_BYTES or len(rows) >= BATCH_ROWS:
                    yield _batch(rows)
                    rows, held = [], 0
        if rows:
            yield _batch(rows)

    def _units(self, part: ByteRange) -> Iterator[tuple[int, bytes]]:
        """(offset, bytes) from the first cut at or after `start` up to the first cut at
        or after `stop`; neighbouring ranges meet at the same cut."""
        filesystem, path = resolve(part.path)
        minimum = 1 if self.unit == "line" else self.piece_bytes
        stretches = _Stretches(self.piece_bytes * FORCED, part.start) if self.unit == "piece" else None
        base = max((stretches.begin if stretches else part.start) - CONTEXT, 0)
        begin = 0 if part.start == 0 else None
        buffer, scanned = bytearray(), 0
        with filesystem.open_input_file(path) as file:
            file.seek(base)
            while block := file.read(min(max(part.stop - file.tell(), 0) + READ_PAST, READ_BYTES)):
                buffer += block
                cuts = (base + cut for cut in self._cuts(buffer, scanned))
                if stretches:
                    cuts = stretches.with_forced(cuts, buffer, base)
                for at in cuts:
                    if at < part.start or at == 0:
                        continue
                    if begin is None:
                        if at >= part.stop:
                            return
                        begin = at
                    elif at >= part.stop or at - begin >= minimum:
                        yield begin, bytes(buffer[begin - base : at - base])
                        if at >= part.stop:
                            return
                        begin = at
                done = begin - base if begin is not None else max(len(buffer) - CONTEXT, 0)
                del buffer[:done]
                base += done
                scanned = max(len(buffer) - CONTEXT // 2, 0)
        if begin is not None and buffer:
            yield begin, bytes(buffer)

    def _cuts(self, buffer: bytearray, start: int) -> Iterator[int]:
        """Cut positions in `buffer` that no later byte can change."""
        if self.unit == "line":
            for match in _LINE_END.finditer(buffer, start):
                yield match.end()
            return
        for match in _SAFE_CUT.finditer(buffer, start):
            cut = match.end()
            if buffer[cut - 1] >= 0x80:
                character = buffer[max(cut - 4, 0) : cut].decode(self.encoding, "ignore")[-1:]
                if not character or character.isspace():
                    continue
            yield cut


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
    columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
    return pa.record_batch(columns, ["path", "byte_offset", "position", "text"])


class _Stretches:
    """Fixed stretches of a file; one without a cut of its own ends in a forced one.

    Stretches lie at multiples of their size, so every range that looks at one agrees on it.
    A range begins with the stretch that holds the byte before it.
    """

    def __init__(self, size: int, start: int):
        self.size = size
        self.begin = max(start - 1, 0) // size * size
        self.cut_inside = False

    def with_forced(self, cuts: Iterator[int], buffer: bytearray, base: int) -> Iterator[int]:
        """The cuts and the forced ones in order, as far as no later byte can change them."""
        for at in cuts:
            yield from self._ended(at - 1, buffer, base)
            self.cut_inside |= at > self.begin
            yield at
        yield from self._ended(base + len(buffer) - CONTEXT, buffer, base)

    def _ended(self, position: int, buffer: bytearray, base: int) -> Iterator[int]:
        """Forced cuts of the stretches that end at or before `position`."""
        while self.begin + self.size <= position:
            self.begin += self.size
            if not self.cut_inside:
                at = self.begin
                while at - base < len(buffer) and buffer[at - base] & 0xC0 == 0x80:
                    at += 1
                yield at
            self.cut_inside = False


def read_ranged(
    spark: SparkSession, files: list[tuple[str, int]], *, unit: str, **options: object
) -> DataFrame:
    """(path, byte_offset, position, text) of `files`, given with their lengths."""
    spark.dataSource.register(RangedTextSource)
    reader = spark.read.format("ranged_text").option("files", json.dumps(files)).option("unit", unit)
    for key, value in options.items():
        reader = reader.option(key, str(value))
    return reader.load()
