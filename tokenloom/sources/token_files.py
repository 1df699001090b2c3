"""Token ids in flat little-endian unsigned 16-bit files, as a data source.

A token stream is one file, or a folder with a manifest: the name, the position of the first id,
the number of ids and the CRC-32 of every file. Tasks write files under names of their own attempt and
the manifest is put in place last, by one rename, so it is the commit: a folder without one
holds no stream, files that it does not name are left-overs of failed attempts, and a listed file that is
missing, cut short or changed is an error, not a shorter stream.
"""

from __future__ import annotations

import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    InputPartition,
    WriterCommitMessage,
)

from tokenloom.sources.files import join, publish, resolve

SUFFIX = ".bin"
MANIFEST = "_manifest.parquet"
MANIFEST_FIELDS = ["name", "first", "ids", "crc"]
ID_BYTES = 2
BATCH_IDS = 1 << 20


@dataclass
class TokenRange(InputPartition):
    first_chunk: int
    start: int
    stop: int
    # (path, first position in the stream, ids in the file, CRC-32 where it is known)
    files: list[tuple[str, int, int, int | None]]


@dataclass
class WrittenFiles(WriterCommitMessage):
    # (name, first position, ids, CRC-32)
    files: list[tuple[str, int, int, int]]


class TokenFileSource(DataSource):
    """Options: `path`, `chunk_size` (ids per row), `range_ids` (ids per task)."""

    @classmethod
    def name(cls) -> str:
        return "token_file"

    def schema(self) -> str:
        return "chunk_id bigint, tokens array<int>"

    def reader(self, schema) -> DataSourceReader:
        return TokenFileReader(self.options)

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return TokenFileWriter(self.options)


class TokenFileReader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"]
        self.chunk_size = int(options["chunk_size"])
        wanted = int(options.get("range_ids", 16 << 20))
        self.range_ids = max(wanted // self.chunk_size, 1) * self.chunk_size

    def partitions(self) -> list[TokenRange]:
        files = stream_files(self.path)
        total = files[-1][1] + files[-1][2] if files else 0
        firsts = [f[1] for f in files]
        ranges = []
        for start in range(0, total, self.range_ids):
            stop = min(start + self.range_ids, total)
            inside = files[bisect_right(firsts, start) - 1 : bisect_left(firsts, stop)]
            ranges.append(TokenRange(start // self.chunk_size, start, stop, inside))
        return ranges

    def read(self, part: TokenRange) -> Iterator[pa.RecordBatch]:
        filesystem, _ = resolve(self.path)
        step = max(BATCH_IDS // self.chunk_size, 1) * self.chunk_size
        chunk = part.first_chunk
        for start in range(part.start, part.stop, step):
            ids = _read_ids(filesystem, part.files, start, min(start + step, part.stop))
            borders = np.append(np.arange(0, len(ids), self.chunk_size), len(ids)).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(borders), pa.array(ids.astype(np.int32)))
            numbers = pa.array(np.arange(chunk, chunk + len(lists), dtype=np.int64))
            yield pa.RecordBatch.from_arrays([numbers, lists], names=["chunk_id", "tokens"])
            chunk += len(lists)


def stream_files(location: str) -> list[tuple[str, int, int, int | None]]:
    """(path, first position, ids, CRC-32) of a stream's files in order, all of them there in full."""
    filesystem, path = resolve(location)
    info = filesystem.get_file_info(path)
    if info.type == fs.FileType.File:
        if info.size % ID_BYTES:
            raise ValueError(f"{path} does not hold whole 16-bit ids")
        return [(path, 0, info.size // ID_BYTES, None)] if info.size else []
    if info.type != fs.FileType.Directory:
        raise FileNotFoundError(location)
    if filesystem.get_file_info(join(path, MANIFEST)).type != fs.FileType.File:
        raise FileNotFoundError(f"{location} has no manifest: no write to it was completed")
    with filesystem.open_input_file(join(path, MANIFEST)) as file:
        rows = zip(*[c.to_pylist() for c in pq.read_table(file, columns=MANIFEST_FIELDS).columns])
    listed = [(join(path, name), *rest) for name, *rest in rows]
    sizes = {i.path: i.size for i in filesystem.get_file_info(fs.FileSelector(path))}
    for name, _, ids, _ in listed:
        if sizes.get(name) != ids * ID_BYTES:
            raise ValueError(f"{name} should hold {ids} ids, but has {sizes.get(name, 'no')} bytes")
    return listed


def _read_ids(
    filesystem: fs.FileSystem, files: list[tuple[str, int, int, int | None]], start: int, stop: int
) -> np.ndarray:
    pieces = []
    for path, first, count, crc in files:
        low, high = max(start - first, 0), min(stop - first, count)
        if low < high:
            with filesystem.open_input_file(path) as file:
                file.seek(low * ID_BYTES)
                data = file.read((high - low) * ID_BYTES)
            if len(data) != (high - low) * ID_BYTES or (high - low == count and crc not in (None, zlib.crc32(data))):
                raise ValueError(f"{path} is not the file that the manifest names")
            pieces.append(data)
    return np.frombuffer(b"".join(pieces), dtype="<u2")


def check_token_files(spark: SparkSession, location: str) -> DataFrame:
    """(path, first, ids, intact) of every file of a stream, each read and compared with its CRC-32."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = []
            for path, ids, crc in zip(*[b[c].to_pylist() for c in ("path", "ids", "crc")]):
                filesystem, name = resolve(path)
                have, size = 0, 0
                with filesystem.open_input_file(name) as file:
                    while block := file.read(BATCH_IDS * ID_BYTES):
                        have, size = zlib.crc32(block, have), size + len(block)
                found.append(size == ids * ID_BYTES and crc in (None, have))
            columns = [b["path"], b["first"], b["ids"], pa.array(found, pa.bool_())]
            yield pa.record_batch(columns, ["path", "first", "ids", "intact"])

    files = spark.createDataFrame(stream_files(location), "path string, first bigint, ids bigint, crc bigint")
    return files.mapInArrow(check, "path string, first bigint, ids bigint, intact boolean")


class TokenFileWriter(DataSourceArrowWriter):
    """Each run of consecutive chunks in a task becomes one file, named by the position of
    its first id and by the attempt that writes it. Nothing is renamed but the manifest."""

    def __init__(self, options):
        self.path = options["path"]
        self.chunk_size = int(options["chunk_size"])

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WrittenFiles:
        filesystem, root = resolve(self.path)
        filesystem.create_dir(root, recursive=True)
        attempt = uuid.uuid4().hex
        files: list[list] = []
        out, expected = None, None
        try:
            for batch in iterator:
                chunk_ids = batch.column("chunk_id").to_numpy(zero_copy_only=False)
                lists = batch.column("tokens")
                ids = lists.flatten().to_numpy(zero_copy_only=False)
                if len(ids) and (ids.min() < 0 or ids.max() > 0xFFFF):
                    raise ValueError("token id does not fit in 16 bits")
                ids = ids.astype("<u2")
                ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))
                breaks = np.flatnonzero(np.diff(chunk_ids) != 1) + 1
                for low, high in zip([0, *breaks], [*breaks, len(chunk_ids)]):
                    if low == high:
                        continue
                    if out is None or chunk_ids[low] != expected:
                        if out is not None:
                            out.close()
                        first = int(chunk_ids[low]) * self.chunk_size
                        files.append([f"{first:018d}-{attempt}{SUFFIX}", first, 0, 0])
                        out = filesystem.open_output_stream(join(root, files[-1][0]))
                    begin = ends[low - 1] if low else 0
                    data = ids[begin : ends[high - 1]].tobytes()
                    out.write(data)
                    files[-1][2] += len(data) // ID_BYTES
                    files[-1][3] = zlib.crc32(data, files[-1][3])
                    expected = chunk_ids[high - 1] + 1
        finally:
            if out is not None:
                out.close()
        return WrittenFiles([tuple(f) for f in files])

    def commit(self, messages: list[WrittenFiles | None]) -> None:
        files = sorted((f for m in messages if m for f in m.files), key=lambda f: f[1])
        total = 0
        for name, first, ids, _ in files:
            if first != total:
                raise ValueError(f"{name} should start at id {total} of the stream")
            total += ids
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64()]
        columns = [pa.array([f[i] for f in files], k) for i, k in enumerate(kinds)]
        filesystem, root = resolve(self.path)
        filesystem.create_dir(root, recursive=True)
        temporary = join(root, f"_manifest.{uuid.uuid4().hex}")
        with filesystem.open_output_stream(temporary) as out:
            pq.write_table(pa.table(columns, MANIFEST_FIELDS), out)
        publish(filesystem, temporary, join(root, MANIFEST))

    def abort(self, messages: list[WrittenFiles | None]) -> None:
        filesystem, root = resolve(self.path)
        for message in messages:
            for name, *_ in message.files if message else ():
                filesystem.delete_file(join(root, name))


def read_token_file(
    spark: SparkSession, path: str, *, chunk_size: int, range_ids: int = 16 << 20
) -> DataFrame:
    """(chunk_id, tokens) of a token stream, one task per range of ids."""
    spark.dataSource.register(TokenFileSource)
    return (
        spark.read.format("token_file")
        .option("path", path)
        .option("chunk_size", str(chunk_size))
        .option("range_ids", str(range_ids))
        .load()
    )


def read_token_dataset(spark: SparkSession, folder: str, *, chunk_size: int) -> DataFrame:
    """(split, chunk_id, tokens) from `train` and `val` streams below one folder."""
    parts = [
        read_token_file(spark, join(folder, split), chunk_size=chunk_size).select(
            F.lit(split).alias("split"), "chunk_id", "tokens"
        )
        for split in ("train", "val")
    ]
    return parts[0].unionAll(parts[1])
