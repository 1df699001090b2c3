"""Zip archives."""

from __future__ import annotations

import posixpath
import uuid
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tokenloom.session import shared_dir
from tokenloom.sources.files import few_listing_tasks, join, publish, resolve

PART_BYTES = 8 << 20
ROWS_PER_FRAME = 1000
# Neighbouring members stay together up to this size, so that not every task opens every
# archive; a larger member is a run of its own. Opening a member counts as so many bytes.
RUN_BYTES = 64 << 20
MEMBER_BYTES = 1 << 16
LEAST_TASKS = 16
# A task streams its members, so more of them need no more memory; shuffles of names stay small.
MOST_TASKS = 1 << 12

_MEMBERS = "zip_path string, ordinal int, member string, n_bytes bigint"
_LISTED = _MEMBERS + ", name string, run int, weight bigint"


def list_members(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(zip_path, ordinal, member, n_bytes) of every archive entry. Only the archives'
    directories are read."""
    return _listed(spark, paths).select("zip_path", "ordinal", "member", "n_bytes")


def _runs(weights: list[int]) -> list[int]:
    """A run number per member: neighbours up to RUN_BYTES together, larger ones alone."""
    runs, number, held = [], 0, 0
    for weight in weights:
        if held and held + weight > RUN_BYTES:
            number, held = number + 1, 0
        runs.append(number)
        held += weight
    return runs


def _listed(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """The entries with their normalised name, run and weight."""

    columns = ["zip_path", "ordinal", "member", "n_bytes", "name", "run", "weight"]

    def entries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ready = []
            for path in batch["zip_path"]:
                filesystem, name = resolve(path)
                with filesystem.open_input_file(name) as file, zipfile.ZipFile(file) as archive:
                    infos = archive.infolist()
                weights = [info.file_size + MEMBER_BYTES for info in infos]
                for i, (info, run) in enumerate(zip(infos, _runs(weights))):
                    own = posixpath.normpath(info.filename)
                    ready.append((path, i, info.filename, info.file_size, own, run, weights[i]))
                if len(ready) >= ROWS_PER_FRAME:
                    yield pd.DataFrame(ready, columns=columns)
                    ready = []
            if ready:
                yield pd.DataFrame(ready, columns=columns)

    with few_listing_tasks(spark):
        found = spark.read.format("binaryFile").load(paths)
    return found.select(F.col("_metadata.file_path").alias("zip_path")).mapInPandas(entries, _LISTED)


def _stored_listing(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """The listing written once, for plans that look at it several times."""
    folder = shared_dir(spark, "listing")
    _listed(spark, paths).write.parquet(folder)
    return spark.read.schema(_LISTED).parquet(folder)


def read_members(
    spark: SparkSession, paths: str | list[str], *, part_bytes: int = PART_BYTES
) -> DataFrame:
    """(zip_path, ordinal, member, part, content): the bytes of every file in the archives.

    Runs of members, not archives, are spread over tasks, so one large archive is read in
    parallel; a large member is streamed in parts of at most `part_bytes`.
    """

    columns = ["zip_path", "ordinal", "member", "part", "content"]

    def contents(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ready, held = [], 0
        for row, archive, info in _opened(batches):
            with archive.open(info) as stream:
                part, block = 0, stream.read(part_bytes)
                while part == 0 or block:
                    ready.append((row.zip_path, row.ordinal, row.member, part, block))
                    held += len(block)
                    if held >= part_bytes or len(ready) >= ROWS_PER_FRAME:
                        yield pd.DataFrame(ready, columns=columns)
                        ready, held = [], 0
                    part, block = part + 1, stream.read(part_bytes)
        if ready:
            yield pd.DataFrame(ready, columns=columns)

    return _spread(_stored_listing(spark, paths)).mapInPandas(
        contents, "zip_path string, ordinal int, member string, part int, content binary"
    )


def unzip_files(spark: SparkSession, paths: str | list[str], dir_save: str) -> DataFrame:
    """Extract every member below `dir_save` and return (zip_path, ordinal, member, n_bytes).

    Two entries with one name, or a name that leaves `dir_save`, fail the job. A file
    appears under its final name only when complete, so lost tasks may be repeated.
    """
    members = _stored_listing(spark, paths).filter(~F.col("member").endswith("/"))
    clash = members.groupBy("name").count().filter("count > 1").first()
    if clash is not None:
        raise ValueError(f"{clash['count']} archive entries are named {clash['name']!r}")

    columns = ["zip_path", "ordinal", "member", "n_bytes"]

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        filesystem, root = resolve(dir_save)
        written, made = [], set()
        for row, archive, info in _opened(batches):
            name = posixpath.normpath(row.member)
            if name.startswith(("/", "..")):
                raise ValueError(f"archive entry {row.member!r} leaves the target folder")
            final = join(root, name)
            folder = posixpath.dirname(final)
            if folder not in made:
                filesystem.create_dir(folder, recursive=True)
                made.add(folder)
            temporary = f"{final}.{uuid.uuid4().hex}.tmp"
            with archive.open(info) as stream, filesystem.open_output_stream(temporary) as out:
                while block := stream.read(PART_BYTES):
                    out.write(block)
            publish(filesystem, temporary, final)
            written.append(row[:4])
            if len(written) >= ROWS_PER_FRAME:
                yield pd.DataFrame(written, columns=columns)
                written = []
        if written:
            yield pd.DataFrame(written, columns=columns)

    listing = shared_dir(spark, "unzipped")
    _spread(members).mapInPandas(extract, _MEMBERS).write.parquet(listing)
    return spark.read.parquet(listing)


def read_extracted(files: DataFrame, dir_save: str) -> DataFrame:
    """Add `content`: the bytes of the file that `unzip_files` put below `dir_save`, for the rows it gave.

    Tasks open the files by name, so no folder of them is listed on the driver. A missing file is
    an error. A file is a row and is held whole.
    """

    columns = [*files.columns, "content"]

    def contents(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        filesystem, root = resolve(dir_save)
        ready, held = [], 0
        for batch in batches:
            for row, member in zip(batch.itertuples(index=False, name=None), batch["member"]):
                with filesystem.open_input_stream(join(root, posixpath.normpath(member))) as file:
                    block = file.read()
                ready.append((*row, block))
                held += len(block)
                if held >= PART_BYTES or len(ready) >= ROWS_PER_FRAME:
                    yield pd.DataFrame(ready, columns=columns)
                    ready, held = [], 0
        if ready:
            yield pd.DataFrame(ready, columns=columns)

    spread = files.repartition(_tasks(files.agg(F.sum(F.col("n_bytes") + F.lit(MEMBER_BYTES))).first()[0] or 0), "member")
    return spread.mapInPandas(contents, T.StructType([*files.schema, T.StructField("content", T.BinaryType())]))


def _tasks(total: int) -> int:
    return max(min(-(-total // RUN_BYTES), MOST_TASKS), min(total // MEMBER_BYTES, LEAST_TASKS), 1)


def _spread(members: DataFrame) -> DataFrame:
    """Runs over a number of tasks that follows from the bytes; it is given, so adaptive
    execution does not merge what is a small table of names but much work."""
    total = members.agg(F.sum("weight")).first()[0] or 0
    return members.repartition(_tasks(total), "zip_path", "run")


def _opened(batches: Iterator[pd.DataFrame]):
    """(row, archive, entry) for every member row, opening each archive once per batch."""
    for batch in batches:
        for path, rows in batch.groupby("zip_path", sort=False):
            filesystem, name = resolve(path)
            with filesystem.open_input_file(name) as file, zipfile.ZipFile(file) as archive:
                infos = archive.infolist()
                for row in rows.itertuples(index=False):
                    yield row, archive, infos[row.ordinal]
