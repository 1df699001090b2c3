"""Access to files from tasks, on any file system pyarrow can reach."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from urllib.parse import unquote, urlparse

from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql import functions as F


LISTING_TASKS = 64


def resolve(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path for a plain path or a URI as Spark prints it."""
    scheme = urlparse(path).scheme
    if scheme in ("", "file"):
        return fs.LocalFileSystem(), unquote(urlparse(path).path) if scheme else path
    return fs.FileSystem.from_uri(path)


def join(folder: str, *names: str) -> str:
    return "/".join([folder.rstrip("/"), *names])


@contextmanager
def few_listing_tasks(spark: SparkSession) -> Iterator[None]:
    """Frames loaded inside list their files in LISTING_TASKS tasks at most; Spark's own way is a
    task for each path that a glob stands for, up to 10,000."""
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(int(before), LISTING_TASKS)))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def list_files(spark: SparkSession, paths: str | list[str]) -> list[tuple[str, int]]:
    """(path, length) of every file behind paths, folders or globs, sorted by path.

    This is the listing Spark keeps on the driver for any file scan; no content is read.
    """
    with few_listing_tasks(spark):
        found = spark.read.format("binaryFile").load(paths)
    rows = found.select(F.col("_metadata.file_path"), F.col("length")).collect()
    return sorted((row[0], row[1]) for row in rows)


def publish(filesystem: fs.FileSystem, temporary: str, final: str) -> None:
    """Put a finished file in place; repeating it after a retry is harmless.

    Some file systems do not rename onto an existing file, so what an earlier attempt left
    there is removed first.
    """
    if filesystem.get_file_info(final).type == fs.FileType.File:
        filesystem.delete_file(final)
    filesystem.move(temporary, final)


def refuse_existing(folder: str) -> None:
    """An error if the folder holds anything."""
    filesystem, path = resolve(folder)
    if filesystem.get_file_info(fs.FileSelector(path, allow_not_found=True)):
        raise FileExistsError(f"{folder} is not empty")
