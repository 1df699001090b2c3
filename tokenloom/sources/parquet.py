"""Parquet files behind a glob."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.sources.files import list_files


def read_parquets(
    spark: SparkSession, glob: str | list[str], file_column: str = "file_path"
) -> DataFrame:
    """All rows of all files, with the file each came from. Columns missing in some
    files are null there."""
    paths = [glob] if isinstance(glob, str) else glob
    return spark.read.option("mergeSchema", "true").parquet(*paths).withColumn(
        file_column, F.col("_metadata.file_path")
    )


class EachParquet(Sequence):
    """A frame per file, in file name order, made when it is asked for.

    Only the paths are held. Work that is the same for every file needs no frame of each: `rows` has
    all files in one scan with their names, to group by.
    """

    def __init__(self, spark: SparkSession, paths: list[str]):
        self.spark, self.paths = spark, paths

    def __len__(self) -> int:
        return len(self.paths)

    def __getitem__(self, index):
        if isinstance(index, slice):
            return EachParquet(self.spark, self.paths[index])
        return self.spark.read.parquet(self.paths[index])

    def rows(self, file_column: str = "file_path") -> DataFrame:
        """All rows of these files, with the file each came from."""
        return read_parquets(self.spark, self.paths, file_column)


def read_each_parquet(spark: SparkSession, glob: str) -> EachParquet:
    """One DataFrame per file, in file name order."""
    return EachParquet(spark, [path for path, _ in list_files(spark, glob)])
