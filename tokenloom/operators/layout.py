"""Input layout."""

from __future__ import annotations

from pyspark.sql import DataFrame

# Inputs below this many bytes per core are spread; the move is then always cheap.
SPREAD_BYTES_PER_CORE = 16 << 20


def spread_small(df: DataFrame, key: str) -> DataFrame:
    """Spread a small input over all cores by hash of `key`; leave a large one as it is.

    One small Parquet file is often a single row group and would be processed by a
    single task. Tables beyond the size limit already have enough scan tasks and are
    never shuffled here. `key` should be unique, so that no task gets a hot value.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(cores, key) if size < cores * SPREAD_BYTES_PER_CORE else df
