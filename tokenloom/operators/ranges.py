"""Positions in a total order by totals of range partitions.

Rows are divided by Spark's range partitioner, which looks at their keys only by order: keys may be
sparse, skewed or composite. The divided narrow rows are stored with the number of their
range, so every later pass sees the same ranges. Totals per range are summed along the
order (a row per range), and inside a range a window holds its rows alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tokenloom.session import shared_dir

ROWS_PER_RANGE = 1 << 20


def store_ranges(df: DataFrame, order: Sequence[str], *, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """`df` stored with `part`, the number of a row's range by `order`; nulls come first."""
    spark = df.sparkSession
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = max(least, -(-df.count() // rows_per_range))
    folder = shared_dir(spark, "ranges")
    ranged = df.repartitionByRange(parts, *[F.asc_nulls_first(c) for c in order])
    numbered = ranged.withColumn("part", F.spark_partition_id())
    numbered.write.parquet(folder)
    return spark.read.schema(numbered.schema).parquet(folder)


def sum_before(ranged: DataFrame, *, partition: Sequence[str], order: Sequence[str], value: str, out: str) -> DataFrame:
    """Add `out`: the sum of `value` over all rows of the same partition before a row.

    `ranged` comes from store_ranges over [*partition, *order], which must be unique.
    """
    groups = ["part", *partition]
    totals = ranged.groupBy(*groups).agg(F.sum(value).alias("__total"))
    along = Window.partitionBy(*partition).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # A row for every range and every partition that begins in it: few beside the rows themselves.
    bases = totals.select(*groups, F.coalesce(F.sum("__total").over(along), F.lit(0).cast("bigint")).alias("__base"))
    inside = Window.partitionBy(*groups).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inner = F.coalesce(F.sum(value).over(inside), F.lit(0).cast("bigint"))
    placed = ranged.withColumn("__inner", inner).join(F.broadcast(bases), groups)
    return placed.select(*ranged.columns, (F.col("__base") + F.col("__inner")).alias(out))
