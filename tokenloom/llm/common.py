"""Helpers of the training-data operators: stored intermediates, cut points, byte helpers."""

from __future__ import annotations

import sys
from bisect import bisect_right
from collections import Counter
from collections.abc import Callable
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.session import shared_dir

# The most sampled rows a driver ever holds to choose cut points, and the most parts.
CUT_SAMPLE = 1 << 16
MOST_PARTS = 1 << 12
# Rows of narrow keys up to which a side is broadcast; larger sides are shuffled.
BROADCAST_ROWS = 1 << 20
# Keys that are broadcast because each holds that share of all rows.
HOT_KEYS = 1 << 12


# Models and tables that a worker process keeps.
KEPT = 2
# Bytes of rows that Spark hands to a Python task at once.
ARROW_BYTES = 4 << 20


def python_tasks(spark: SparkSession) -> None:
    """Prepare the session for tasks that run Python code on texts.

    Arrow batches are kept at ARROW_BYTES (or one longer row): Spark's own bound is 64 MB,
    and its buffers on both sides of the pipe are a multiple of that.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


def kept(key: tuple, make: Callable[[], Any]) -> Any:
    """`make()`, or what it gave to an earlier task of this worker process.

    Functions travel to the workers by value, so their modules keep nothing from task to task.
    At most KEPT things are kept.
    """
    things = sys.__dict__.setdefault("_tokenloom_kept", {})
    if key not in things:
        while len(things) >= KEPT:
            things.pop(next(iter(things)))
            pa.default_memory_pool().release_unused()
        things[key] = make()
    return things[key]


def stored(df: DataFrame, label: str) -> DataFrame:
    """`df` written to the shared folder and read back, which cuts its lineage."""
    path = shared_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def free_names(df: DataFrame, *names: str) -> list[str]:
    """`names`, each with as many underscores in front as no column of `df` has."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
    return out


def small_side(df: DataFrame, rows: int) -> DataFrame:
    """`df` marked for broadcast when its counted `rows` are within the bound."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def join_uneven(left: DataFrame, right: DataFrame, key: str | list[str], weight: str, rows: int) -> DataFrame:
    """`left` joined with `right`, unique by `key`, where a key may hold any share of left's `rows`.

    `weight` is a key's number of rows in `left`. Keys with a HOT_KEYS-th of them or more, so at
    most HOT_KEYS, are broadcast; the others' rows are shuffled.
    """
    keys = [key] if isinstance(key, str) else key
    most = F.col(weight) * HOT_KEYS >= F.lit(rows)
    others = [c for c in right.columns if c not in keys]
    hot = right.filter(most).select(*keys, F.struct(*others).alias("__hot"))
    tagged = left.join(F.broadcast(hot), keys, "left")
    heavy = tagged.filter("__hot is not null").select(*left.columns, "__hot.*")
    light = tagged.filter("__hot is null").drop("__hot").join(right.filter(~most), keys)
    return heavy.unionByName(light.select(*heavy.columns))


def unsigned_share(key: Column) -> Column:
    """A uniform number in [0, 1) from a 64-bit hash."""
    return F.shiftrightunsigned(key, 11).cast("double") / F.lit(float(1 << 53))


def parts_for(spark: SparkSession, rows: int, rows_per_part: int) -> int:
    """Parts of about `rows_per_part` rows, at least one per shuffle partition."""
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(1, min(MOST_PARTS, max(least, -(-rows // rows_per_part))))


def cut_points(df: DataFrame, key: str, parts: int, rows: int) -> list[tuple]:
    """At most parts - 1 ascending (key, salt) pairs that divide `df` about evenly.

    They come from a sample of about 16 rows per part, never more than CUT_SAMPLE expected. A
    key that spans several cuts is divided evenly over the range of a 64-bit hash, the salt.
    """
    want = min(CUT_SAMPLE, 16 * parts)
    picked = df.select(key).dropna()
    if want < rows:
        picked = picked.sample(want / rows, seed=7)
    sample = sorted(r[0] for r in picked.collect())
    if not sample:
        return []
    chosen = Counter(sample[len(sample) * i // parts] for i in range(1, parts))
    return [
        (value, -(1 << 63) + (1 << 64) * (j + 1) // (n + 1))
        for value, n in sorted(chosen.items())
        for j in range(n)
    ]


def part_of(cuts: list[tuple], key, salt) -> int:
    """Number of cuts at or below (key, salt); a null key goes first."""
    return 0 if key is None else bisect_right(cuts, (key, salt))
