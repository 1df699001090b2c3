"""Running aggregates over a total order, without an unbounded window.

A plain running window puts one whole partition (or the whole table, when there is
no partition key) into one task. Here the order key is cut into buckets of `fanout`
consecutive values. Totals per bucket are aggregated first and scanned by the same
method; each bucket's result so far then joins the bucket as one more row in front, so
the rows themselves are shuffled once and no join is needed. A window holds at most
`fanout` rows and that one, because (partition, key) is unique. The bucketing depends on
key values only, so a retried task sees the same buckets.

The input is read twice (totals, rows): store it first if it is expensive.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

NARROW_FANOUT = 1 << 16
WIDE_FANOUT = 1 << 10


def key_bounds(df: DataFrame, key: str) -> tuple[int, int]:
    """Smallest and largest order key, (0, 0) for an empty table."""
    low, high = df.agg(F.min(key), F.max(key)).first()
    return (0, 0) if low is None else (low, high)


def bucket_of(key: str, low: int, fanout: int) -> Column:
    return F.shiftright(F.col(key).cast("bigint") - F.lit(low), fanout.bit_length() - 1)


_AGGREGATE = {"sum": F.sum, "min": F.min, "max": F.max}


def exclusive_prefix(
    df: DataFrame,
    *,
    partition: Sequence[str],
    key: str,
    value: str,
    how: str,
    out: str,
    fanout: int = NARROW_FANOUT,
    bounds: tuple[int, int] | None = None,
) -> DataFrame:
    """Add `out`: the `how` ("sum", "min" or "max") of `value` over all rows of the same
    partition with a smaller `key`; null where there is none.

    (partition, key) must be unique. `bounds` may give a range known to hold every
    key, which saves the pass that looks it up. With how="max" and a struct that
    starts with the key, the result is the previous row (a scalable `lag`).
    """
    if fanout < 2 or fanout & (fanout - 1):
        raise ValueError("fanout must be a power of two")
    bounds = bounds if bounds is not None else key_bounds(df, key)
    return _scan(df, list(partition), key, value, how, out, fanout, bounds)


def _scan(
    df: DataFrame,
    partition: list[str],
    key: str,
    value: str,
    how: str,
    out: str,
    fanout: int,
    bounds: tuple[int, int],
) -> DataFrame:
    aggregate = _AGGREGATE[how]
    low, high = bounds
    if high - low < fanout:
        window = Window.partitionBy(*partition).orderBy(key).rowsBetween(
            Window.unboundedPreceding, -1
        )
        return df.withColumn(out, aggregate(value).over(window))

    bucket, before, first = (f"__{key}_{part}" for part in ("bucket", "before", "first"))
    groups = [*partition, bucket]
    bucketed = df.withColumn(bucket, bucket_of(key, low, fanout))
    totals = bucketed.groupBy(*groups).agg(aggregate(value).alias(value))
    fronts = (
        _scan(totals, partition, bucket, value, how, before, fanout, (0, (high - low) // fanout))
        .filter(F.col(before).isNotNull())
        .select(*groups, F.col(before).alias(value), F.lit(True).alias(first))
    )
    rows = bucketed.withColumn(first, F.lit(False)).unionByName(fronts, allowMissingColumns=True)
    window = (
        Window.partitionBy(*groups)
        .orderBy(F.desc(first), key)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        rows.withColumn(out, aggregate(value).over(window))
        .filter(~F.col(first))
        .select(*df.columns, out)
    )
