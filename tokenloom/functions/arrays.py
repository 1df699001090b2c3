"""Array reshaping."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tokenloom.functions.core import let


def flatten_once(nested: Column, skip_nulls: bool = False) -> Column:
    """Join the inner arrays of one row, one level deep, order kept."""
    if skip_nulls:
        nested = F.filter(nested, lambda inner: inner.isNotNull())
    return F.flatten(nested)


def chunk_array(values: Column, size: int) -> Column:
    """Consecutive slices of `size` elements; the last may be short, an empty array has none."""
    if size < 1:
        raise ValueError("size must be at least 1")
    element = let(
        values,
        lambda a: F.when(F.size(a) == 0, F.array().cast("array<int>")).otherwise(
            F.sequence(F.lit(0), F.size(a) - 1, F.lit(size))
        ),
    )
    return let(
        values,
        lambda a: F.transform(element, lambda start: F.slice(a, start + 1, F.lit(size))),
    )


def keep_last(ids: Column, size: int) -> Column:
    """The last `size` elements (all of them if there are fewer)."""
    return let(
        ids, lambda a: F.slice(a, F.greatest(F.size(a) - size, F.lit(0)) + 1, F.lit(size))
    )


def append_id(ids: Column, next_id: Column) -> Column:
    """`ids` with one more element at the end."""
    return F.concat(ids, F.array(next_id))


def last_element(values: Column) -> Column:
    """The value at the last position."""
    return F.element_at(values, -1)
