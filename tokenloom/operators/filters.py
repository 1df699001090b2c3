"""Row filters."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.functions.text import contains_word


def remove_rows(df: DataFrame, column: str, words: Iterable[str]) -> DataFrame:
    """Drop rows whose `column` matches any of `words` (regexes, case ignored).

    Rows with a null in `column` are kept. Each word is its own filter, so groups and
    flags of one pattern cannot disturb another.
    """
    for word in words:
        df = df.filter(~contains_word(F.col(column), word))
    return df


def every_n(iteration: Column, n: int) -> Column:
    return iteration % n == 0


def until_last(iteration: Column, max_iters: int) -> Column:
    """Iterations 0 to `max_iters`, both included."""
    return iteration <= max_iters


def quick_test(log: DataFrame) -> DataFrame:
    """Only the evaluation at iteration 0."""
    return log.filter(F.col("iter") == 0)
