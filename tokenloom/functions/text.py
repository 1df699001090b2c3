"""String and date expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalise_newlines(text: Column) -> Column:
    return F.regexp_replace(text, "\r\n?", "\n")


def contains_word(text: Column, pattern: str) -> Column:
    """Case-insensitive regex search; a null text contains nothing."""
    return F.coalesce(text.rlike("(?iu)" + pattern), F.lit(False))


def characters(text: Column) -> Column:
    """One string per code point."""
    return F.split(text, "")


def char_slice(text: Column, start: int | Column, stop: int | Column) -> Column:
    """Zero-based half-open slice in code points, for 0 <= start <= stop."""
    start = start if isinstance(start, Column) else F.lit(start)
    stop = stop if isinstance(stop, Column) else F.lit(stop)
    return F.substring(text, start.cast("int") + 1, (stop - start).cast("int"))


def minute_stamp(ts: Column) -> Column:
    """`YYYYMMDD-HHMM`."""
    return F.date_format(ts, "yyyyMMdd-HHmm")
