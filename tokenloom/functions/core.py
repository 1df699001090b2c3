"""Small building blocks for column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with `value` computed once per row.

    An expression written inside a lambda is evaluated once per element; binding it
    to a lambda variable first keeps array expressions linear in the array length.
    """
    return F.transform(F.array(value), body).getItem(0)


def int_div(value: Column, divisor: Column | int) -> Column:
    """Integral division of longs (`/` would go through double)."""
    divisor = divisor if isinstance(divisor, Column) else F.lit(divisor)
    return F.call_function("div", value, divisor)


def hashed_uniform(*parts: Column | str | int) -> Column:
    """A repeatable uniform draw in [0, 1) from the md5 of `a:b:c`."""
    return hashed_bits(*parts).cast("double") / F.lit(float(1 << 52))


def hashed_bits(*parts: Column | str | int) -> Column:
    """52 repeatable random bits as a bigint (13 hex digits, exact in a double)."""
    columns = [p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    digest = F.md5(F.concat_ws(":", *columns))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint")
