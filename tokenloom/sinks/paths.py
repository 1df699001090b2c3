"""Names for outputs."""

from __future__ import annotations

import datetime


def minute_prefix(now: datetime.datetime | None = None) -> str:
    """`YYYYMMDD-HHMM`, of the current time unless one is given."""
    return (now or datetime.datetime.now()).strftime("%Y%m%d-%H%M")


def output_path(
    folder: str, name: str, timestamp: bool = True, now: datetime.datetime | None = None
) -> str:
    """`folder/name` or `folder/YYYYMMDD-HHMM_name`. Taken once per job, on the driver;
    Spark's writers create the folder."""
    if timestamp:
        name = f"{minute_prefix(now)}_{name}"
    return f"{folder.rstrip('/')}/{name}"
