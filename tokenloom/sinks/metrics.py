"""Run metrics and checkpoint records."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tokenloom.operators.runlog import checkpoints


def append_metrics(metrics: DataFrame, path: str) -> str:
    """Append evaluation rows to a run log."""
    metrics.write.mode("append").parquet(path)
    return path


def save_checkpoints(log: DataFrame, path: str, folder: str) -> str:
    """Write one record per new best; `folder` is where the runs keep their files."""
    checkpoints(log, folder).write.mode("append").parquet(path)
    return path
