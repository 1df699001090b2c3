"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


# Bytes of rows that Spark hands to a Python task at once.
ARROW_BYTES = 4 << 20


def build_session(app: str = "tokenloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators assume; `conf` keys use `__` for `.`."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            builder = builder.config("spark.driver.host", "127.0.0.1").config(
                "spark.driver.bindAddress", "127.0.0.1"
            )
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    }
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def bound_batches(spark: SparkSession) -> None:
    """Arrow batches of ARROW_BYTES (or one longer row) in this session.

    Spark's own bounds, 64 MB and 10,000 rows, are reached only by large tasks; Python holds each
    batch several times over, as text, code points and ids.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


def shared_dir(spark: SparkSession, label: str) -> str:
    """A new folder name that driver and executors can all reach.

    The cluster names the shared parent in `spark.checkpoint.dir`. Only a local session
    (tests) that leaves it unset uses a temporary folder of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="tokenloom-")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
