"""Running a stream to completion into a table."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def rocksdb_state(spark: SparkSession):
    """Streams started inside keep their state in RocksDB."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    spark.conf.set(key, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def start_batches(
    stream: DataFrame, path: str, checkpoint: str, *, mode: str, available_now: bool = True
) -> StreamingQuery:
    """Write every micro-batch to `path/batch_id=N`. A repeated batch replaces its own
    folder, so a restart after a failure adds nothing twice."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    with rocksdb_state(stream.sparkSession):
        return writer.foreachBatch(write).start()


def latest_rows(spark: SparkSession, path: str, key: str) -> DataFrame:
    """The newest row per key of an update-mode stream."""
    rows = spark.read.parquet(path)
    columns = [c for c in rows.columns if c not in (key, "batch_id")]
    newest = F.max_by(F.struct(*columns), "batch_id").alias("row")
    return rows.groupBy(key).agg(newest).select(key, "row.*")
