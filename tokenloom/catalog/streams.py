"""Streaming queries: the run log of `events` replayed as several micro-batches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from tokenloom.catalog.registry import query
from tokenloom.catalog.runlog import (
    LOG_INTERVAL,
    LOG_SQL,
    MFU_SQL,
    MODEL,
    PASSES,
    SHAPE,
    eval_log,
)
from tokenloom.functions.training import model_flops_utilisation, parameter_count
from tokenloom.session import shared_dir
from tokenloom.streaming.runlog import live_best, live_tracking
from tokenloom.streaming.sinks import latest_rows, start_batches

REPLAYS = 3


def replay(spark: SparkSession, sf_dir: str, start: Callable[[DataFrame], StreamingQuery]) -> None:
    """Run a stream over the log, which arrives in REPLAYS time slices.

    `start` starts the query on one checkpoint; each run takes what has arrived since.
    """
    path = shared_dir(spark, "replay")
    log = eval_log(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp"))
    log = log.withColumn("run_id", F.col("run_id").cast("string"))
    low, high = log.agg(F.min(F.unix_micros("ts")), F.max(F.unix_micros("ts"))).first()
    width = (high - low) // REPLAYS + 1
    for part in range(REPLAYS):
        begin = low + part * width
        slice_ = F.unix_micros("ts").between(begin, begin + width - 1)
        log.filter(slice_).write.mode("append").parquet(path)
        start(spark.readStream.schema(log.schema).parquet(path)).awaitTermination()


@query(
    "stream_run_best",
    LOG_SQL
    + """
SELECT run_id::VARCHAR AS run_id, min(val_loss) AS best_val_loss,
       arg_min(iter, {'v': val_loss, 'i': iter}) AS best_iter
FROM log GROUP BY run_id""",
)
def stream_run_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, state = shared_dir(spark, "best"), shared_dir(spark, "best-state")
    replay(spark, sf_dir, lambda log: start_batches(live_best(log), out, state, mode="update"))
    return latest_rows(spark, out, "run_id")


@query(
    "stream_ema",
    MFU_SQL
    + """
, prior AS (
  SELECT run_id, iter, val_loss, coalesce(min(val_loss) OVER (PARTITION BY run_id ORDER BY iter
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 1e9::DOUBLE) AS best
  FROM log
), logged AS (SELECT * FROM used WHERE iter % 10 = 0), folded AS (
  SELECT a.run_id, a.iter,
         list_reduce(list(b.mfu * 1000 ORDER BY b.iter) FILTER (WHERE b.iter >= 5),
                     lambda e, m: 0.9::DOUBLE * e + 0.1::DOUBLE * m) AS running
  FROM used a JOIN logged b ON a.run_id = b.run_id AND b.iter <= a.iter
  GROUP BY a.run_id, a.iter
)
SELECT run_id::VARCHAR AS run_id, iter, val_loss, least(best, val_loss) AS best_val_loss,
       val_loss < best AND iter > 0 AS is_new_best, seconds, round(mfu * 1000, 6) AS mfu,
       round(coalesce(running, -1), 6) AS running, rejected
FROM prior JOIN used USING (run_id, iter) JOIN folded USING (run_id, iter)
JOIN (SELECT run_id, (count(*) - count(DISTINCT iter))::BIGINT AS rejected FROM log GROUP BY run_id) USING (run_id)""",
)
def stream_ema(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, state = shared_dir(spark, "tracking"), shared_dir(spark, "tracking-state")
    one_second = model_flops_utilisation(
        F.lit(1.0), parameters=parameter_count(**MODEL), passes=PASSES, **SHAPE
    )

    def start(log: DataFrame) -> StreamingQuery:
        tracked = live_tracking(log.withColumn("work", one_second * 1000), log_interval=LOG_INTERVAL)
        return start_batches(tracked, out, state, mode="append")

    replay(spark, sf_dir, start)
    rows = spark.read.parquet(out).drop("batch_id")
    return rows.withColumn("mfu", F.round("mfu", 6)).withColumn("running", F.round("running", 6))
