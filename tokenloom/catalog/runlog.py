"""Queries over run logs: `events` as evaluations, `lineitem` as micro-steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.catalog.registry import query, table
from tokenloom.functions.text import minute_stamp
from tokenloom.functions.training import (
    accumulated_loss,
    learning_rate,
    model_flops_utilisation,
    parameter_count,
    reported_loss,
)
from tokenloom.operators.filters import every_n, quick_test, until_last
from tokenloom.operators.prefix import key_bounds
from tokenloom.operators.runlog import (
    best_per_run,
    checkpoints,
    last_microstep_loss,
    moving_average,
    number_iterations,
    running_best,
    step_seconds,
)
from tokenloom.plans.report import step_report
from tokenloom.session import shared_dir
from tokenloom.sinks.metrics import append_metrics

# The run configuration the formulas are evaluated with.
MODEL = {"vocab_size": 50304, "n_embed": 384, "n_layers": 6, "bias": True}
SHAPE = {"n_layers": 6, "n_head": 6, "n_embed": 384, "block_size": 256}
PASSES = 6 * 5
SCHEDULE = {"warmup_iters": 100, "lr_decay_iters": 5000, "base_lr": 0.001, "min_lr": 0.0001}
LOG_INTERVAL = 10
ACCUMULATION = 5

LOG_SQL = """
WITH log AS (
  SELECT user_id AS run_id, event_id, ts, value AS val_loss,
         row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS iter
  FROM events
)
"""

# seconds since the previous row; FLOPs per iteration of the model above over the peak
MFU_SQL = (
    LOG_SQL
    + """
, timed AS (
  SELECT run_id, iter, (epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY run_id ORDER BY iter))
                       / 1e6::DOUBLE AS seconds
  FROM log
), used AS (
  SELECT run_id, iter, seconds,
         CASE WHEN seconds > 0 THEN
           (6 * 29964288.0::DOUBLE + 12 * 6 * 6 * 64 * 256.0::DOUBLE) * 256 * 30 / seconds / 6.832e12
         END AS mfu
  FROM timed
)
"""
)


def eval_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(run_id, iter, ts, val_loss), stored, because the operators read it several times."""
    events = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("run_id"), "event_id", "ts", F.col("value").alias("val_loss")
    )
    path = shared_dir(spark, "log")
    number_iterations(events, run="run_id", order="event_id").drop("event_id").write.parquet(path)
    return spark.read.parquet(path)


def utilisation(log: DataFrame) -> DataFrame:
    """(run_id, iter, seconds, mfu)."""
    mfu = model_flops_utilisation(
        F.col("seconds"), parameters=parameter_count(**MODEL), passes=PASSES, **SHAPE
    )
    return step_seconds(log).select("run_id", "iter", "seconds", mfu.alias("mfu"))


@query(
    "lr_schedule",
    """
SELECT event_id, it, round(CASE
    WHEN it < 100 THEN 0.001::DOUBLE * it / 100
    WHEN it > 5000 THEN 0.0001::DOUBLE
    ELSE 0.0001::DOUBLE + 0.5::DOUBLE * (1 + cos(pi() * ((it - 100)::DOUBLE / 4900)))
         * (0.001::DOUBLE - 0.0001::DOUBLE) END, 9) AS lr
FROM (SELECT event_id, event_id % 5002 AS it FROM events)""",
)
def lr_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = table(spark, sf_dir, "events").select(
        "event_id", (F.col("event_id") % 5002).alias("it")
    )
    return log.withColumn("lr", F.round(learning_rate(F.col("it"), **SCHEDULE), 9))


@query(
    "run_best",
    LOG_SQL
    + """
, prior AS (
  SELECT *, coalesce(min(val_loss) OVER (PARTITION BY run_id ORDER BY iter ROWS BETWEEN
                     UNBOUNDED PRECEDING AND 1 PRECEDING), 1e9::DOUBLE) AS best
  FROM log
)
SELECT run_id, iter, val_loss, least(best, val_loss) AS best_val_loss,
       val_loss < best AND iter > 0 AS is_new_best
FROM prior""",
)
def run_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = eval_log(spark, sf_dir).drop("ts")
    return running_best(log)


@query(
    "checkpoint_records",
    LOG_SQL
    + """
, prior AS (
  SELECT *, coalesce(min(val_loss) OVER (PARTITION BY run_id ORDER BY iter ROWS BETWEEN
                     UNBOUNDED PRECEDING AND 1 PRECEDING), 1e9::DOUBLE) AS best
  FROM log
)
SELECT run_id, iter, val_loss AS best_val_loss, 'runs/' || run_id || '/iter-' || iter AS path
FROM prior WHERE val_loss < best AND iter > 0""",
)
def checkpoint_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checkpoints(eval_log(spark, sf_dir), "runs")


@query(
    "best_per_run",
    LOG_SQL
    + """
SELECT run_id, min(val_loss) AS best_val_loss,
       arg_min(iter, {'v': val_loss, 'i': iter}) AS best_iter
FROM log GROUP BY run_id""",
)
def run_minimum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_per_run(eval_log(spark, sf_dir))


@query(
    "step_time_mfu",
    MFU_SQL + "SELECT run_id, iter, seconds, round(mfu, 9) AS mfu FROM used",
)
def step_time_mfu(spark: SparkSession, sf_dir: str) -> DataFrame:
    return utilisation(eval_log(spark, sf_dir)).withColumn("mfu", F.round("mfu", 9))


@query(
    "mfu_ema",
    MFU_SQL
    + """
, logged AS (
  SELECT run_id, iter, mfu * 1000 AS mfu FROM used WHERE iter % 10 = 0
), folded AS (
  SELECT a.run_id, a.iter, any_value(a.mfu) AS mfu,
         list_reduce(list(b.mfu ORDER BY b.iter) FILTER (WHERE b.iter >= 5),
                     lambda e, m: 0.9::DOUBLE * e + 0.1::DOUBLE * m) AS running
  FROM logged a JOIN logged b ON a.run_id = b.run_id AND b.iter <= a.iter
  GROUP BY a.run_id, a.iter
)
SELECT run_id, iter, round(mfu, 6) AS mfu, round(coalesce(running, -1), 6) AS running FROM folded""",
)
def mfu_ema(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = eval_log(spark, sf_dir)
    timed = utilisation(log).withColumn("mfu", F.col("mfu") * 1000)
    averaged = moving_average(timed, log_interval=LOG_INTERVAL, bounds=key_bounds(log, "iter"))
    return averaged.withColumn("mfu", F.round("mfu", 6)).withColumn(
        "running", F.round("running", 6)
    )


@query(
    "last_microstep",
    """
WITH ranked AS (
  SELECT l_suppkey % 10 AS run_id, l_orderkey AS iter, l_quantity AS loss,
         row_number() OVER (PARTITION BY l_suppkey % 10, l_orderkey
                            ORDER BY l_linenumber DESC, l_partkey DESC, l_suppkey DESC,
                                     l_quantity DESC) AS r
  FROM lineitem
)
SELECT run_id, iter, loss, round(loss / 5, 6) AS scaled, round(loss / 5 * 5, 6) AS reported
FROM ranked WHERE r = 1""",
)
def last_microstep(spark: SparkSession, sf_dir: str) -> DataFrame:
    steps = table(spark, sf_dir, "lineitem").select(
        (F.col("l_suppkey") % 10).alias("run_id"),
        F.col("l_orderkey").alias("iter"),
        F.col("l_linenumber").alias("microstep"),
        F.col("l_quantity").alias("loss"),
        "l_partkey",
        "l_suppkey",
    )
    order = F.struct("microstep", "l_partkey", "l_suppkey", "loss")
    scaled = accumulated_loss(F.col("loss"), ACCUMULATION)
    return last_microstep_loss(steps, order).select(
        "run_id",
        "iter",
        "loss",
        F.round(scaled, 6).alias("scaled"),
        F.round(reported_loss(scaled, ACCUMULATION), 6).alias("reported"),
    )


# Runs are the ten account groups; a run's configuration follows from its number.
REPORT_SQL = """
WITH steps AS (
  SELECT (l_suppkey % 10)::VARCHAR AS run_id, l_orderkey AS iter, l_linenumber AS microstep,
         l_quantity AS loss, l_partkey, l_suppkey,
         epoch_us(TIMESTAMP '2024-01-01') + l_orderkey * 1000000 + l_linenumber AS us
  FROM lineitem
), last AS (
  SELECT run_id, iter, max(us) AS us,
         arg_max(loss, {'a': microstep, 'b': l_partkey, 'c': l_suppkey, 'd': loss}) AS loss
  FROM steps GROUP BY run_id, iter
), timed AS (
  SELECT *, (us - lag(us) OVER (PARTITION BY run_id ORDER BY iter)) / 1e6::DOUBLE AS seconds,
         run_id::INTEGER + 2 AS batch FROM last
)
SELECT run_id, iter, loss, seconds, round(CASE
    WHEN iter < 100 THEN 0.001::DOUBLE * iter / 100
    WHEN iter > 5000 THEN 0.0001::DOUBLE
    ELSE 0.0001::DOUBLE + 0.5::DOUBLE * (1 + cos(pi() * ((iter - 100)::DOUBLE / 4900)))
         * (0.001::DOUBLE - 0.0001::DOUBLE) END, 9) AS lr,
  round(CASE WHEN seconds > 0 THEN
    (6 * 29964288.0::DOUBLE + 12 * 6 * 6 * 64 * 256.0::DOUBLE) * 256 * (batch * 5) / seconds / 6.832e12
    END, 9) AS mfu
FROM timed"""


@query("step_report", REPORT_SQL)
def run_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Micro-steps joined with one configuration row per run."""
    micros = F.unix_micros(F.lit("2024-01-01").cast("timestamp"))
    at = micros + F.col("l_orderkey") * 1_000_000 + F.col("l_linenumber")
    steps = table(spark, sf_dir, "lineitem").select(
        (F.col("l_suppkey") % 10).cast("string").alias("run_id"),
        F.col("l_orderkey").alias("iter"),
        F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity").alias("microstep"),
        F.timestamp_micros(at).alias("ts"),
        F.col("l_quantity").alias("loss"),
    )
    path = shared_dir(spark, "steps")
    steps.write.parquet(path)
    steps = spark.read.parquet(path)
    fixed = {"vocab_size": 50304, "n_layers": 6, "n_head": 6, "n_embed": 384, "block_size": 256, "bias": True}
    fixed |= {"warmup_iters": 100, "lr_decay_iters": 5000, "learning_rate": 0.001, "min_lr": 0.0001}
    configs = steps.select("run_id").distinct().select(
        "run_id",
        (F.col("run_id").cast("int") + 2).alias("batch_size"),
        F.lit(ACCUMULATION).alias("gradient_accumulation_steps"),
        *[F.lit(value).alias(key) for key, value in fixed.items()],
    )
    report = step_report(steps, configs)
    return report.withColumn("lr", F.round("lr", 9)).withColumn("mfu", F.round("mfu", 9))


@query(
    "every_n",
    LOG_SQL
    + """
SELECT run_id, iter, val_loss, iter % 10 = 0 AS is_logged FROM log WHERE iter % 5 = 0 AND iter <= 50""",
)
def evaluated_iterations(spark: SparkSession, sf_dir: str) -> DataFrame:
    iteration = F.col("iter")
    return (
        eval_log(spark, sf_dir)
        .filter(every_n(iteration, 5) & until_last(iteration, 50))
        .select("run_id", "iter", "val_loss", every_n(iteration, LOG_INTERVAL).alias("is_logged"))
    )


@query("quick_test", LOG_SQL + "SELECT run_id, iter, val_loss FROM log WHERE iter = 0")
def first_evaluation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quick_test(eval_log(spark, sf_dir)).select("run_id", "iter", "val_loss")


@query(
    "metric_append",
    LOG_SQL + "SELECT run_id, iter, val_loss, strftime(ts, '%Y%m%d-%H%M') AS minute FROM log",
)
def metric_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = eval_log(spark, sf_dir).withColumn("minute", minute_stamp(F.col("ts"))).drop("ts")
    path = shared_dir(spark, "metrics")
    for part in (F.col("iter") < 20, F.col("iter") >= 20):
        append_metrics(log.filter(part), path)
    return spark.read.parquet(path)
