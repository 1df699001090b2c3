"""A training run's report from its step and evaluation logs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.functions.training import (
    PEAK_FLOPS,
    learning_rate,
    model_flops_utilisation,
    parameter_count,
)
from tokenloom.operators.runlog import last_microstep_loss, step_seconds


def step_report(steps: DataFrame, configs: DataFrame, peak_flops: float = PEAK_FLOPS) -> DataFrame:
    """(run_id, iter, loss, seconds, lr, mfu) from micro-steps and one config row per run."""
    losses = last_microstep_loss(steps)
    times = step_seconds(steps.groupBy("run_id", "iter").agg(F.max("ts").alias("ts")))
    log = losses.join(times, ["run_id", "iter"]).join(configs, "run_id")
    size = {key: F.col(key) for key in ("n_layers", "n_embed")}
    parameters = parameter_count(vocab_size=F.col("vocab_size"), bias=F.col("bias"), **size)
    return log.select(
        "run_id",
        "iter",
        "loss",
        "seconds",
        learning_rate(
            F.col("iter"),
            warmup_iters=F.col("warmup_iters"),
            lr_decay_iters=F.col("lr_decay_iters"),
            base_lr=F.col("learning_rate"),
            min_lr=F.col("min_lr"),
        ).alias("lr"),
        model_flops_utilisation(
            F.col("seconds"),
            parameters=parameters,
            n_head=F.col("n_head"),
            block_size=F.col("block_size"),
            passes=F.col("batch_size") * F.col("gradient_accumulation_steps"),
            peak_flops=peak_flops,
            **size,
        ).alias("mfu"),
    )
