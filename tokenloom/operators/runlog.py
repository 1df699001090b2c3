"""Analytics over training-run logs, keyed by (run_id, iter).

Running values go through `exclusive_prefix`, so a run of any length is split into
buckets of iterations; a short run stays a plain window. Logs are read more than once:
store a computed log before using it here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokenloom.operators.prefix import NARROW_FANOUT, exclusive_prefix, key_bounds

# The best loss before any evaluation, the moving average before it starts,
# its weights, and the iterations it waits for.
NO_BEST = 1e9
NO_AVERAGE = -1.0
KEEP, TAKE = 0.9, 0.1
SETTLE_ITERS = 5

# Logged iterations of one moving-average group.
GROUP_ROWS = 1 << 8

Bounds = tuple[int, int] | None


def number_iterations(
    events: DataFrame, *, run: str, order: str, fanout: int = NARROW_FANOUT, bounds: Bounds = None
) -> DataFrame:
    """Add `iter`: the number of earlier rows of the run, by the unique key `order`."""
    counted = exclusive_prefix(
        events.withColumn("__one", F.lit(1).cast("bigint")),
        partition=[run],
        key=order,
        value="__one",
        how="sum",
        out="iter",
        fanout=fanout,
        bounds=bounds,
    )
    return counted.drop("__one").withColumn("iter", F.coalesce("iter", F.lit(0).cast("bigint")))


def last_microstep_loss(steps: DataFrame, order: Column | None = None) -> DataFrame:
    """(run_id, iter, loss): the loss of each iteration's last micro-step. `order` refines
    the order where `microstep` alone is not unique."""
    order = F.col("microstep") if order is None else order
    return steps.groupBy("run_id", "iter").agg(F.max_by("loss", order).alias("loss"))


def best_per_run(log: DataFrame) -> DataFrame:
    """(run_id, best_val_loss, best_iter); the first of equal losses wins."""
    return log.groupBy("run_id").agg(
        F.min("val_loss").alias("best_val_loss"),
        F.min_by("iter", F.when(F.col("val_loss").isNotNull(), F.struct("val_loss", "iter"))).alias(
            "best_iter"
        ),
    )


def running_best(log: DataFrame, *, fanout: int = NARROW_FANOUT, bounds: Bounds = None) -> DataFrame:
    """Add `best_val_loss` (after this row) and `is_new_best`.

    Iteration 0 lowers the best but is never flagged.
    """
    prior = exclusive_prefix(
        log,
        partition=["run_id"],
        key="iter",
        value="val_loss",
        how="min",
        out="__prior",
        fanout=fanout,
        bounds=bounds,
    )
    best = F.least(F.coalesce("__prior", F.lit(NO_BEST)), F.lit(NO_BEST))
    improved = F.coalesce(F.col("val_loss") < best, F.lit(False))
    return (
        prior.withColumn("is_new_best", improved & (F.col("iter") > 0))
        .withColumn("best_val_loss", F.when(improved, F.col("val_loss")).otherwise(best))
        .drop("__prior")
    )


def checkpoints(log: DataFrame, folder: str, **options: object) -> DataFrame:
    """(run_id, iter, best_val_loss, path): one row per recorded new best."""
    return running_best(log, **options).filter("is_new_best").select(
        "run_id",
        "iter",
        "best_val_loss",
        F.concat(
            F.lit(folder.rstrip("/") + "/"), "run_id", F.lit("/iter-"), F.col("iter").cast("string")
        ).alias("path"),
    )


def step_seconds(
    log: DataFrame,
    *,
    start: Column | None = None,
    fanout: int = NARROW_FANOUT,
    bounds: Bounds = None,
) -> DataFrame:
    """Add `seconds` since the previous row of the run; the first row counts from
    `start` and is null without it."""
    prior = exclusive_prefix(
        log.withColumn("__at", F.struct("iter", "ts")),
        partition=["run_id"],
        key="iter",
        value="__at",
        how="max",
        out="__prior",
        fanout=fanout,
        bounds=bounds,
    )
    begin = F.col("__prior.ts")
    if start is not None:
        begin = F.coalesce(begin, start)
    # As an interval, so that local times are not moved by the session's time zone.
    elapsed = (F.col("ts") - begin).cast("interval second").cast("decimal(20,6)").cast("double")
    return prior.withColumn("seconds", elapsed).drop("__at", "__prior")


def moving_average(
    log: DataFrame,
    *,
    value: str = "mfu",
    log_interval: int = 10,
    settle: int = SETTLE_ITERS,
    first_iter: int = 0,
    fanout: int = NARROW_FANOUT,
    bounds: Bounds = None,
) -> DataFrame:
    """(run_id, iter, <value>, running): the average on logged iterations.

    It is seeded with the first value, then 0.9 old + 0.1 new; -1 before that. Iterations before
    `first_iter + settle` and null values leave it as it is.

    Every row is a step e -> keep * e + add. Steps of a group of GROUP_ROWS logged iterations
    are composed into one such step, groups are scanned the same way, and each group then
    applies its rows to what it starts with. So nothing is cut off, no power of 0.9 is
    divided by, and a group is all that a task holds of a run.
    """
    logged = log.filter(F.col("iter") % log_interval == 0).select("run_id", "iter", value)
    counted = (F.col("iter") >= first_iter + settle) & F.col(value).isNotNull()
    numbered = exclusive_prefix(
        logged.withColumn("__one", counted.cast("bigint")),
        partition=["run_id"],
        key="iter",
        value="__one",
        how="sum",
        out="__n",
        fanout=fanout,
        bounds=bounds,
    )
    first = F.coalesce("__n", F.lit(0)) == 0
    steps = numbered.select(
        "run_id",
        (F.col("iter") / log_interval).cast("bigint").alias("pos"),
        F.when(~counted, 1.0).when(first, 0.0).otherwise(KEEP).alias("keep"),
        F.when(~counted, 0.0).when(first, F.col(value)).otherwise(F.col(value) * TAKE).alias("add"),
        F.col(value).alias("given"),
    )
    _, last = (bounds[0] // log_interval, bounds[1] // log_interval) if bounds else key_bounds(steps, "pos")
    return _applied(steps, last).select(
        "run_id",
        (F.col("pos") * log_interval).alias("iter"),
        F.col("given").alias(value),
        "running",
    )


def _applied(steps: DataFrame, last: int) -> DataFrame:
    """(run_id, pos, given, running): the value after each step, from NO_AVERAGE on."""
    group = F.shiftright("pos", GROUP_ROWS.bit_length() - 1)
    rows = F.array_sort(F.collect_list(F.struct("pos", "keep", "add", "given"))).alias("rows")
    grouped = steps.groupBy("run_id", group.alias("group")).agg(rows)
    begin = F.lit(NO_AVERAGE)
    if last >= GROUP_ROWS:
        composed = F.aggregate(
            "rows",
            F.struct(F.lit(1.0).alias("keep"), F.lit(0.0).alias("add")),
            lambda acc, r: F.struct(
                (acc["keep"] * r["keep"]).alias("keep"), (acc["add"] * r["keep"] + r["add"]).alias("add")
            ),
        )
        ends = grouped.select("run_id", F.col("group").alias("pos"), composed.alias("c")).select(
            "run_id", "pos", "c.keep", "c.add", F.lit(None).cast("double").alias("given")
        )
        starts = _before(_applied(ends, last // GROUP_ROWS))
        grouped = grouped.join(starts, ["run_id", "group"], "left")
        begin = F.coalesce("start", begin)
    values = F.aggregate(
        "rows",
        F.struct(begin.alias("e"), F.array().cast("array<double>").alias("all")),
        lambda acc, r: F.struct(
            (acc["e"] * r["keep"] + r["add"]).alias("e"),
            F.array_append(acc["all"], acc["e"] * r["keep"] + r["add"]).alias("all"),
        ),
    )["all"]
    zipped = grouped.select("run_id", F.explode(F.arrays_zip("rows", values.alias("after"))).alias("z"))
    return zipped.select("run_id", "z.rows.pos", "z.rows.given", F.col("z.after").alias("running"))


def _before(ends: DataFrame) -> DataFrame:
    """(run_id, group, start): what a group starts with, the value after the run's group
    before it. Groups without rows are skipped, hence a lag and not pos + 1."""
    lagged = exclusive_prefix(
        ends.withColumn("__end", F.struct("pos", "running")),
        partition=["run_id"],
        key="pos",
        value="__end",
        how="max",
        out="__last",
    )
    return lagged.select("run_id", F.col("pos").alias("group"), F.col("__last.running").alias("start"))
