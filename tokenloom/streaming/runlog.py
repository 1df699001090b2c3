"""Live run-log analytics."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tokenloom.operators.runlog import (
    KEEP,
    NO_AVERAGE,
    NO_BEST,
    SETTLE_ITERS,
    TAKE,
    best_per_run,
)

LIVE_LOG = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("iter", T.LongType()),
        T.StructField("val_loss", T.DoubleType()),
        T.StructField("best_val_loss", T.DoubleType()),
        T.StructField("is_new_best", T.BooleanType()),
        T.StructField("seconds", T.DoubleType()),
        T.StructField("mfu", T.DoubleType()),
        T.StructField("running", T.DoubleType()),
        T.StructField("rejected", T.LongType()),
    ]
)

# The rows of a group, a list for each column.
_GROUP = T.StructType([T.StructField("group", T.LongType())])
_WAITING = T.StructType(
    [
        T.StructField("iter", T.ArrayType(T.LongType())),
        T.StructField("at", T.ArrayType(T.LongType())),
        T.StructField("val_loss", T.ArrayType(T.DoubleType())),
        T.StructField("work", T.ArrayType(T.DoubleType())),
    ]
)
# (best, average, time, iter, rejected) after the last applied row, the earliest time that waits, whether
# rows wait by groups, and else the waiting rows; times are microseconds since 1970, free of any time zone.
_STATE = T.StructType(
    [
        T.StructField("best", T.DoubleType()),
        T.StructField("average", T.DoubleType()),
        T.StructField("at", T.LongType()),
        T.StructField("iter", T.LongType()),
        T.StructField("rejected", T.LongType()),
        T.StructField("earliest", T.LongType()),
        T.StructField("grouped", T.BooleanType()),
        *(T.StructField(f"waiting_{f.name}", f.dataType) for f in _WAITING),
    ]
)
GROUP_ITERS = 1 << 10
HELD_ROWS = 1 << 14
# Rows of a run that wait beside its other state; more lie by groups.
FEW_ROWS = 1 << 10


NEW_RUN = (NO_BEST, NO_AVERAGE, None, -1, 0)


def live_best(log: DataFrame) -> DataFrame:
    """Best validation loss per run of a stream; use update mode."""
    return best_per_run(log)


def advance(state: tuple | None, row: Row, log_interval: int, first_iter: int = 0) -> tuple[tuple, tuple]:
    """Apply one row to a run's state: the new state, and the values to report."""
    best, average, last, _, rejected = state or NEW_RUN
    seconds = (row.at - last) / 1e6 if last is not None else None
    mfu = row.work / seconds if seconds and seconds > 0 else None
    improved = row.val_loss is not None and row.val_loss < best
    if improved:
        best = row.val_loss
    if row.iter % log_interval == 0 and row.iter >= first_iter + SETTLE_ITERS and mfu is not None:
        average = mfu if average == NO_AVERAGE else KEEP * average + TAKE * mfu
    report = (row.iter, row.val_loss, best, improved and row.iter > 0, seconds, mfu, average, rejected)
    return (best, average, row.at, row.iter, rejected), report


def _by_group(rows: list[tuple]) -> dict[int, list[tuple]]:
    groups: dict[int, list[tuple]] = {}
    for row in rows:
        groups.setdefault(row[0] // GROUP_ITERS, []).append(row)
    return groups


class RunTracker(StatefulProcessor):
    """Rows wait until the watermark has passed them and are then applied in `iter` order.
    A second row for an iteration that waits, and a row at or before the last applied
    iteration, is left out and counted in `rejected`, which later rows of the run report; where none follows
    in the same micro-batch, a row with a null iter does. A resumed run that repeats
    iterations should therefore use a new run_id. Rows older than the watermark never arrive here
    (Spark drops and counts them).

    A run's few waiting rows are a part of its one state value, which costs one read and one write. More than
    FEW_ROWS lie by groups of GROUP_ITERS consecutive iterations, which are taken in order one at a time: of a
    backlog of any length a task holds a group, a few rows on their way into state, and the numbers of the
    groups."""

    def __init__(self, log_interval: int, first_iter: int = 0):
        self.log_interval = log_interval
        self.first_iter = first_iter

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.run = handle.getValueState("run", _STATE)
        self.waiting = handle.getMapState("waiting", _GROUP, _WAITING)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        state, before, grouped, held = self._load()
        earliest = before
        for row in rows:
            held.append((row.iter, row.at, row.val_loss, row.work))
            earliest = row.at if earliest is None else min(earliest, row.at)
            if len(held) >= HELD_ROWS:
                self._put(held)
                held, grouped = [], True
        if grouped or len(held) > FEW_ROWS:
            self._put(held)
            held, grouped = [], True
        # Rows that wait have a timer already, at or before their earliest.
        if before is None or earliest < before:
            self.handle.registerTimer(earliest // 1000)
        self._save(state, earliest, grouped, held)
        return iter(())

    def _load(self) -> tuple[tuple, int | None, bool, list[tuple]]:
        """(state, earliest time that waits, whether rows wait by groups, the rows that wait here)."""
        value = self.run.get()
        if value is None:
            return NEW_RUN, None, False, []
        return tuple(value[:5]), value[5], value[6], list(zip(*value[7:]))

    def _save(self, state: tuple, earliest: int | None, grouped: bool, held: list[tuple]) -> None:
        columns = zip(*held) if held else [()] * len(_WAITING)
        self.run.update((*state, earliest, grouped, *map(list, columns)))

    def _put(self, held: list[tuple]) -> None:
        for group, rows in _by_group(held).items():
            self.waiting.updateValue((group,), tuple(zip(*[*self._group(group), *rows])))

    def _group(self, group: int) -> list[tuple]:
        if not self.waiting.containsKey((group,)):
            return []
        return list(zip(*self.waiting.getValue((group,))))

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        watermark = timerValues.getCurrentWatermarkInMs()
        state, _, grouped, held = self._load()
        here = _by_group(held)
        reported, earliest, left, still = state[4], None, [], False
        for group in sorted([k[0] for k in self.waiting.keys()] if grouped else here):
            due: dict[int, Row] = {}
            later, rejected = [], 0
            for iteration, at, val_loss, work in self._group(group) if grouped else here[group]:
                if at // 1000 > watermark:
                    later.append((iteration, at, val_loss, work))
                    earliest = at if earliest is None else min(earliest, at)
                elif iteration <= state[3] or iteration in due:
                    rejected += 1
                else:
                    due[iteration] = Row(iter=iteration, at=at, val_loss=val_loss, work=work)
            if not grouped:
                left += later
            elif later:
                self.waiting.updateValue((group,), tuple(zip(*later)))
                still = True
            else:
                self.waiting.removeKey((group,))
            state = (*state[:4], state[4] + rejected)
            for iteration in sorted(due):
                state, report = advance(state, due[iteration], self.log_interval, self.first_iter)
                reported = state[4]
                yield Row(**dict(zip(LIVE_LOG.names, (*key, *report))))
        if state[4] > reported:
            yield Row(**dict(zip(LIVE_LOG.names, (*key, *[None] * 7, state[4]))))
        if earliest is not None:
            self.handle.registerTimer(earliest // 1000)
        self._save(state, earliest, still, left)

    def close(self) -> None:
        pass


def live_tracking(
    log: DataFrame, *, delay: str = "0 seconds", log_interval: int = 10, first_iter: int = 0
) -> DataFrame:
    """New-best flags, step times, utilisation and its moving average of a stream of
    (run_id string, iter, ts, val_loss, work), where `work` is the utilisation that a
    step of one second would have. Use append mode.

    The average waits from `first_iter`, where this part of the run begins, as in
    `moving_average`. `delay` is how much later than newer rows a row may arrive. One run's rows are by
    nature applied one after another; to catch up on a long history use the batch
    operators, which also divide a single run.
    """
    return (
        log.withColumn("at", F.unix_micros("ts"))
        .withWatermark("ts", delay)
        .groupBy("run_id")
        .transformWithState(
            statefulProcessor=RunTracker(log_interval, first_iter),
            outputStructType=LIVE_LOG,
            outputMode="append",
            timeMode="eventTime",
        )
    )
