"""Run-log operators, formulas, logits expressions and streams."""

import datetime
import math
import random

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from tokenloom import schemas
from tokenloom.functions.logits import cross_entropy, draw, keep_top_k, next_id, scale, softmax
from tokenloom.functions.text import char_slice, minute_stamp
from tokenloom.functions.training import (
    learning_rate,
    model_flops_utilisation,
    parameter_count,
)
from tokenloom.operators.evaluation import batch_losses, split_losses
from tokenloom.operators.filters import every_n, quick_test, until_last
from tokenloom.operators.runlog import (
    best_per_run,
    last_microstep_loss,
    moving_average,
    number_iterations,
    running_best,
    step_seconds,
)
from tokenloom.plans.generate import generate_step, model_context
from tokenloom.plans.prepare import prepare_corpus, sample_blocks
from tokenloom.plans.report import step_report
from tokenloom.sources.tables import read_chunks, read_vocab
from tokenloom.streaming.runlog import FEW_ROWS, RunTracker, live_best, live_tracking
from tokenloom.streaming.sinks import latest_rows, start_batches

MODEL = {"vocab_size": 50304, "n_embed": 384, "n_layers": 6, "bias": True}
SHAPE = {"n_layers": 6, "n_head": 6, "n_embed": 384, "block_size": 256}


def value(spark, expr):
    return spark.range(1).select(expr).first()[0]


def floats(*values):
    return F.array(*[F.lit(float(v)) for v in values])


def test_learning_rate(spark):
    rate = learning_rate(
        F.col("it"), warmup_iters=100, lr_decay_iters=5000, base_lr=0.001, min_lr=0.0001
    )
    its = spark.createDataFrame([(i,) for i in (0, 50, 100, 2550, 5000, 5001)], "it bigint")
    got = [r[0] for r in its.select(rate).collect()]
    assert got == pytest.approx([0, 0.0005, 0.001, 0.00055, 0.0001, 0.0001], abs=1e-12)
    same = dict(warmup_iters=0, lr_decay_iters=0, base_lr=1.0, min_lr=0.1)
    assert value(spark, learning_rate(F.lit(0), **same)) is None
    assert value(spark, learning_rate(F.lit(7), **same)) == 0.1
    assert value(spark, learning_rate(F.lit(7), **same, decay_lr=False)) == 1.0


def test_model_formulas(spark):
    assert value(spark, parameter_count(**MODEL)) == 29_964_288
    mfu = model_flops_utilisation(
        F.lit(1.0), parameters=parameter_count(**MODEL), passes=30, **SHAPE
    )
    assert value(spark, mfu) == pytest.approx(0.210057, abs=1e-6)
    none = model_flops_utilisation(F.lit(0.0), parameters=1, passes=1, **SHAPE)
    assert value(spark, none) is None


def test_losses(spark):
    assert value(spark, cross_entropy(floats(0, 0), F.lit(1))) == pytest.approx(math.log(2))
    assert value(spark, cross_entropy(floats(1000, 0), F.lit(1))) == pytest.approx(1000)
    assert value(spark, cross_entropy(floats(0, 0), F.lit(-1))) is None

    def row(split, batch, loss):
        # two logits whose first has cross-entropy `loss`
        return (split, batch, 0, [0.0, math.log(math.expm1(loss))], 0)

    rows = [row("train", 0, 1.0)] * 10 + [row("train", 1, 3.0)]
    rows += [("val", 0, 0, [0.0, 0.0], -1)]
    logits = spark.createDataFrame(rows, schemas.LOGITS)
    got = {r["split"]: r["loss"] for r in split_losses(logits).collect()}
    assert got["train"] == pytest.approx(2.0, abs=1e-6) and got["val"] is None
    assert batch_losses(logits).count() == 3


def test_sampling_step(spark):
    minus = float("-inf")
    assert value(spark, keep_top_k(floats(2, 1, 1, 0), 2)) == [2, 1, 1, minus]
    assert value(spark, keep_top_k(floats(2, 1), 5)) == [2, 1]
    assert sum(value(spark, softmax(floats(3, 1, 2)))) == pytest.approx(1)
    assert value(spark, softmax(floats(1000, 0))) == [1.0, 0.0]
    with pytest.raises(ValueError):
        scale(floats(1), 0)
    p = floats(0.25, 0.0, 0.75, 0.0)
    draws = {u: value(spark, draw(p, F.lit(u))) for u in (0.0, 0.2, 0.25, 0.99, 1.0)}
    assert draws == {0.0: 0, 0.2: 0, 0.25: 2, 0.99: 2, 1.0: 2}
    assert value(spark, next_id(floats(0, 5, 5), F.lit(0.99), 0.5, 1)) == 2
    drawn = spark.range(20000).select(
        next_id(floats(math.log(1), math.log(3)), F.rand(3)).alias("i")
    )
    assert drawn.agg(F.avg("i")).first()[0] == pytest.approx(0.75, abs=0.02)


def test_generation(spark):
    rows = spark.createDataFrame(
        [(1, [1, 2, 3, 4, 5], [0.0, 50.0]), (2, [1], [50.0, 0.0])],
        "id bigint, ids array<int>, logits array<float>",
    )
    assert model_context(rows, 3).orderBy("id").first()["ids"] == [3, 4, 5]
    out = generate_step(rows, key="id", step=0, temperature=0.8, top_k=2).orderBy("id").collect()
    assert [r["ids"] for r in out] == [[1, 2, 3, 4, 5, 1], [1, 0]]


def log_of(spark, losses, run="r"):
    rows = [(run, i * 250, v) for i, v in enumerate(losses)]
    return spark.createDataFrame(rows, "run_id string, iter bigint, val_loss double")


def test_running_best(spark):
    rows = running_best(log_of(spark, [5.0, 4.0, 4.0, None, 3.0])).orderBy("iter").collect()
    assert [r["is_new_best"] for r in rows] == [False, True, False, False, True]
    assert [r["best_val_loss"] for r in rows] == [5, 4, 4, 4, 3]
    best = best_per_run(log_of(spark, [None, 4.0, 4.0, 7.0])).first()
    assert (best["best_val_loss"], best["best_iter"]) == (4.0, 250)


def test_microsteps_and_predicates(spark):
    steps = spark.createDataFrame(
        [("r", 10, m, None, v) for m, v in enumerate([3.0, 2.0, 5.0])], schemas.STEP_LOG
    )
    assert last_microstep_loss(steps).first()["loss"] == 5.0
    its = spark.range(20).withColumnRenamed("id", "iter")
    assert its.filter(every_n(F.col("iter"), 5)).count() == 4
    assert its.filter(until_last(F.col("iter"), 5)).count() == 6
    assert quick_test(its).count() == 1


def test_text_helpers(spark):
    assert value(spark, char_slice(F.lit("a😀bc"), 1, 3)) == "😀b"
    assert value(spark, minute_stamp(F.lit("2023-04-05 06:07:08").cast("timestamp_ntz"))) == "20230405-0607"


def average(rows, log_interval, settle=5):
    running, out = -1.0, {}
    for i, mfu in rows:
        if i % log_interval == 0:
            if i >= settle and mfu is not None:
                running = mfu if running == -1.0 else 0.9 * running + 0.1 * mfu
            out[i] = running
    return out


def test_moving_average(spark):
    rows = spark.createDataFrame(
        [("r", 10, 1.0), ("r", 20, 2.0), ("r", 30, 2.0), ("r", 0, 9.0)],
        "run_id string, iter bigint, mfu double",
    )
    got = [r["running"] for r in moving_average(rows).orderBy("iter").collect()]
    assert got == pytest.approx([-1.0, 1.0, 1.1, 1.19])


def test_moving_average_of_a_long_run(spark):
    # Many groups of rows in one run, next to a short run.
    rng = random.Random(1)
    values = [rng.random() * 10 for _ in range(13_000)]
    values[6000:12000] = [v * 1e-6 for v in values[6000:12000]]
    rows = [("long", i, v) for i, v in enumerate(values)] + [("short", i, 1.0) for i in range(9)]
    log = spark.createDataFrame(rows, "run_id string, iter bigint, mfu double").repartition(8)
    for fanout in (256, 65536):
        got = {(r["run_id"], r["iter"]): r["running"]
               for r in moving_average(log, log_interval=1, fanout=fanout).collect()}
        want = average(list(enumerate(values)), 1)
        assert len(got) == len(rows)
        assert all(got["long", i] == pytest.approx(v, rel=1e-9) for i, v in want.items())
        assert got["short", 4] == -1.0 and got["short", 8] == pytest.approx(1.0)


def test_moving_average_of_large_values_and_gaps(spark):
    values = [1e130 if i % 7 else None for i in range(3000)] + [1e-3] * 3000
    rows = [("r", i * 2, v) for i, v in enumerate(values) if not 700 <= i < 1500]
    log = spark.createDataFrame(rows, "run_id string, iter bigint, mfu double")
    got = {r["iter"]: r["running"] for r in moving_average(log, log_interval=2, first_iter=20).collect()}
    want = average([(i, v) for _, i, v in rows], 2, settle=25)
    assert len(got) == len(want)
    assert all(got[i] == pytest.approx(v, rel=1e-12) for i, v in want.items())


def timed_log(spark, n_runs=5, length=40):
    rng = random.Random(9)
    start, rows = datetime.datetime(2024, 1, 1), []
    for run in range(n_runs):
        now = start
        for i in range(length):
            now += datetime.timedelta(microseconds=rng.randrange(10**6, 10**8))
            rows.append((f"r{run}", i, now, rng.random(), 2.0))
    return rows


LIVE = "run_id string, iter bigint, ts timestamp, val_loss double, work double"


def test_step_seconds(spark):
    rows = timed_log(spark)
    log = spark.createDataFrame(rows, LIVE)
    start = F.lit("2024-01-01").cast("timestamp")
    got = {(r["run_id"], r["iter"]): r["seconds"]
           for r in step_seconds(log, start=start, fanout=16).collect()}
    last = {}
    for run, i, ts, *_ in rows:
        want = (ts - last.get(run, datetime.datetime(2024, 1, 1))).total_seconds()
        assert got[run, i] == pytest.approx(want, abs=1e-9)
        last[run] = ts
    assert step_seconds(log).filter("seconds IS NULL").count() == 5
    numbered = number_iterations(log.drop("iter").withColumn("k", F.unix_micros("ts")),
                                 run="run_id", order="k", fanout=1 << 16)
    assert sorted((r["run_id"], r["iter"]) for r in numbered.collect()) == sorted(got)


@pytest.mark.parametrize("batches", [1, 3])
def test_streams_equal_batch(spark, tmp_path, batches):
    rows = timed_log(spark)
    rows.sort(key=lambda r: r[2])
    width = -(-len(rows) // batches)
    for b in range(batches):
        part = rows[b * width : (b + 1) * width]
        random.Random(b).shuffle(part)
        repeated = part + part[:3]
        spark.createDataFrame(repeated, LIVE).coalesce(1).write.mode("append").parquet(
            str(tmp_path / "in")
        )

    def stream():
        return spark.readStream.schema(LIVE).option("maxFilesPerTrigger", 1).parquet(
            str(tmp_path / "in")
        )

    log = spark.createDataFrame(rows, LIVE)
    best = start_batches(live_best(stream()), str(tmp_path / "b"), str(tmp_path / "bc"), mode="update")
    best.awaitTermination()
    got = sorted(tuple(r) for r in latest_rows(spark, str(tmp_path / "b"), "run_id").collect())
    assert got == sorted(tuple(r) for r in best_per_run(log).collect())

    tracked = start_batches(
        live_tracking(stream(), log_interval=5), str(tmp_path / "t"), str(tmp_path / "tc"), mode="append"
    )
    tracked.awaitTermination()
    got = {(r["run_id"], r["iter"]): r for r in spark.read.parquet(str(tmp_path / "t")).collect()}
    assert len(got) == len(rows)
    timed = step_seconds(running_best(log)).withColumn("mfu", F.col("work") / F.col("seconds"))
    averages = {(r["run_id"], r["iter"]): r["running"]
                for r in moving_average(timed, log_interval=5).collect()}
    for r in timed.collect():
        live = got[r["run_id"], r["iter"]]
        assert (live["best_val_loss"], live["is_new_best"]) == (r["best_val_loss"], r["is_new_best"])
        assert live["seconds"] == pytest.approx(r["seconds"])
        if r["iter"] % 5 == 0:
            assert live["running"] == pytest.approx(averages[r["run_id"], r["iter"]])


def test_a_long_backlog_is_applied_by_groups_and_rejects_are_seen(spark, tmp_path):
    """One run's 20,000 rows wait for one watermark; two rows come again after they were applied."""
    t0 = datetime.datetime(2024, 1, 1, tzinfo=datetime.timezone.utc)

    def at(second):
        return t0 + datetime.timedelta(seconds=second)

    order = list(range(20_000))
    random.Random(3).shuffle(order)
    parts = [
        [("hot", i, at(i), 5.0 - i * 1e-4, 1.0) for i in order],
        [("hot", 7, at(30_000), 0.0, 1.0), ("hot", 19_999, at(30_001), 0.0, 1.0), ("other", 0, at(40_000), 1.0, 1.0)],
        [("other", 1, at(90_000), 1.0, 1.0)],
    ]
    for number, part in enumerate(parts):
        spark.createDataFrame(part, LIVE).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(LIVE).parquet(str(tmp_path / "in"))
        tracked = live_tracking(stream, log_interval=10)
        start_batches(tracked, str(tmp_path / "t"), str(tmp_path / "tc"), mode="append").awaitTermination()
    rows = [r for r in spark.read.parquet(str(tmp_path / "t")).collect() if r["run_id"] == "hot"]
    applied = sorted(r["iter"] for r in rows if r["iter"] is not None)
    assert applied == list(range(20_000)) and all(r["rejected"] == 0 for r in rows if r["iter"] is not None)
    assert [r["rejected"] for r in rows if r["iter"] is None] == [2]
    last = next(r for r in rows if r["iter"] == 19_999)
    assert last["best_val_loss"] == pytest.approx(5.0 - 1.9999) and last["seconds"] == 1.0


class OneRun:
    """The state of one key, with a count of the calls on it."""

    def __init__(self):
        self.calls, self.value, self.groups, self.timers = 0, None, {}, set()

    def getValueState(self, name, schema):
        return ValueOf(self)

    def getMapState(self, name, key, value):
        return MapOf(self)

    def registerTimer(self, at):
        self.calls += 1
        self.timers.add(at)


class ValueOf:
    def __init__(self, run):
        self.run = run

    def exists(self):
        self.run.calls += 1
        return self.run.value is not None

    def get(self):
        self.run.calls += 1
        return self.run.value

    def update(self, value):
        self.run.calls += 1
        self.run.value = tuple(value)


class MapOf(ValueOf):
    def containsKey(self, key):
        self.run.calls += 1
        return key in self.run.groups

    def getValue(self, key):
        self.run.calls += 1
        return self.run.groups[key]

    def updateValue(self, key, value):
        self.run.calls += 1
        self.run.groups[key] = value

    def removeKey(self, key):
        self.run.calls += 1
        del self.run.groups[key]

    def keys(self):
        self.run.calls += 1
        return list(self.run.groups)


class At:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms


def tracked_alone(slices):
    """(values reported, state) of one run whose rows (iter, ms) come in slices, each with a watermark."""
    run = OneRun()
    tracker = RunTracker(log_interval=10)
    tracker.init(run)
    out = []
    for rows, watermark in slices:
        logged = [Row(iter=i, at=ms * 1000, val_loss=float(-i), work=1.0) for i, ms in rows]
        if logged:
            tracker.handleInputRows(("r",), iter(logged), At(None))
        for due in sorted(t for t in run.timers if t <= watermark):
            run.timers.discard(due)
            out += tracker.handleExpiredTimer(("r",), At(watermark), None)
    return out, run


def test_a_short_run_is_read_and_written_once_per_call():
    out, run = tracked_alone([([(0, 1), (1, 2), (2, 3)], 3), ([(3, 4), (1, 5)], 5)])
    assert [(r["iter"], r["rejected"]) for r in out] == [(0, 0), (1, 0), (2, 0), (3, 1)]
    # Rows: read, write and a timer. Timer: read and write. Two slices of both.
    assert run.calls == 10 and not run.timers


def test_waiting_rows_move_to_groups_and_back():
    n = 2 * FEW_ROWS + 100
    rows = [(i, i + 1) for i in range(n)]
    cut = FEW_ROWS - 10
    slices = [(rows[:cut], 5), (rows[cut:n - 3], 5), (rows[:2], FEW_ROWS), ([], n - 5), (rows[n - 3:], n - 1), ([], n)]
    out, run = tracked_alone(slices)
    assert sorted(r["iter"] for r in out if r["iter"] is not None) == list(range(n))
    assert [r["iter"] for r in out if r["iter"] is not None] == list(range(n))
    assert [r["best_val_loss"] for r in out if r["iter"] is not None] == [float(-i) for i in range(n)]
    assert out[-1]["rejected"] == 2
    assert not run.groups and not run.timers and not any(run.value[7:])


def test_report(spark):
    t0 = datetime.datetime(2024, 1, 1)
    steps = spark.createDataFrame(
        [("r", i, m, t0 + datetime.timedelta(seconds=2 * i, milliseconds=m), float(i + m))
         for i in range(3) for m in range(2)],
        schemas.STEP_LOG,
    )
    keys = dict(run_id="r", batch_size=6, block_size=256, vocab_size=50304, n_layers=6, n_head=6,
                n_embed=384, bias=True, learning_rate=0.001, warmup_iters=100, lr_decay_iters=5000,
                min_lr=0.0001, gradient_accumulation_steps=5)
    config = spark.createDataFrame([{f: keys.get(f) for f in schemas.RUN_CONFIG.names}], schemas.RUN_CONFIG)
    rows = step_report(steps, config).orderBy("iter").collect()
    assert [r["loss"] for r in rows] == [1.0, 2.0, 3.0]
    assert rows[0]["mfu"] is None and rows[1]["mfu"] == pytest.approx(0.210057 / 2, abs=1e-6)
    assert rows[2]["lr"] == pytest.approx(0.00002)


def test_prepare(spark, tmp_path):
    texts = ["hello world\n" * 9, "", "the cat", "sat on the mat " * 7]
    corpus = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    data = prepare_corpus(corpus, str(tmp_path / "out"), chunk_size=8, token_files=True)
    whole = "".join(texts)
    cut = int(len(whole) * 0.9)
    assert data.n_tokens == {"train": cut, "val": len(whole) - cut}
    itos = {r["id"]: r["ch"] for r in read_vocab(spark, data.vocab).collect()}
    chunks = read_chunks(spark, data.chunks)
    text = "".join(itos[t] for r in chunks.orderBy("split", "chunk_id").collect() for t in r["tokens"])
    assert text == whole
    blocks = sample_blocks(chunks, data, batch_size=2, batches=3, seed=1).collect()
    assert len(blocks) == 12
    for b in blocks:
        base = 0 if b["split"] == "train" else cut
        at = base + b["start"]
        assert "".join(itos[t] for t in b["x"]) == whole[at : at + 8]
        assert b["y"][:-1] == b["x"][1:] and itos[b["y"][-1]] == whole[at + 8]
