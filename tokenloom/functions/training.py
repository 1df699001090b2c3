"""Learning-rate schedule, model size and utilisation formulas."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: assumed peak FLOP/s of the device.
PEAK_FLOPS = 6.832e12

Value = Column | int | float | bool


def _double(value: Value) -> Column:
    column = value if isinstance(value, Column) else F.lit(value)
    return column.cast("double")


def learning_rate(
    iteration: Column,
    *,
    warmup_iters: Value,
    lr_decay_iters: Value,
    base_lr: Value,
    min_lr: Value,
    decay_lr: bool = True,
) -> Column:
    """Linear warm-up, cosine decay, then the minimum; the base rate if `decay_lr` is off.

    Null at the one iteration where warm-up and decay end together.
    """
    it, warmup, decay = _double(iteration), _double(warmup_iters), _double(lr_decay_iters)
    base, low = _double(base_lr), _double(min_lr)
    if not decay_lr:
        return base
    progress = F.try_divide(it - warmup, decay - warmup)
    cosine = low + F.lit(0.5) * (F.lit(1.0) + F.cos(F.lit(math.pi) * progress)) * (base - low)
    return (
        F.when(it < warmup, F.try_divide(base * it, warmup)).when(it > decay, low).otherwise(cosine)
    )


def parameter_count(
    *, vocab_size: Value, n_embed: Value, n_layers: Value, bias: Value
) -> Column:
    """Parameters without the position table; the tied output weight counts once."""
    v, c, layers, b = (
        (x if isinstance(x, Column) else F.lit(x)).cast("int").cast("bigint")
        for x in (vocab_size, n_embed, n_layers, bias)
    )
    per_layer = F.lit(12) * c * c + F.lit(2) * c + F.lit(11) * b * c
    return v * c + layers * per_layer + c * (F.lit(1) + b)


def model_flops_utilisation(
    seconds: Column,
    *,
    parameters: Value,
    n_layers: Value,
    n_head: Value,
    n_embed: Value,
    block_size: Value,
    passes: Value,
    peak_flops: Value = PEAK_FLOPS,
) -> Column:
    """Share of the peak reached by `passes` forward/backward passes in `seconds`;
    null unless `seconds` is positive."""
    n, layers, heads, embed, block, times, peak = map(
        _double, (parameters, n_layers, n_head, n_embed, block_size, passes, peak_flops)
    )
    head_size = F.floor(embed / heads).cast("double")
    per_token = F.lit(6.0) * n + F.lit(12.0) * layers * heads * head_size * block
    per_iteration = per_token * block * times
    return F.when(seconds > 0, per_iteration * (F.lit(1.0) / seconds) / peak)


def accumulated_loss(loss: Column, steps: Value) -> Column:
    """A micro-step loss as it enters the gradient: divided by the number of steps."""
    return loss / _double(steps)


def reported_loss(loss: Column, steps: Value) -> Column:
    return loss * _double(steps)
