"""Expressions over one row of logits. Everything is per row and in double."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tokenloom.functions.core import let


def doubles(values: Column) -> Column:
    return values.cast("array<double>")


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def cross_entropy(logits: Column, target: Column, ignore: int = -1) -> Column:
    """-ln softmax(logits)[target]; null where the target is the ignored one."""

    def loss(row: Column) -> Column:
        return let(
            F.array_max(row),
            lambda top: top
            + F.ln(F.aggregate(row, F.lit(0.0), lambda acc, x: acc + F.exp(x - top)))
            - F.element_at(row, target + 1),
        )

    return F.when(target != ignore, let(doubles(logits), loss))


def scale(logits: Column, temperature: float) -> Column:
    if temperature <= 0:
        raise ValueError("temperature must be above 0")
    return F.transform(doubles(logits), lambda x: x / F.lit(float(temperature)))


def keep_top_k(logits: Column, k: int) -> Column:
    """Values below the k-th largest become -infinity; ties with the k-th stay."""
    if k < 1:
        raise ValueError("k must be at least 1")

    def mask(row: Column) -> Column:
        kth = F.element_at(F.sort_array(row, asc=False), F.least(F.lit(k), F.size(row)))
        return let(
            kth,
            lambda limit: F.transform(
                row, lambda x: F.when(x < limit, F.lit(float("-inf"))).otherwise(x)
            ),
        )

    return let(doubles(logits), mask)


def softmax(logits: Column) -> Column:
    """Probabilities that sum to 1."""

    def normal(row: Column) -> Column:
        weights = let(F.array_max(row), lambda top: F.transform(row, lambda x: F.exp(x - top)))
        return let(weights, lambda w: let(total(w), lambda s: F.transform(w, lambda x: x / s)))

    return let(doubles(logits), normal)


def draw(probabilities: Column, uniform: Column) -> Column:
    """The first id whose cumulative probability exceeds `uniform`; the last id with any
    probability if rounding leaves the sum below it."""
    start = F.struct(
        F.lit(0.0).alias("mass"), F.lit(0).alias("i"), F.lit(-1).alias("hit"), F.lit(-1).alias("last")
    )

    def step(state: Column, p: Column) -> Column:
        mass = state["mass"] + p
        hit = F.when((state["hit"] < 0) & (mass > uniform), state["i"]).otherwise(state["hit"])
        return F.struct(
            mass.alias("mass"),
            (state["i"] + 1).alias("i"),
            hit.alias("hit"),
            F.when(p > 0, state["i"]).otherwise(state["last"]).alias("last"),
        )

    return F.aggregate(
        probabilities,
        start,
        step,
        lambda s: F.when(s["hit"] >= 0, s["hit"]).otherwise(s["last"]),
    )


def next_id(logits: Column, uniform: Column, temperature: float = 1.0, top_k: int | None = None) -> Column:
    """One sampling step: temperature, top-k, softmax, draw."""
    scaled = scale(logits, temperature)
    if top_k is not None:
        scaled = keep_top_k(scaled, top_k)
    return let(softmax(scaled), lambda p: draw(p, uniform))
