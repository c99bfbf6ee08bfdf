"""Vector arithmetic on ``array<double>`` columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def relu_column(z: Column) -> Column:
    """max(0, z). ``greatest`` skips NULL (giving 0.0) and lets NaN through."""
    return F.greatest(F.lit(0.0), z)


def dot_product(a: Column, b: Column) -> Column:
    """Sum of products over positions both arrays have; NULL products are skipped as SUM would."""
    products = F.zip_with(a, b, lambda x, y: x * y)
    return F.aggregate(
        products, F.lit(0.0), lambda total, p: total + F.coalesce(p, F.lit(0.0))
    )


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def densify(entries: Column, size: int, fill: float | None = 0.0) -> Column:
    """Turn ``array<struct<idx, value>>`` into ``array<double>`` of ``size``, placed by idx.

    A complete sorted list is taken as it is. Otherwise gaps become ``fill``, repeated indices are
    summed and indices outside ``0..size-1`` are ignored, so a gap never shifts later elements.
    """
    if size < 1:
        raise ValueError("size must be positive")
    positions = F.sequence(F.lit(0), F.lit(size - 1))
    empty = F.lit(fill).cast("double")

    def place(sorted_entries: Column) -> Column:
        def element(i: Column) -> Column:
            here = F.filter(sorted_entries, lambda e: e["idx"] == i)
            total = F.aggregate(
                here,
                F.lit(None).cast("double"),
                lambda acc, e: F.coalesce(acc + e["value"], e["value"], acc),
            )
            return F.coalesce(total, empty)

        complete = F.transform(sorted_entries, lambda e: e["idx"].cast("int")) == positions
        has_null = F.exists(sorted_entries, lambda e: e["value"].isNull())
        return F.when(
            complete & ~has_null, F.transform(sorted_entries, lambda e: e["value"])
        ).otherwise(F.transform(positions, element))

    return bind(F.sort_array(entries), place)


def softmax_array(logits: Column) -> Column:
    """Softmax shifted by the largest logit, so large logits do not overflow."""

    def divide(exps: Column) -> Column:
        total = F.aggregate(exps, F.lit(0.0), lambda acc, e: acc + e)
        return bind(total, lambda t: F.transform(exps, lambda e: e / t))

    def shift(top: Column) -> Column:
        return bind(F.transform(logits, lambda z: F.exp(z - top)), divide)

    return bind(F.array_max(logits), shift)


def argmax_array(scores: Column) -> Column:
    """Position of the largest score, the lowest position when scores tie."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def dense_forward(x: Column, layers: Column) -> Column:
    """Logits of a whole network as one fold over ``array<struct<units, relu>>``.

    The fold binds each layer's output to a lambda variable. One projection per layer would let the
    optimizer inline a layer inside the next layer's lambda and evaluate it once per neuron.
    """

    def apply_layer(activation: Column, layer: Column) -> Column:
        def unit(u: Column) -> Column:
            z = dot_product(u["w"], activation) + u["b"]
            return F.when(layer["relu"], relu_column(z)).otherwise(z)

        return F.transform(layer["units"], unit)

    return F.aggregate(layers, x, apply_layer)
