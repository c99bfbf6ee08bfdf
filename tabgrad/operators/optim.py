"""Parameter updates.

A parameter without a gradient keeps its value. An absent one is 0.0, and a gradient brings it in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

POSITION = ("layer", "output_idx", "input_idx")


def _positions(params: DataFrame, grads: DataFrame) -> list[str]:
    return [c for c in POSITION if c in params.columns and c in grads.columns]


def _sgd(params: DataFrame, grads: DataFrame, value: str, lr: float) -> DataFrame:
    keys = _positions(params, grads)
    step = F.coalesce(F.col("grad"), F.lit(0.0)) * lr
    return params.join(grads.select(*keys, "grad"), keys, "full_outer").select(
        *(c for c in params.columns if c != value),
        (F.coalesce(F.col(value), F.lit(0.0)) - step).alias(value),
    )


def update_weights(params: DataFrame, grads: DataFrame, lr: float = 0.01) -> DataFrame:
    return _sgd(params, grads, "w", lr)


def update_biases(biases: DataFrame, grads: DataFrame, lr: float = 0.01) -> DataFrame:
    return _sgd(biases, grads, "b", lr)


def momentum_update(
    params: DataFrame,
    velocity: DataFrame | None,
    grads: DataFrame,
    lr: float = 0.001,
    momentum: float = 0.9,
    value: str = "w",
) -> DataFrame:
    """``v' = momentum * v + grad``, ``p' = p - lr * v'``; both come back, ``v'`` as ``velocity``.

    Pass the result's key columns and ``velocity`` to the next call.
    """
    keys = _positions(params, grads)
    joined = params.join(grads.select(*keys, "grad"), keys, "full_outer")
    if velocity is None:
        old = F.lit(0.0)
    else:
        joined = joined.join(velocity.select(*keys, "velocity"), keys, "full_outer")
        old = F.coalesce(F.col("velocity"), F.lit(0.0))
    new = old * momentum + F.coalesce(F.col("grad"), F.lit(0.0))
    moved = joined.withColumn("_new", new)
    return moved.select(
        *(c for c in params.columns if c != value),
        (F.coalesce(F.col(value), F.lit(0.0)) - F.col("_new") * lr).alias(value),
        F.col("_new").alias("velocity"),
    )
