"""Backward operators. Gradients with respect to pre-activations are ``(sample_id, idx, g)``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabgrad.operators.layers import PACK_WIDTH, pack, pack_params, weighted_sums
from tabgrad.plans.joins import broadcast_within


def one_hot(labels: DataFrame, n_classes: int) -> DataFrame:
    """``(sample_id, class_idx, target)`` with one row per sample and class."""
    classes = F.explode(F.sequence(F.lit(0), F.lit(n_classes - 1))).alias("class_idx")
    hit = F.col("class_idx") == F.col("true_label")
    return labels.select("sample_id", "true_label", classes).select(
        "sample_id", "class_idx", F.when(hit, 1.0).otherwise(0.0).alias("target")
    )


def output_gradient(probabilities: DataFrame, labels: DataFrame) -> DataFrame:
    """Gradient of cross-entropy after softmax: probability minus the one-hot target."""
    target = F.when(F.col("class_idx") == F.col("true_label"), 1.0).otherwise(0.0)
    return probabilities.join(labels, "sample_id").select(
        "sample_id", F.col("class_idx").alias("idx"), (F.col("probability") - target).alias("g")
    )


def batch_count(labels: DataFrame) -> DataFrame:
    """One row with ``n``, the number of samples; ``.scalar()`` makes it a divisor."""
    return labels.agg(F.count(F.lit(1)).alias("n"))


def weight_gradient(
    grad: DataFrame,
    activations: DataFrame,
    n: int | Column,
    width: int | None = None,
    bounded: bool = True,
) -> DataFrame:
    """``(output_idx, input_idx, grad)`` with ``grad = SUM_s g[s, o] * a[s, i] / n``.

    With ``width`` outputs known each activation row updates that many running sums per input, and
    the pairs of a sample's outer product are never written out. There is a row for each pair that
    some sample has, whatever the width. Set ``bounded=False`` when a sample
    may have very many elements, so that such samples are spread over tasks.
    """
    value = F.coalesce("value", F.lit(0.0)).alias("value")
    rows = activations.select("sample_id", F.col("idx").alias("input_idx"), value)
    if width is not None and width <= PACK_WIDTH:
        units = pack(grad, "sample_id", "idx", "g", width)
        sums = weighted_sums(rows, units, "sample_id", "input_idx", width, bounded=bounded)
        long = sums.select("input_idx", F.posexplode("sums").alias("output_idx", "_sum"))
        long = long.filter("_sum is not null")
    else:
        long = (
            grad.select("sample_id", F.col("idx").alias("output_idx"), "g")
            .join(rows, "sample_id")
            .groupBy("output_idx", "input_idx")
            .agg(F.sum(F.col("g") * F.col("value")).alias("_sum"))
        )
    return long.select("output_idx", "input_idx", (F.col("_sum") / n).alias("grad"))


def bias_gradient(grad: DataFrame, n: int | Column) -> DataFrame:
    """``(output_idx, grad)`` with ``grad = SUM_s g[s, o] / n``."""
    return (
        grad.groupBy(F.col("idx").alias("output_idx"))
        .agg(F.sum("g").alias("_sum"))
        .select("output_idx", (F.col("_sum") / n).alias("grad"))
    )


def backprop_linear(
    grad: DataFrame, params: DataFrame, n_inputs: int | None = None, n_outputs: int | None = None
) -> DataFrame:
    """Gradient with respect to a layer's inputs: ``SUM_o g[s, o] * w[o, i]`` as ``(sample_id, idx, g)``."""
    rows = grad.select("sample_id", F.col("idx").alias("output_idx"), F.col("g").alias("value"))
    if n_inputs is not None and n_inputs <= PACK_WIDTH:
        units = pack_params(params, "output_idx", "input_idx", n_inputs)
        sums = weighted_sums(rows, units, "output_idx", "sample_id", n_inputs, n_outputs)
        return sums.select("sample_id", F.posexplode("sums").alias("idx", "g")).filter("g is not null")
    n_bytes = None if n_inputs is None or n_outputs is None else 24 * n_inputs * n_outputs
    return (
        rows.join(broadcast_within(params, n_bytes), "output_idx")
        .groupBy("sample_id", F.col("input_idx").alias("idx"))
        .agg(F.sum(F.col("value") * F.col("w")).alias("g"))
    )


def relu_backward(grad: DataFrame, state: DataFrame) -> DataFrame:
    """Keep the gradient where the pre-activation is positive, 0.0 elsewhere and at 0."""
    passed = F.when(F.col("z") > 0, F.col("g")).otherwise(0.0)
    return grad.join(state.select("sample_id", "idx", "z"), ["sample_id", "idx"]).select(
        "sample_id", "idx", passed.alias("g")
    )
