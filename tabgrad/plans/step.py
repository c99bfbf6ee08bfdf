"""One training step, as joins or as matrix kernels."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabgrad.operators.codec import collect_weights
from tabgrad.operators.gradients import (
    backprop_linear,
    batch_count,
    bias_gradient,
    output_gradient,
    relu_backward,
    weight_gradient,
)
from tabgrad.operators.layers import (
    PACK_WIDTH,
    linear_packed,
    pack_by_input,
    relu,
    softmax,
    weighted_sums,
)
from tabgrad.operators.metrics import loss_and_accuracy, score_samples
from tabgrad.operators.optim import update_biases, update_weights
from tabgrad.operators.tagged import tagged_union
from tabgrad.plans.forward import (
    broadcast_matrices,
    choose_strategy,
    gather_vectors,
    layer_pre,
    tail_of,
)
from tabgrad.plans.kernels import (
    GRADIENT_SCHEMA,
    Matrices,
    hidden_deltas,
    partial_gradients,
    sum_blocks,
    sum_groups,
    to_lists,
    to_matrix,
)
from tabgrad.plans.model import Model
from tabgrad.schema import checked_label, known_elements
from tabgrad.sources.store import materialize

FAN_IN = 64  # tasks whose gradients are added up before their sum moves on
BLOCK_SIZE = 1 << 13  # parameters per block: 64 KiB from each task to the block's sum


@dataclass(frozen=True)
class Step:
    """Gradients per parameter and the batch metrics, both from the parameters before the update."""

    weight_grads: DataFrame  # (layer, output_idx, input_idx, grad)
    bias_grads: DataFrame  # (layer, output_idx, grad)
    metrics: DataFrame  # one row (loss, accuracy)


def _packed(width: int) -> int | None:
    return width if width <= PACK_WIDTH else None


def labelled_samples(samples: DataFrame, labels: DataFrame, n_classes: int) -> DataFrame:
    """``samples`` with ``true_label``; one that has no label, or no class, fails the step."""
    kept = [c for c in samples.columns if c != "true_label"]
    return samples.join(labels.select("sample_id", "true_label"), "sample_id", "left").select(
        *kept, checked_label(n_classes).alias("true_label")
    )


def relational_step(features: DataFrame, labels: DataFrame, model: Model) -> Step:
    """Forward and backward pass as joins and aggregations; nothing reaches the driver.

    States and gradients of a layer are read more than once, so each is written once.
    """
    features = known_elements(features, model.layers[0])
    labels = labelled_samples(features.select("sample_id").distinct(), labels, model.n_classes)
    inputs, x = [features], features
    for layer in range(1, model.n_layers + 1):
        pre = layer_pre(x, model, layer)
        x = materialize(relu(pre) if layer < model.n_layers else pre, f"state{layer}")
        inputs.append(x)
    logits = x.select("sample_id", F.col("idx").alias("class_idx"), F.col("z").alias("logit"))
    probabilities = softmax(logits)
    n = batch_count(labels).scalar()
    grad = materialize(output_gradient(probabilities, labels), "gradient")
    weight_parts, bias_parts = [], []
    for layer in range(model.n_layers, 0, -1):
        width = model.layers[layer]
        tag = F.lit(layer).alias("layer")
        # Only the input rows of a sample have no bound on their number.
        parts = weight_gradient(grad, inputs[layer - 1], n, _packed(width), bounded=layer > 1)
        weight_parts.append(parts.select(tag, "*"))
        bias_parts.append(bias_gradient(grad, n).select(tag, "*"))
        if layer > 1:
            passed = backprop_linear(
                grad, model.layer_params(layer), model.layers[layer - 1], width
            )
            grad = materialize(relu_backward(passed, inputs[layer - 1]), "gradient")
    return Step(
        reduce(DataFrame.unionByName, weight_parts[::-1]),
        reduce(DataFrame.unionByName, bias_parts[::-1]),
        loss_and_accuracy(score_samples(probabilities, labels)),
    )


def hybrid_step(
    features: DataFrame,
    labels: DataFrame,
    units: DataFrame,
    bias: DataFrame,
    tail: Model,
    n_inputs: int | None = None,
) -> Step:
    """A step for feature rows: joins for the first layer, matrix kernels for the layers after it.

    ``units`` is the first layer packed by input, ``(input_idx, ws)``, and may be larger than any
    task. Work follows the elements that exist. First-layer gradients come only for inputs seen.
    """
    width = tail.layers[0]
    if n_inputs is not None:
        features = known_elements(features, n_inputs)
    hidden = linear_packed(features, units, bias, width, n_inputs)
    hidden = labelled_samples(hidden, labels, tail.n_classes)
    hidden = materialize(hidden.select("sample_id", "z", "true_label"), "hidden")
    active = F.transform("z", lambda z: F.greatest(F.lit(0.0), z))
    rest = arrow_step(hidden.select(active.alias("x"), "true_label"), tail)
    matrices = broadcast_matrices(tail)

    @F.arrow_udf("array<double>")
    def deltas(z: pa.Array, label: pa.Array) -> pa.Array:
        return to_lists(hidden_deltas(to_matrix(z, width), np.asarray(label), matrices.value))

    per_sample = hidden.select("sample_id", deltas("z", "true_label").alias("ws"))
    n = batch_count(hidden).scalar()
    value = F.coalesce("value", F.lit(0.0)).alias("value")
    rows = features.select("sample_id", F.col("idx").alias("input_idx"), value)
    sums = weighted_sums(rows, per_sample, "sample_id", "input_idx", width)
    first = F.lit(1).alias("layer")
    weight_grads = sums.select(
        first, "input_idx", F.posexplode("sums").alias("output_idx", "_sum")
    ).select("layer", "output_idx", "input_idx", (F.col("_sum") / n).alias("grad"))
    bias_sums = ", ".join(f"sum(ws[{k}])" for k in range(width))
    bias_grads = (
        per_sample.agg(F.expr(f"array({bias_sums})").alias("sums"))
        .select(first, F.posexplode_outer("sums").alias("output_idx", "_sum"))
        .select("layer", "output_idx", (F.col("_sum") / n).alias("grad"))
    )
    shift = (F.col("layer") + 1).alias("layer")
    return Step(
        weight_grads.unionByName(rest.weight_grads.select(shift, "output_idx", "input_idx", "grad")),
        bias_grads.unionByName(rest.bias_grads.select(shift, "output_idx", "grad")),
        rest.metrics,
    )


def train_step(features: DataFrame, labels: DataFrame, model: Model, strategy: str = "auto") -> Step:
    """One step from feature rows, with the plan that ``choose_strategy`` gives for scoring them.

    ``arrow`` gathers each sample's vector, once, for the matrix kernels.
    """
    strategy = choose_strategy(model) if strategy == "auto" else strategy
    if strategy == "arrow":
        vectors = labelled_samples(gather_vectors(features, model.layers[0]), labels, model.n_classes)
        return arrow_step(vectors, model)
    if strategy == "relational":
        return relational_step(features, labels, model)
    if strategy != "hybrid":
        raise ValueError(f"unknown step strategy {strategy!r}")
    units = pack_by_input(model.layer_params(1), model.layers[1])
    bias = model.layer_biases(1)
    return hybrid_step(features, labels, units, bias, tail_of(model), model.layers[0])


def gradient_blocks(rows: DataFrame, model_matrices, block_size: int = BLOCK_SIZE) -> DataFrame:
    """Summed gradient of ``(x, true_label)`` rows, as one row per block of parameters.

    Each task adds up its own rows and emits one vector, cut into blocks. The blocks are summed in
    two levels, FAN_IN tasks at a time and then their sums, in slice order: a task reads FAN_IN rows
    of a block or one for each group, and a partitioning always gives the same sum.
    ``model_matrices`` is a broadcast of ``Model.matrices()``.
    """
    def partials(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return partial_gradients(batches, model_matrices.value, block_size)

    parts = rows.select("x", F.col("true_label").cast("int").alias("true_label")).mapInArrow(
        partials, GRADIENT_SCHEMA
    )
    group = F.expr(f"slice div {FAN_IN}").cast("int")
    grouped = parts.withColumn("group", group).repartition("block", "group")
    sums = grouped.sortWithinPartitions("block", "group", "slice").mapInArrow(sum_groups, GRADIENT_SCHEMA)
    spread = sums.repartition("block").sortWithinPartitions("block", "slice")
    return spread.mapInArrow(sum_blocks, GRADIENT_SCHEMA)


def unflatten(grad: np.ndarray, matrices: Matrices) -> list[tuple[np.ndarray, np.ndarray]]:
    """Flat gradient (W then b, layer by layer) to pairs shaped like ``matrices``."""
    result, at = [], 0
    for w, b in matrices:
        dw = grad[at : at + w.size].reshape(w.shape)
        at += w.size
        result.append((dw, grad[at : at + b.size]))
        at += b.size
    return result


def arrow_step(rows: DataFrame, model: Model, block_size: int = BLOCK_SIZE) -> Step:
    """The same step from ``(x, true_label)`` rows with matrix kernels; gradients stay in Spark."""
    matrices = rows.sparkSession.sparkContext.broadcast(model.matrices())
    blocks = materialize(gradient_blocks(rows, matrices, block_size), "gradients")
    n = F.nullif(F.sum("n"), F.lit(0))
    totals = blocks.agg(n.alias("n"))
    metrics = blocks.agg(
        (F.sum("loss_sum") / n).alias("loss"), (F.sum("correct").cast("double") / n).alias("accuracy")
    )
    flat = blocks.select("block", F.posexplode("grad").alias("_place", "_sum")).select(
        (F.col("block").cast("bigint") * block_size + F.col("_place")).alias("_at"),
        (F.col("_sum") / totals.scalar()).alias("grad"),
    )
    weight_parts, bias_parts, start = [], [], 0
    for layer, (fan_in, fan_out) in enumerate(zip(model.layers, model.layers[1:]), start=1):
        split, end = start + fan_in * fan_out, start + fan_in * fan_out + fan_out
        at = F.col("_at") - start
        position = [
            F.lit(layer).alias("layer"),
            ((at - at % fan_in) / fan_in).cast("int").alias("output_idx"),
            (at % fan_in).cast("int").alias("input_idx"),
        ]
        weight_parts.append(_between(flat, start, split).select(*position, "grad"))
        neuron = (F.col("_at") - split).cast("int").alias("output_idx")
        bias_parts.append(_between(flat, split, end).select(position[0], neuron, "grad"))
        start = end
    return Step(
        reduce(DataFrame.unionByName, weight_parts),
        reduce(DataFrame.unionByName, bias_parts),
        metrics,
    )


def _between(flat: DataFrame, start: int, end: int) -> DataFrame:
    return flat.filter((F.col("_at") >= start) & (F.col("_at") < end))


def apply_step(model: Model, step: Step, lr: float) -> Model:
    """The model after one plain SGD update."""
    return Model(
        model.layers,
        update_weights(model.params, step.weight_grads, lr),
        update_biases(model.biases, step.bias_grads, lr),
    )


def gradient_rows(step: Step, n_layers: int) -> DataFrame:
    """Tagged union of a step's gradients and metrics: ``(kind, output_idx, input_idx, grad, loss, accuracy)``."""
    parts: dict[str, DataFrame] = {}
    for layer in range(1, n_layers + 1):
        here = F.col("layer") == layer
        parts[f"grad_w{layer}"] = step.weight_grads.filter(here).drop("layer")
        parts[f"grad_b{layer}"] = step.bias_grads.filter(here).drop("layer")
    parts["metrics"] = step.metrics
    return tagged_union(parts)


def parameter_rows(model: Model, step: Step, lr: float) -> DataFrame:
    """Tagged union of the updated parameters and the metrics: ``(kind, output_idx, weights, bias_value, loss, accuracy)``."""
    updated = apply_step(model, step, lr)
    parts: dict[str, DataFrame] = {}
    for layer in range(1, model.n_layers + 1):
        parts[f"weights_fc{layer}"] = collect_weights(updated.layer_params(layer))
        parts[f"biases_fc{layer}"] = updated.layer_biases(layer).withColumnRenamed("b", "bias_value")
    parts["metrics"] = step.metrics
    return tagged_union(parts)

