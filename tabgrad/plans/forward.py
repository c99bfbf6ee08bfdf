"""Whole-network scoring, with several physical plans behind one call."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabgrad.functions.arrays import argmax_array, dense_forward, softmax_array
from tabgrad.operators.codec import pixels_to_array, sum_repeats
from tabgrad.operators.layers import (
    PACK_WIDTH,
    add_bias,
    linear,
    linear_packed,
    lookup_sample,
    pack_by_input,
    predictions,
    relu,
    softmax,
)
from tabgrad.operators.metrics import clamped_loss, flag, score_samples
from tabgrad.plans.kernels import (
    grade_rows,
    merge_entries,
    partial_entries,
    partial_products,
    place_entries,
    predict_rows,
    run_layers,
    to_lists,
    to_matrix,
)
from tabgrad.plans import model as model_limits
from tabgrad.plans.model import Model
from tabgrad.schema import known_elements
from tabgrad.sources.readers import features_from_vectors


def choose_row_strategy(model: Model) -> str:
    """Plan for rows that carry a feature array: matrix kernels, or tables for a larger model."""
    return "arrow" if model.fits_in_task() else "tables"


def choose_strategy(model: Model) -> str:
    """Plan for feature rows: matrix kernels where every task can hold the model."""
    if model.fits_in_task():
        return "arrow"
    tail_bytes = 8 * sum(i * o + o for i, o in zip(model.layers[1:], model.layers[2:]))
    hybrid = model.layers[1] <= PACK_WIDTH and tail_bytes <= model_limits.DENSE_BYTES
    return "hybrid" if hybrid else "relational"


def score(
    df: DataFrame, model: Model, features: str = "x", out: str = "logits", strategy: str = "auto"
) -> DataFrame:
    """Add an array of logits to rows that carry a feature array. No shuffle; works on streams.

    ``arrow`` multiplies Arrow batches with numpy; ``dense`` is one JVM expression without Python
    workers. ``tables`` is for models that no task should hold: it takes the rows apart and joins
    their logits to them by ``sample_id``, which must be unique.
    """
    strategy = choose_row_strategy(model) if strategy == "auto" else strategy
    if strategy == "tables":
        gathered = _table_logits(df, model, features).groupBy("sample_id").agg(
            F.sort_array(F.collect_list(F.struct("class_idx", "logit"))).alias("_entries")
        )
        logits = gathered.select("sample_id", F.col("_entries.logit").alias(out))
        return df.join(logits, "sample_id", "left").select(*df.columns, out)
    if strategy == "arrow":
        # The second argument keeps the optimizer from inlining a lambda expression that produces
        # the features into the UDF call, which Spark then fails to evaluate.
        return df.withColumn(out, _matrix_udf(model)(F.col(features), F.size(features)))
    if strategy == "dense":
        with_layers = df.withColumn("_layers", model.dense_layers().scalar())
        logits = dense_forward(F.col(features), F.col("_layers"))
        return with_layers.withColumn(out, logits).drop("_layers")
    raise ValueError(f"row scoring has no strategy {strategy!r}; use forward() on feature rows")


def _table_logits(df: DataFrame, model: Model, features: str) -> DataFrame:
    """Logits of rows that carry a feature array, from the joins of ``forward``."""
    if "sample_id" not in df.columns:
        raise ValueError("scoring with a model of this size needs the rows' sample_id")
    strategy = choose_strategy(model)
    rows = features_from_vectors(df, "sample_id", checked_vector(features, model.layers[0]))
    return forward(rows, model, "relational" if strategy == "arrow" else strategy)


def checked_vector(features: str, width: int):
    """The vector; a row with one of another width fails the job that reads it."""
    message = F.lit(f"every sample needs a vector of {width} elements")
    return F.when(F.size(features) == width, F.col(features)).otherwise(
        F.raise_error(message).cast("array<double>")
    )


def broadcast_matrices(model: Model):
    return model.params.sparkSession.sparkContext.broadcast(model.matrices())


def _matrix_udf(model: Model):
    width = model.layers[0]
    matrices = broadcast_matrices(model)

    @F.arrow_udf("array<double>")
    def logits(x: pa.Array, length: pa.Array) -> pa.Array:
        _, pre = run_layers(to_matrix(x, width), matrices.value)
        return to_lists(pre[-1])

    return logits


def _entries_udf(model: Model, result, return_type: str):
    """UDF over gathered (idx, value) lists; ``result`` maps layer inputs and pre-activations to Arrow."""
    width = model.layers[0]
    matrices = broadcast_matrices(model)

    @F.arrow_udf(return_type)
    def run(idx: pa.Array, value: pa.Array) -> pa.Array:
        return result(*run_layers(place_entries(idx, value, width), matrices.value))

    return run


def gather_entries(features: DataFrame, unique: bool = False) -> DataFrame:
    """``(sample_id, entries)``: the elements of each sample, in any order.

    Repeats are summed first, so a group never exceeds the width of the input layer.
    """
    rows = features if unique else sum_repeats(features)
    entries = F.collect_list(F.struct("idx", "value")).alias("entries")
    return rows.groupBy("sample_id").agg(entries)


def gather_vectors(features: DataFrame, width: int) -> DataFrame:
    """``(sample_id, x)`` with gaps filled and repeats summed.

    The elements of a sample become lists where they are read. One shuffle brings the lists of a
    sample together, and a kernel adds them up one after the other, so no group is ever held.
    """
    known = known_elements(features, width)
    sample_id = T.StructField("sample_id", known.schema["sample_id"].dataType)
    rows = known.select(
        "sample_id", F.col("idx").cast("int").alias("idx"), F.col("value").cast("double").alias("value")
    )

    def partials(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return partial_entries(batches, width)

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return merge_entries(batches, width)

    doubles = T.ArrayType(T.DoubleType())
    lists = T.StructType([sample_id]).add("idx", T.ArrayType(T.IntegerType())).add("value", doubles)
    spread = rows.mapInArrow(partials, lists).repartition("sample_id")
    vectors = T.StructType([sample_id]).add("x", doubles)
    return spread.sortWithinPartitions("sample_id").mapInArrow(merged, vectors)


def score_predictions(
    df: DataFrame, model: Model, features: str = "x", strategy: str = "auto"
) -> DataFrame:
    """Add prediction, its logit and its probability to each row, without a shuffle."""
    strategy = choose_row_strategy(model) if strategy == "auto" else strategy
    if strategy == "arrow":
        width, matrices = model.layers[0], broadcast_matrices(model)

        @F.arrow_udf("prediction int, logit double, probability double")
        def predict(x: pa.Array, length: pa.Array) -> pa.Array:
            return predict_rows(run_layers(to_matrix(x, width), matrices.value)[1][-1])

        scored = df.withColumn("_scored", predict(F.col(features), F.size(features)))
        return scored.select(*df.columns, "_scored.prediction", "_scored.logit", "_scored.probability")
    if strategy == "tables":
        best = predictions(_table_logits(df, model, features))
        return df.join(best, "sample_id", "left").select(*df.columns, "prediction", "logit", "probability")
    scored = score(df, model, features, "_logits", strategy)
    logits = F.col("_logits")
    return scored.select(
        *df.columns,
        argmax_array(logits).alias("prediction"),
        F.array_max(logits).alias("logit"),
        F.array_max(softmax_array(logits)).alias("probability"),
    )


def score_labelled(rows: DataFrame, model: Model, strategy: str = "auto") -> DataFrame:
    """Add prediction, loss and correctness to ``(x, true_label)`` rows, without a shuffle."""
    strategy = choose_row_strategy(model) if strategy == "auto" else strategy
    if strategy == "arrow":
        width, matrices = model.layers[0], broadcast_matrices(model)

        @F.arrow_udf("prediction int, p_true double")
        def grade(x: pa.Array, length: pa.Array, label: pa.Array) -> pa.Array:
            return grade_rows(run_layers(to_matrix(x, width), matrices.value)[1][-1], label)

        graded = rows.withColumn("_graded", grade("x", F.size("x"), F.col("true_label").cast("int")))
        scored = graded.select(*rows.columns, "_graded.prediction", "_graded.p_true")
    elif strategy == "tables":
        probabilities = softmax(_table_logits(rows, model, "x"))
        graded = score_samples(probabilities, rows.select("sample_id", "true_label"))
        scored = rows.join(graded.select("sample_id", "prediction", "p_true"), "sample_id", "left")
        scored = scored.select(*rows.columns, "prediction", "p_true")
    else:
        with_logits = score(rows, model, "x", "_logits", strategy)
        scored = with_logits.select(
            *rows.columns,
            argmax_array(F.col("_logits")).alias("prediction"),
            F.get(softmax_array(F.col("_logits")), F.col("true_label")).alias("p_true"),
        )
    p_true = F.col("p_true")
    return scored.withColumn(
        "loss", F.when(p_true.isNotNull(), clamped_loss(p_true))
    ).withColumn("correct", flag(F.col("prediction") == F.col("true_label")))


def explode_logits(df: DataFrame, logits: str = "logits") -> DataFrame:
    # The outer form keeps the optimizer from adding a size filter that would score rows twice.
    return df.select("sample_id", F.posexplode_outer(logits).alias("class_idx", "logit"))


def forward_rows(df: DataFrame, model: Model, features: str = "x", strategy: str = "auto") -> DataFrame:
    """``(sample_id, class_idx, logit)`` from rows that carry a feature array, without a shuffle."""
    return explode_logits(score(df.select("sample_id", features), model, features, strategy=strategy))


def forward(
    features: DataFrame, model: Model, strategy: str = "auto", unique: bool = False
) -> DataFrame:
    """``(sample_id, class_idx, logit)`` from feature rows, for any number of layers.

    ``arrow`` multiplies elements by the first layer where they are read and shuffles the sums of
    each sample, then runs the other layers on one short array per sample. ``hybrid`` is the same
    with a join for a first layer that no task should hold. ``relational`` joins and aggregates
    every layer. ``dense`` gathers vectors and needs no Python workers; ``unique`` says that no
    (sample_id, idx) occurs twice, which saves it a shuffle.
    """
    strategy = choose_strategy(model) if strategy == "auto" else strategy
    features = known_elements(features, model.layers[0])
    if strategy == "relational":
        last = layer_states(features, model)[-1]
        return last.select("sample_id", F.col("idx").alias("class_idx"), F.col("z").alias("logit"))
    if strategy == "hybrid":
        first = model.layers[1]
        units = pack_by_input(model.layer_params(1), first)
        return forward_from_units(features, units, model.layer_biases(1), tail_of(model), model.layers[0])
    if strategy == "arrow":
        return forward_after(first_products(features, model), tail_of(model))
    if strategy == "dense":
        vectors = pixels_to_array(features, model.layers[0], unique=unique)
        return explode_logits(score(vectors, model, strategy="dense"))
    raise ValueError(f"unknown strategy {strategy!r}")


def score_sample(features: DataFrame, model: Model, sample_id: int) -> DataFrame:
    """Logits of one sample by class, reading and scoring no other: a kernel hides later filters."""
    return lookup_sample(forward(features.filter(F.col("sample_id") == sample_id), model), sample_id)


def tail_of(model: Model) -> Model:
    """The network after its first layer."""
    return Model(
        model.layers[1:],
        model.params.filter("layer > 1").withColumn("layer", F.col("layer") - 1),
        model.biases.filter("layer > 1").withColumn("layer", F.col("layer") - 1),
        None if model.dense is None else model.dense[1:],
    )


def forward_from_units(
    features: DataFrame, units: DataFrame, bias: DataFrame, tail: Model, n_inputs: int | None = None
) -> DataFrame:
    """Logits when the first layer is too wide to gather: ``units`` is ``(input_idx, ws)``.

    Work is proportional to the elements that exist, and the wide layer is never held in one place.
    """
    return forward_after(linear_packed(features, units, bias, tail.layers[0], n_inputs), tail)


def first_products(features: DataFrame, model: Model) -> DataFrame:
    """``(sample_id, z)`` of the first layer: products in the scan's tasks, then the sums of each sample.

    A row of products holds a block of at most PACK_WIDTH outputs, and the plan has as many sums,
    whatever the width of the layer. A layer of one block is summed by one shuffle; the summed blocks
    of a wider one are brought together by another, as many rows for each sample as it has blocks.
    """
    width = model.layers[1]
    block_width = min(width, PACK_WIDTH)
    weights = model.params.sparkSession.sparkContext.broadcast(
        np.ascontiguousarray(model.matrices()[0][0].T)
    )

    def partials(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return partial_products(batches, weights.value, block_width)

    rows = features.select(F.col("sample_id").cast("bigint").alias("sample_id"), "idx", "value")
    parts = rows.mapInArrow(partials, "sample_id bigint, block int, ws array<double>")
    keys = ["sample_id"] if width == block_width else ["sample_id", "block"]
    sums = ", ".join(f"sum(ws[{k}])" for k in range(block_width))
    summed = parts.groupBy(*keys).agg(F.expr(f"array({sums})").alias("sums"))
    if width > block_width:
        blocks = F.sort_array(F.collect_list(F.struct("block", "sums")))
        joined = summed.groupBy("sample_id").agg(blocks.alias("blocks"))
        summed = joined.select("sample_id", F.slice(F.flatten("blocks.sums"), 1, width).alias("sums"))
    return add_bias(summed, model.layer_biases(1), width)


def forward_after(hidden: DataFrame, tail: Model) -> DataFrame:
    """Logits from first-layer pre-activations ``(sample_id, z)`` and the layers after it."""
    if tail.n_layers == 0:
        return explode_logits(hidden, "z")
    active = F.transform("z", lambda z: F.greatest(F.lit(0.0), z))
    return explode_logits(score(hidden.select("sample_id", active.alias("x")), tail))


def layer_pre(x: DataFrame, model: Model, layer: int) -> DataFrame:
    """``(sample_id, idx, z)`` of one layer from the rows that feed it."""
    width = model.layers[layer]
    return linear(
        x.select("sample_id", "idx", "value"),
        model.layer_params(layer),
        model.layer_biases(layer),
        width if width <= PACK_WIDTH else None,
        model.layers[layer - 1],
    )


def layer_states(features: DataFrame, model: Model) -> list[DataFrame]:
    """Per layer ``(sample_id, idx, value, z)``; the last layer's value is its raw logit."""
    states = []
    x = known_elements(features, model.layers[0])
    for layer in range(1, model.n_layers + 1):
        pre = layer_pre(x, model, layer)
        if layer < model.n_layers:
            state = relu(pre)
        else:
            state = pre.select("sample_id", "idx", F.col("z").alias("value"), "z")
        states.append(state)
        x = state
    return states


def layer_outputs(
    features: DataFrame,
    model: Model,
    layer: int | None = None,
    first: int | None = None,
    unique: bool = False,
) -> DataFrame:
    """Hidden activations ``(sample_id, layer, idx, value)``, of one layer or all, optionally idx < first."""
    hidden = range(1, model.n_layers) if layer is None else [layer]
    if not model.fits_in_task():
        states = layer_states(features, model)
        parts = [states[k - 1].select("sample_id", F.lit(k).alias("layer"), "idx", "value") for k in hidden]
        rows = reduce(DataFrame.unionByName, parts)
        return rows if first is None else rows.filter(F.col("idx") < first)

    def activations(inputs: list[np.ndarray], pre: list[np.ndarray]) -> pa.Array:
        wanted = [inputs[k] for k in hidden]
        n, sizes = len(inputs[0]), [m.shape[1] for m in wanted]
        flat = np.concatenate(wanted, axis=1).ravel()
        inner = np.concatenate([[0], np.cumsum(np.tile(sizes, n))]).astype(np.int32)
        outer = np.arange(0, n * len(sizes) + 1, len(sizes), dtype=np.int32)
        lists = pa.ListArray.from_arrays(pa.array(inner), pa.array(flat))
        return pa.ListArray.from_arrays(pa.array(outer), lists)

    known = known_elements(features, model.layers[0])
    values = _entries_udf(model, activations, "array<array<double>>")
    vectors = gather_entries(known, unique).withColumn("_layers", values("entries.idx", "entries.value"))
    rows = (
        vectors.select("sample_id", F.posexplode_outer("_layers").alias("_k", "_values"))
        .select("sample_id", "_k", F.posexplode("_values").alias("idx", "value"))
        .select("sample_id", (F.col("_k") + min(hidden)).alias("layer"), "idx", "value")
    )
    return rows if first is None else rows.filter(F.col("idx") < first)
