"""One query per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabgrad import Model, TrainConfig, fit, fit_features, forward, score, score_predictions
from tabgrad.functions import dot_product
from tabgrad.operators import batching, codec, gradients, layers, metrics, optim, prep, reports, tagged
from tabgrad.plans.fit import best_epoch, epoch_metrics, history_summary, validate
from tabgrad.plans.forward import (
    forward_from_units,
    forward_rows,
    layer_outputs,
    layer_states,
    score_labelled,
    score_sample,
)
from tabgrad.plans.step import (
    arrow_step,
    gradient_rows,
    hybrid_step,
    parameter_rows,
    relational_step,
    train_step,
)
from tabgrad.sources import (
    ModelStore,
    append_history,
    export_params,
    inline_values,
    materialize,
    read_biases,
    read_features,
    read_history,
    read_labels,
    read_params,
    scratch_path,
)
from workloads import tables as t

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

LR = 0.01
LOOKUP_ID = 7
SEED = 42


def query(name: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return register


def r6(column: str) -> Column:
    return F.round(column, 6).alias(column)


def whole_numbers(vector: str, scale: int = 1024) -> Column:
    """A dyadic vector as text of integers, which every engine prints alike."""
    numbers = F.transform(vector, lambda v: (v * scale).cast("bigint").cast("string"))
    return F.array_join(numbers, ",")


def vector_model(spark: SparkSession) -> Model:
    return t.dyadic_model(spark, t.VECTOR_LAYERS)


def vector_logits(spark: SparkSession, sf: str) -> DataFrame:
    return forward(t.vector_features(spark, sf), vector_model(spark))


def order_model(spark: SparkSession, scale: int = 128) -> Model:
    return t.dyadic_model(spark, t.ORDER_LAYERS, scale)


def order_scores(spark: SparkSession, sf: str, scale: int = 128) -> DataFrame:
    """Orders with prediction, logit and probability: a projection over the order rows."""
    return score_predictions(t.order_rows(spark, sf), order_model(spark, scale))


def order_truth(spark: SparkSession, sf: str, scale: int = 128) -> DataFrame:
    """Every order with its prediction; orders without lines have none."""
    return metrics.score_against_truth(t.order_labels(spark, sf), order_scores(spark, sf, scale))


def order_logits(spark: SparkSession, sf: str, scale: int = 128) -> DataFrame:
    return forward_rows(t.order_rows(spark, sf), order_model(spark, scale))


# Scans, encodings, preparation, sinks


def _stored(df: DataFrame, fmt: str) -> str:
    """Write a table as CSV with a header or as JSON; returns the folder."""
    path = scratch_path(df.sparkSession, "input")
    writer = df.write.format(fmt)
    (writer.option("header", True) if fmt == "csv" else writer).save(path)
    return path


@query("scan_features")
def query_scan_features(spark, sf):
    """Features from CSV files with other names and another order of columns."""
    names = {"idx": "pixel_idx", "value": "pixel_value"}
    stored = t.vector_features(spark, sf).select("value", "idx", "sample_id").withColumnsRenamed(names)
    return read_features(spark, _stored(stored, "csv"), "csv", {v: k for k, v in names.items()})


@query("scan_labels")
def query_scan_labels(spark, sf):
    """Labels from JSON files under the names of the table."""
    marks = t.table(spark, sf, "labels").select("quality", "toxic", "doc_id")
    return read_labels(spark, _stored(marks, "json"), "json", {"doc_id": "sample_id", "quality": "true_label"})


@query("scan_params")
def query_scan_params(spark, sf):
    """Weights from CSV files and biases from JSON files."""
    stored = t.prototype_params(spark, sf).select("w", "input_idx", "layer", "output_idx")
    weights = read_params(spark, _stored(stored.withColumnRenamed("w", "weight_value"), "csv"), "csv", {"weight_value": "w"})
    biases = read_biases(spark, _stored(t.prototype_biases(spark, sf), "json"), "json")
    rows = weights.withColumnRenamed("w", "value").unionByName(
        biases.withColumnRenamed("b", "value"), allowMissingColumns=True
    )
    return rows.withColumns({c: F.col(c).cast("bigint") for c in ("output_idx", "input_idx")})


@query("decode_vector")
def query_decode_vector(spark, sf):
    text = t.vector_rows(spark, sf).select("sample_id", F.to_json("x").alias("vector"))
    return codec.decode_vector(text, ["sample_id"], "vector")


@query("encode_vector")
def query_encode_vector(spark, sf):
    scaled = t.vector_features(spark, sf).withColumn("value", F.col("value") * 1024)
    return codec.encode_vector(scaled, ["sample_id"], as_json=True)


@query("pixels_to_array")
def query_pixels_to_array(spark, sf):
    present = t.vector_features(spark, sf).filter("value <> 0")
    vectors = codec.pixels_to_array(present, t.VECTOR_LAYERS[0], unique=True)
    return vectors.select("sample_id", whole_numbers("x").alias("x"))


@query("explode_weights")
def query_explode_weights(spark, sf):
    return codec.explode_weights(t.prototype_weights(spark, sf))


WEIGHT_RUN = 256


def _as_text(weights: DataFrame) -> DataFrame:
    inputs = F.array_join(F.transform("inputs", lambda i: i.cast("string")), ",")
    return weights.withColumns({"inputs": inputs, "weights": whole_numbers("weights")})


@query("collect_weights")
def query_collect_weights(spark, sf):
    """Both layers; a neuron of the second has one input per stored vector, so arrays come in runs."""
    return _as_text(codec.collect_weights(t.prototype_params(spark, sf), chunk=WEIGHT_RUN))


@query("normalize_flatten")
def query_normalize_flatten(spark, sf):
    vectors = t.table(spark, sf, "embeddings")
    return prep.normalize_flatten(vectors, "vec_id", F.col("embedding"), *prep.TRAINING_NORMALIZER)


@query("fit_normalizer")
def query_fit_normalizer(spark, sf):
    row = prep.fit_normalizer(t.vector_features(spark, sf))
    return row.select(r6("mean"), r6("std"))


@query("extract_labels")
def query_extract_labels(spark, sf):
    return t.vector_labels(spark, sf)


@query("sample_random")
def query_sample_random(spark, sf):
    labels = t.order_labels(spark, sf)
    n = labels.count()
    return prep.sample_random(labels, n * 5 // 8, n // 8, SEED)


@query("sample_stratified")
def query_sample_stratified(spark, sf):
    labels = t.order_labels(spark, sf)
    n = labels.count()
    return prep.sample_stratified(labels, n // 10, n // 50, SEED)


@query("label_distribution")
def query_label_distribution(spark, sf):
    return prep.label_distribution(t.vector_labels(spark, sf))


@query("xavier_init")
def query_xavier_init(spark, sf):
    n_parts = t.table(spark, sf, "part").count()
    return prep.xavier_init(spark, [n_parts, *t.BASKET_TAIL], SEED).withColumn("w", r6("w"))


@query("zero_init")
def query_zero_init(spark, sf):
    n_vectors = t.table(spark, sf, "embeddings").count()
    return prep.zero_init(spark, [64, n_vectors, 10])


@query("model_summary")
def query_model_summary(spark, sf):
    return prep.model_summary(t.prototype_params(spark, sf), t.prototype_biases(spark, sf))


@query("export_params")
def query_export_params(spark, sf):
    path = scratch_path(spark, "export")
    export_params(t.prototype_params(spark, sf), t.prototype_biases(spark, sf), path, chunk=WEIGHT_RUN)
    weights = _as_text(spark.read.parquet(f"{path}/weights"))
    return weights.join(spark.read.parquet(f"{path}/biases"), ["layer", "output_idx"]).select(
        "layer", "output_idx", "chunk", "inputs", "weights", "b"
    )



@query("materialize")
def query_materialize(spark, sf):
    return materialize(order_logits(spark, sf), "logits")



@query("replace_params")
def query_replace_params(spark, sf):
    """Store the prototypes, then replace them twice by themselves moved along a stored gradient."""
    store = ModelStore(spark, scratch_path(spark, "model"))
    store.save(t.prototype_params(spark, sf), t.prototype_biases(spark, sf))

    def shrink(params: DataFrame, biases: DataFrame) -> tuple[DataFrame, DataFrame]:
        grads = params.withColumnRenamed("w", "grad")
        return optim.update_weights(params, grads, 0.25), biases

    store.replace(shrink)
    store.replace(shrink)
    params, biases = store.load()
    return params.unionByName(biases, allowMissingColumns=True)


def _tagged_parts(spark, sf):
    return {
        "weights": t.prototype_params(spark, sf),
        "biases": t.prototype_biases(spark, sf),
        "metrics": reports.overall_accuracy(order_truth(spark, sf)),
    }


@query("tagged_union")
def query_tagged_union(spark, sf):
    return tagged.tagged_union(_tagged_parts(spark, sf))


@query("demux_tagged")
def query_demux_tagged(spark, sf):
    rows = tagged.tagged_union(_tagged_parts(spark, sf))
    return tagged.demux_tagged(rows, "biases", ["layer", "output_idx", "b"])


@query("inline_values")
def query_inline_values(spark, sf):
    classes = inline_values(spark, t.FLAG_CLASSES, "l_returnflag string, true_label int")
    lines = t.table(spark, sf, "lineitem").join(F.broadcast(classes), "l_returnflag")
    return lines.groupBy("l_returnflag", "true_label").agg(F.count(F.lit(1)).alias("n"))



def _parity(spark, sf):
    """Both models score the same row; only the labels are joined to it."""
    scored = t.order_rows(spark, sf)
    for tag, scale in (("ours", 128), ("theirs", 16)):
        scored = score_predictions(scored, order_model(spark, scale)).withColumnsRenamed(
            {"prediction": f"{tag}_prediction", "logit": f"{tag}_logit", "probability": f"{tag}_probability"}
        )
    return metrics.paired_parity(t.order_labels(spark, sf), scored)


@query("history_sink")
def query_history_sink(spark, sf):
    """Parity rows appended to a CSV history, run by run, and read back with their types."""
    path = scratch_path(spark, "history")
    parity = _parity(spark, sf)
    for run in (1, 2):
        append_history(parity.withColumn("run", F.lit(run)), path)
    schema = "sample_id bigint, true_label int, ours_prediction int, ours_logit double, theirs_prediction int, theirs_logit double, predictions_match int, logit_diff double, ours_correct int, theirs_correct int, run int"
    return read_history(spark, path, schema=schema)


@query("lookup_sample")
def query_lookup_sample(spark, sf):
    return score_sample(t.vector_features(spark, sf), vector_model(spark), LOOKUP_ID)


# Forward


@query("dot_product")
def query_dot_product(spark, sf):
    rows = t.vector_rows(spark, sf)
    return rows.select("sample_id", dot_product(F.col("x"), F.reverse("x")).alias("dot"))



def _first_pre(spark, sf):
    model = vector_model(spark)
    width, n_inputs = model.layers[1], model.layers[0]
    return layers.linear(
        t.vector_features(spark, sf), model.layer_params(1), model.layer_biases(1), width, n_inputs
    )


@query("linear_layer")
def query_linear_layer(spark, sf):
    return _first_pre(spark, sf)


@query("relu")
def query_relu(spark, sf):
    return layers.relu(_first_pre(spark, sf))


@query("linear_relu")
def query_linear_relu(spark, sf):
    model = vector_model(spark)
    return layers.linear_relu(
        t.vector_features(spark, sf), model.layer_params(1), model.layer_biases(1)
    )


def _softmax(method):
    def run(spark, sf):
        probabilities = layers.softmax(order_logits(spark, sf), method)
        return probabilities.withColumn("probability", r6("probability"))

    return run


QUERIES["softmax_naive"] = _softmax("naive")
QUERIES["softmax_stable_join"] = _softmax("join")
QUERIES["softmax_stable_window"] = _softmax("window")


@query("argmax_logit")
def query_argmax_logit(spark, sf):
    return layers.argmax(vector_logits(spark, sf), "logit")


@query("argmax_prob")
def query_argmax_prob(spark, sf):
    best = layers.argmax(layers.softmax(vector_logits(spark, sf)), "probability", "confidence")
    return best.withColumn("confidence", r6("confidence"))


@query("forward_pass")
def query_forward_pass(spark, sf):
    return vector_logits(spark, sf)


@query("forward_pass_relational")
def query_forward_pass_relational(spark, sf):
    return forward(t.vector_features(spark, sf), vector_model(spark), "relational")


@query("forward_pass_hybrid")
def query_forward_pass_hybrid(spark, sf):
    return forward(t.vector_features(spark, sf), vector_model(spark), "hybrid")


@query("forward_pass_dense")
def query_forward_pass_dense(spark, sf):
    return forward(t.vector_features(spark, sf), vector_model(spark), "dense", unique=True)


@query("forward_pass_gaps")
def query_forward_pass_gaps(spark, sf):
    """Absent, NULL and misplaced elements, absent weights and biases."""
    return forward(t.gap_features(spark, sf), t.gap_model(spark))


@query("forward_pass_sparse")
def query_forward_pass_sparse(spark, sf):
    """One input unit per part: the first layer is a join and never held in one place."""
    first = t.dyadic_model(spark, (1, t.BASKET_HIDDEN)).layer_biases(1)
    tail = t.dyadic_model(spark, t.BASKET_TAIL)
    return forward_from_units(t.basket_features(spark, sf), t.basket_units(spark, sf), first, tail)


@query("forward_pass_small")
def query_forward_pass_small(spark, sf):
    return forward(t.vector_features(spark, sf), t.dyadic_model(spark, t.SMALL_LAYERS))


@query("forward_pass_validation")
def query_forward_pass_validation(spark, sf):
    """Logits of the held-out fifth of the orders."""
    features, labels = t.order_features(spark, sf), t.order_labels(spark, sf)
    n = labels.count()
    split = prep.sample_random(labels, n - n // 5, n // 5, SEED).filter("split = 'val'")
    return forward(batching.batch_features(features, split), order_model(spark))


@query("predictions")
def query_predictions(spark, sf):
    best = layers.predictions(vector_logits(spark, sf))
    return best.withColumn("probability", r6("probability")).orderBy("sample_id")


@query("layer_outputs")
def query_layer_outputs(spark, sf):
    return layer_outputs(t.vector_features(spark, sf), vector_model(spark), unique=True)



# Backward and update


def _integer_gradient(spark, sf):
    """One-hot prediction minus one-hot label: an exact stand-in for the output gradient."""
    best = layers.argmax(vector_logits(spark, sf), "logit").select(
        "sample_id", F.col("prediction").alias("true_label")
    )
    hit = gradients.one_hot(best, 10).withColumnRenamed("target", "hit")
    target = gradients.one_hot(t.vector_labels(spark, sf), 10)
    return hit.join(target, ["sample_id", "class_idx"]).select(
        "sample_id", F.col("class_idx").alias("idx"), (F.col("hit") - F.col("target")).alias("g")
    )


def _hidden_state(spark, sf, layer):
    return layer_states(t.vector_features(spark, sf), vector_model(spark))[layer - 1]


def _samples(spark, sf):
    return gradients.batch_count(t.vector_labels(spark, sf)).scalar()


def _output_weight_gradient(spark, sf):
    return gradients.weight_gradient(
        _integer_gradient(spark, sf), _hidden_state(spark, sf, 2), _samples(spark, sf), 10
    )


def _passed_back(spark, sf):
    params = vector_model(spark).layer_params(3)
    return gradients.backprop_linear(_integer_gradient(spark, sf), params, 16, 10)


@query("one_hot")
def query_one_hot(spark, sf):
    return gradients.one_hot(t.vector_labels(spark, sf), 10)


@query("output_gradient")
def query_output_gradient(spark, sf):
    probabilities = layers.softmax(vector_logits(spark, sf))
    return gradients.output_gradient(probabilities, t.vector_labels(spark, sf)).withColumn("g", r6("g"))


@query("weight_gradient")
def query_weight_gradient(spark, sf):
    return _output_weight_gradient(spark, sf)


@query("weight_gradient_sparse")
def query_weight_gradient_sparse(spark, sf):
    """Gradient of the one-unit-per-part layer for a gradient of sign(target) at each hidden unit."""
    hidden = F.explode(F.sequence(F.lit(0), F.lit(t.BASKET_HIDDEN - 1))).alias("idx")
    labels = t.order_labels(spark, sf)
    grad = labels.select("sample_id", "true_label", hidden).select(
        "sample_id", "idx", ((F.col("true_label") + F.col("idx")) % 3 - 1).cast("double").alias("g")
    )
    n = gradients.batch_count(labels).scalar()
    return gradients.weight_gradient(
        grad, t.basket_features(spark, sf), n, t.BASKET_HIDDEN, bounded=False
    )


@query("bias_gradient")
def query_bias_gradient(spark, sf):
    return gradients.bias_gradient(_integer_gradient(spark, sf), _samples(spark, sf))


@query("backprop_linear")
def query_backprop_linear(spark, sf):
    return _passed_back(spark, sf)


@query("relu_backward")
def query_relu_backward(spark, sf):
    return gradients.relu_backward(_passed_back(spark, sf), _hidden_state(spark, sf, 2))


@query("batch_count")
def query_batch_count(spark, sf):
    return gradients.batch_count(t.order_labels(spark, sf))


@query("update_weights")
def query_update_weights(spark, sf):
    grads = _output_weight_gradient(spark, sf)
    return optim.update_weights(vector_model(spark).layer_params(3), grads, LR)


@query("update_biases")
def query_update_biases(spark, sf):
    grads = gradients.bias_gradient(_integer_gradient(spark, sf), _samples(spark, sf))
    return optim.update_biases(vector_model(spark).layer_biases(3), grads, LR)


@query("update_momentum")
def query_update_momentum(spark, sf):
    """Two momentum steps with the same gradient, so that the second one uses the velocity."""
    grads = materialize(_output_weight_gradient(spark, sf), "grads")
    params = vector_model(spark).layer_params(3)
    first = optim.momentum_update(params, None, grads)
    return optim.momentum_update(first.drop("velocity"), first, grads).select(
        "output_idx", "input_idx", F.round("w", 9).alias("w"), F.round("velocity", 9).alias("velocity")
    )


def _round_gradients(rows):
    return rows.select("kind", "output_idx", "input_idx", r6("grad"), r6("loss"), r6("accuracy"))


@query("train_step_array")
def query_train_step_array(spark, sf):
    """One step over the whole table; new parameters as arrays, laid out one element per row here."""
    model = vector_model(spark)
    step = arrow_step(t.vector_rows(spark, sf), model)
    rows = parameter_rows(model, step, LR)
    return rows.select(
        "kind", "output_idx", F.posexplode_outer("weights").alias("input_idx", "w"), "bias_value", "loss", "accuracy"
    ).select("kind", "output_idx", "input_idx", r6("w"), r6("bias_value"), r6("loss"), r6("accuracy"))


@query("train_step_long")
def query_train_step_long(spark, sf):
    model = vector_model(spark)
    step = train_step(t.vector_features(spark, sf), t.vector_labels(spark, sf), model)
    return _round_gradients(gradient_rows(step, model.n_layers))


@query("train_step_relational")
def query_train_step_relational(spark, sf):
    model = vector_model(spark)
    step = relational_step(t.vector_features(spark, sf), t.vector_labels(spark, sf), model)
    return _round_gradients(gradient_rows(step, model.n_layers))


@query("train_step_gaps")
def query_train_step_gaps(spark, sf):
    model = t.gap_model(spark)
    step = train_step(t.gap_features(spark, sf), t.vector_labels(spark, sf), model, "relational")
    return _round_gradients(gradient_rows(step, model.n_layers))


@query("train_step_sparse")
def query_train_step_sparse(spark, sf):
    """One step of the network with one input unit per part, over all baskets.

    The baskets are aggregated once and written, as the step reads them four times.
    """
    step = hybrid_step(
        materialize(t.basket_features(spark, sf), "baskets"),
        t.order_labels(spark, sf),
        t.basket_units(spark, sf),
        t.dyadic_model(spark, (1, t.BASKET_HIDDEN)).layer_biases(1),
        t.dyadic_model(spark, t.BASKET_TAIL),
    )
    return _round_gradients(gradient_rows(step, 3))


@query("train_step_small")
def query_train_step_small(spark, sf):
    model = t.dyadic_model(spark, t.SMALL_LAYERS)
    step = arrow_step(t.vector_rows(spark, sf), model)
    return _round_gradients(gradient_rows(step, model.n_layers))


# Batches and training

BATCH_SIZE = 32


def _quarter(spark, sf):
    """A batch size that cuts the orders into four."""
    return -(-t.order_labels(spark, sf).count() // 4)


@query("assign_batches")
def query_assign_batches(spark, sf):
    return batching.assign_batches(t.order_labels(spark, sf), BATCH_SIZE)


@query("select_batch")
def query_select_batch(spark, sf):
    batches = batching.assign_batches(t.order_labels(spark, sf), _quarter(spark, sf))
    return batching.select_batch(batches, 1)


@query("batch_features")
def query_batch_features(spark, sf):
    batches = batching.assign_batches(t.order_labels(spark, sf), _quarter(spark, sf))
    return batching.batch_features(t.order_features(spark, sf), batching.select_batch(batches, 2))


@query("batch_plan")
def query_batch_plan(spark, sf):
    return batching.batch_plan(t.order_labels(spark, sf), BATCH_SIZE)


@query("shuffle_batches")
def query_shuffle_batches(spark, sf):
    batches = batching.assign_batches(t.order_labels(spark, sf), BATCH_SIZE)
    return batching.shuffle_batches(batches, SEED, epoch=3)


@query("shuffle_samples")
def query_shuffle_samples(spark, sf):
    return batching.shuffle_samples(t.order_labels(spark, sf), BATCH_SIZE, SEED, epoch=3)


def _fit(spark, sf, **options):
    """Two-layer training on all vectors in two batches per epoch, validated on the same vectors."""
    rows = t.vector_rows(spark, sf)
    half = -(-rows.count() // 2)
    settings = {"epochs": 2, "batch_size": half, "lr": 0.125, "momentum": 0.5} | options
    return fit(rows, t.dyadic_model(spark, t.SMALL_LAYERS), TrainConfig(**settings), rows)


def _round_history(history):
    measures = [c for c in history.columns if c not in ("epoch", "time")]
    return history.select("epoch", *(r6(c) for c in measures))


@query("fit")
def query_fit(spark, sf):
    return _round_history(_fit(spark, sf).history)



@query("fit_relational")
def query_fit_relational(spark, sf):
    """The same training with parameters in tables and a join for every layer."""
    return _round_history(_fit(spark, sf, strategy="relational").history)


@query("fit_sparse")
def query_fit_sparse(spark, sf):
    """The same training with a join for the first layer."""
    return _round_history(_fit(spark, sf, strategy="hybrid").history)


@query("fit_long")
def query_fit_long(spark, sf):
    """The same training from one row per element."""
    features, labels = t.vector_features(spark, sf), t.vector_labels(spark, sf)
    half = -(-labels.count() // 2)
    settings = TrainConfig(epochs=2, batch_size=half, lr=0.125, momentum=0.5)
    result = fit_features(features, labels, t.dyadic_model(spark, t.SMALL_LAYERS), settings, (features, labels))
    return _round_history(result.history)


@query("epoch_metrics")
def query_epoch_metrics(spark, sf):
    rows = epoch_metrics(_fit(spark, sf, validate_every=0).batch_metrics)
    return rows.select("epoch", *(r6(c) for c in rows.columns if c != "epoch"))



@query("best_epoch")
def query_best_epoch(spark, sf):
    return best_epoch(_fit(spark, sf).history).withColumn("val_loss", r6("val_loss"))



@query("validate_every")
def query_validate_every(spark, sf):
    return _round_history(_fit(spark, sf, validate_every=2).history)


@query("early_stopping")
def query_early_stopping(spark, sf):
    """Whole-table batches with a step long enough that the loss rises again and ends the run."""
    n = t.table(spark, sf, "embeddings").count()
    options = {"epochs": 6, "batch_size": n, "lr": 1.5, "momentum": 0.9, "early_stopping": 1}
    history = _fit(spark, sf, **options).history
    return history.select("epoch", r6("val_loss"))


@query("history_summary")
def query_history_summary(spark, sf):
    """Of a history that was stored and read back, with a fixed time per epoch."""
    path = scratch_path(spark, "history")
    append_history(_fit(spark, sf).history.withColumn("time", F.col("epoch") * 0.25), path)
    summary = history_summary(read_history(spark, path))
    return summary.select("epochs", *(r6(c) for c in summary.columns if c != "epochs"))



# Metrics and parity


def _vector_losses(spark, sf):
    probabilities = layers.softmax(vector_logits(spark, sf))
    return metrics.sample_losses(probabilities, t.vector_labels(spark, sf))


@query("cross_entropy")
def query_cross_entropy(spark, sf):
    return metrics.cross_entropy(_vector_losses(spark, sf)).withColumn("loss", r6("loss"))


@query("loss_summary")
def query_loss_summary(spark, sf):
    scored = score_labelled(t.order_rows(spark, sf), order_model(spark))
    row = metrics.loss_summary(scored)
    return row.select("batch_size", *(r6(c) for c in row.columns if c != "batch_size"))


@query("accuracy")
def query_accuracy(spark, sf):
    documents = t.document_rows(spark, sf)
    scored = score_predictions(documents, t.dyadic_model(spark, t.DOCUMENT_LAYERS))
    return metrics.accuracy(scored.select("sample_id", "prediction"), documents.drop("x"))


@query("validation_accuracy")
def query_validation_accuracy(spark, sf):
    probabilities = layers.softmax(vector_logits(spark, sf))
    scored = metrics.score_samples(probabilities, t.vector_labels(spark, sf))
    row = metrics.validation_accuracy(scored)
    return row.withColumn("accuracy", r6("accuracy")).withColumn("loss", r6("loss"))


@query("validate")
def query_validate(spark, sf):
    """Loss and accuracy of every order line: a scan, a kernel and one small aggregate."""
    row = validate(t.line_rows(spark, sf), order_model(spark))
    return row.select(r6("loss"), r6("accuracy"))


@query("score_against_truth")
def query_score_against_truth(spark, sf):
    return order_truth(spark, sf).orderBy("sample_id")


@query("prediction_parity")
def query_prediction_parity(spark, sf):
    """Two scored sets from different sources, joined."""
    return metrics.prediction_parity(order_truth(spark, sf), order_truth(spark, sf, 16))


@query("parity_mismatches")
def query_parity_mismatches(spark, sf):
    return metrics.parity_mismatches(_parity(spark, sf))


@query("parity_summary")
def query_parity_summary(spark, sf):
    row = metrics.parity_summary(_parity(spark, sf))
    rounded = ("match_rate", "ours_accuracy", "theirs_accuracy", "avg_logit_diff", "max_logit_diff")
    return row.select(*(r6(c) if c in rounded else F.col(c) for c in row.columns))


@query("logit_parity")
def query_logit_parity(spark, sf):
    scored = score(t.order_rows(spark, sf), order_model(spark), out="ours")
    return metrics.paired_logit_parity(score(scored, order_model(spark, 16), out="theirs"))


@query("agreement_counts")
def query_agreement_counts(spark, sf):
    return metrics.agreement_counts(_parity(spark, sf))


# Reports

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@query("table_counts")
def query_table_counts(spark, sf):
    return reports.table_counts({name: t.table(spark, sf, name) for name in TABLES})


@query("weight_preview")
def query_weight_preview(spark, sf):
    weights = t.prototype_weights(spark, sf, 128)
    return reports.weight_preview(weights.select("output_idx", F.to_json("weights").alias("weights")))


@query("bias_report")
def query_bias_report(spark, sf):
    return reports.bias_report(t.prototype_biases(spark, sf).filter("layer = 1"))


@query("feature_stats")
def query_feature_stats(spark, sf):
    return reports.feature_stats(t.vector_features(spark, sf))


@query("logit_stats")
def query_logit_stats(spark, sf):
    return reports.logit_stats(vector_logits(spark, sf))


@query("sample_logits")
def query_sample_logits(spark, sf):
    logits = score_sample(t.vector_features(spark, sf), vector_model(spark), LOOKUP_ID)
    return reports.sample_logits(logits, LOOKUP_ID)


@query("prediction_report")
def query_prediction_report(spark, sf):
    return reports.prediction_report(order_scores(spark, sf))


def _on_truth(report):
    return lambda spark, sf: report(order_truth(spark, sf))


for _report in (
    reports.truth_report,
    reports.overall_accuracy,
    reports.correct_breakdown,
    reports.confusion_matrix,
    reports.per_class_accuracy,
    reports.hardest_correct,
    reports.confident_wrong,
):
    QUERIES[_report.__name__] = _on_truth(_report)


@query("confusion_matrix_lines")
def query_confusion_matrix_lines(spark, sf):
    """All label and prediction pairs over order lines, scored in the scan."""
    scored = score_predictions(t.line_rows(spark, sf), order_model(spark))
    return reports.confusion_matrix(scored, wrong_only=False)
