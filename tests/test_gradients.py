import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabgrad import Model
from tabgrad.operators import gradients, optim
from tabgrad.plans.step import apply_step, arrow_step, gradient_rows, parameter_rows, train_step
from tabgrad.operators.tagged import demux_tagged
from tabgrad.sources import features_from_vectors

GRAD_DDL = "sample_id bigint, idx int, g double"
STEPS = ["hybrid", "relational", "gathered", "arrow"]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=3).tolist(), int(rng.integers(0, 2))) for i in range(23)]
    return spark.createDataFrame(rows, "sample_id bigint, x array<double>, true_label int")


@pytest.fixture(scope="module")
def model(spark):
    rng = np.random.default_rng(2)
    shapes = ((4, 3), (3, 4), (2, 3))
    return Model.from_matrices(spark, [(rng.normal(size=s), rng.normal(size=s[0])) for s in shapes])


def take_step(data, model, plan):
    if plan == "arrow":
        return arrow_step(data, model, block_size=7)
    features = features_from_vectors(data, "sample_id", F.col("x"))
    labels = data.select("sample_id", "true_label")
    return train_step(features, labels, model, "arrow" if plan == "gathered" else plan)


def mean_loss(matrices, x, labels):
    for k, (w, b) in enumerate(matrices):
        x = x @ w.T + b
        if k < len(matrices) - 1:
            x = np.maximum(x, 0)
    shifted = x - x.max(axis=1, keepdims=True)
    log_p = shifted - np.log(np.exp(shifted).sum(axis=1, keepdims=True))
    return -log_p[np.arange(len(labels)), labels].mean()


@pytest.mark.parametrize("plan", STEPS)
def test_gradients_match_finite_differences(data, model, plan):
    rows = data.orderBy("sample_id").collect()
    x = np.array([r["x"] for r in rows])
    labels = np.array([r["true_label"] for r in rows])
    step = take_step(data, model, plan)
    got = {(r["layer"], r["output_idx"], r["input_idx"]): r["grad"] for r in step.weight_grads.collect()}
    got |= {(r["layer"], r["output_idx"], None): r["grad"] for r in step.bias_grads.collect()}
    assert len(got) == model.n_params
    h = 1e-6
    for (layer, o, i), grad in got.items():
        losses = []
        for sign in (1, -1):
            moved = [(w.copy(), b.copy()) for w, b in model.matrices()]
            if i is None:
                moved[layer - 1][1][o] += sign * h
            else:
                moved[layer - 1][0][o, i] += sign * h
            losses.append(mean_loss(moved, x, labels))
        assert math.isclose(grad, (losses[0] - losses[1]) / (2 * h), abs_tol=1e-6)
    metrics = step.metrics.first()
    assert math.isclose(metrics["loss"], mean_loss(model.matrices(), x, labels), abs_tol=1e-12)


def test_step_tables(data, model, rows):
    step = take_step(data, model, "arrow")
    table = gradient_rows(step, model.n_layers)
    assert table.columns == ["kind", "output_idx", "input_idx", "grad", "loss", "accuracy"]
    assert table.count() == model.n_params + 1
    w2 = demux_tagged(table, "grad_w2", ["output_idx", "input_idx", "grad"])
    assert rows(w2) == rows(step.weight_grads.filter("layer = 2").drop("layer"))
    updated = apply_step(model, step, 0.5)
    new = parameter_rows(model, step, 0.5)
    kinds = {r["kind"] for r in new.select("kind").distinct().collect()}
    assert kinds == {"weights_fc1", "weights_fc2", "weights_fc3", "biases_fc1", "biases_fc2", "biases_fc3", "metrics"}
    first = demux_tagged(new, "weights_fc1", ["output_idx", "weights"]).orderBy("output_idx").collect()
    np.testing.assert_allclose([r["weights"] for r in first], updated.matrices()[0][0], atol=0)


def test_result_does_not_depend_on_partitions(data, model):
    grads = []
    for n in (1, 6):
        step = take_step(data.repartition(n), model, "arrow")
        grads.append([r["grad"] for r in step.weight_grads.orderBy("layer", "output_idx", "input_idx").collect()])
    np.testing.assert_allclose(grads[0], grads[1], atol=1e-14)


def test_labels_are_checked(data, model):
    for bad in (F.lit(None).cast("int"), F.lit(5)):
        with pytest.raises(Exception, match="labels must be"):
            arrow_step(data.withColumn("true_label", bad), model).metrics.collect()


def test_empty_batch_changes_nothing(data, model, rows):
    none = data.filter("sample_id < 0")
    for plan in ("arrow", "relational"):
        step = take_step(none, model, plan)
        assert tuple(step.metrics.first()) == (None, None)
        assert step.weight_grads.count() == 0
        assert rows(apply_step(model, step, 0.1).params.select("w")) == rows(model.params.select("w"))


def test_one_hot(frame, rows):
    labels = frame([(1, 2), (2, 0)], "sample_id bigint, true_label int")
    assert [r[2] for r in rows(gradients.one_hot(labels, 3))] == [0.0, 0.0, 1.0, 1.0, 0.0, 0.0]


def test_output_gradient(frame, rows):
    p = frame([(1, 0, 0.25), (1, 1, 0.75)], "sample_id bigint, class_idx int, probability double")
    labels = frame([(1, 1)], "sample_id bigint, true_label int")
    assert rows(gradients.output_gradient(p, labels)) == [(1, 0, 0.25), (1, 1, -0.25)]


def test_weight_and_bias_gradient_by_hand(frame, rows):
    g = frame([(1, 0, 1.0), (1, 1, -1.0), (2, 0, 0.5), (2, 1, 0.0)], GRAD_DDL)
    a = frame([(1, 0, 2.0), (1, 1, 4.0), (2, 0, 6.0)], "sample_id bigint, idx int, value double")
    expected = [(0, 0, 2.5), (0, 1, 2.0), (1, 0, -1.0), (1, 1, -2.0)]
    for options in ({"width": 2}, {"width": 2, "bounded": False}, {}):
        assert rows(gradients.weight_gradient(g, a, 2, **options)) == expected
    assert rows(gradients.bias_gradient(g, 2)) == [(0, 0.75), (1, -0.5)]


def test_backprop_and_relu_backward(frame, rows):
    g = frame([(1, 0, 1.0), (1, 1, 2.0)], GRAD_DDL)
    w = frame([(0, 0, 1.0), (0, 1, 2.0), (1, 0, 3.0), (1, 1, 4.0)], "output_idx int, input_idx int, w double")
    passed = gradients.backprop_linear(g, w, 2, 2)
    assert rows(passed) == rows(gradients.backprop_linear(g, w)) == [(1, 0, 7.0), (1, 1, 10.0)]
    state = frame([(1, 0, 0.0), (1, 1, 0.5)], "sample_id bigint, idx int, z double")
    assert rows(gradients.relu_backward(passed, state)) == [(1, 0, 0.0), (1, 1, 10.0)]


def test_updates_keep_parameters_without_gradient(frame, rows):
    w = frame([(0, 0, 1.0), (0, 1, 2.0)], "output_idx int, input_idx int, w double")
    g = frame([(0, 1, 4.0)], "output_idx int, input_idx int, grad double")
    assert rows(optim.update_weights(w, g, 0.5)) == [(0, 0, 1.0), (0, 1, 0.0)]
    b = frame([(0, 1.0)], "output_idx int, b double")
    assert rows(optim.update_biases(b, frame([(0, 2.0)], "output_idx int, grad double"), 0.25)) == [(0, 0.5)]


def test_momentum_accumulates(frame):
    w = frame([(0, 0, 1.0)], "output_idx int, input_idx int, w double")
    g = frame([(0, 0, 1.0)], "output_idx int, input_idx int, grad double")
    first = optim.momentum_update(w, None, g, 0.1, 0.5)
    second = optim.momentum_update(first.drop("velocity"), first, g, 0.1, 0.5).first()
    assert math.isclose(second["velocity"], 1.5) and math.isclose(second["w"], 1.0 - 0.1 - 0.15)
