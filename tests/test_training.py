import numpy as np
import pytest
from pyspark.sql import functions as F

from tabgrad import Model, TrainConfig, fit, validate
from tabgrad.plans.forward import score_labelled
from tabgrad.sources import (
    ModelStore,
    append_history,
    discard,
    export_params,
    inline_values,
    materialize,
    read_history,
    read_weight_rows,
    scratch_path,
    workspace,
)


@pytest.fixture(scope="module")
def data(spark):
    """Two separable clouds."""
    rng = np.random.default_rng(4)
    rows = []
    for i in range(60):
        label = i % 2
        rows.append((i, (rng.normal(size=3) * 0.3 + (1 if label else -1)).tolist(), label))
    return spark.createDataFrame(rows, "sample_id bigint, x array<double>, true_label int")


@pytest.fixture(scope="module")
def start(spark):
    return Model.from_layers(spark, [3, 5, 2], seed=1)


def numpy_sgd(data, model, batch_size, epochs, lr, momentum=0.0):
    rows = data.orderBy("sample_id").collect()
    x = np.array([r["x"] for r in rows])
    y = np.array([r["true_label"] for r in rows])
    (w1, b1), (w2, b2) = [(w.copy(), b.copy()) for w, b in model.matrices()]
    velocity = [np.zeros_like(p) for p in (w1, b1, w2, b2)]
    for _ in range(epochs):
        for at in range(0, len(y), batch_size):
            xs, ys = x[at : at + batch_size], y[at : at + batch_size]
            z = xs @ w1.T + b1
            a = np.maximum(z, 0)
            logits = a @ w2.T + b2
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(ys)), ys] -= 1
            dz = (p @ w2) * (z > 0)
            grads = [dz.T @ xs, dz.sum(axis=0), p.T @ a, p.sum(axis=0)]
            velocity = [momentum * v + g / len(ys) for v, g in zip(velocity, grads)]
            w1, b1, w2, b2 = [q - lr * v for q, v in zip((w1, b1, w2, b2), velocity)]
    return [(w1, b1), (w2, b2)]


def assert_same_model(model, matrices):
    for (w, b), (v, c) in zip(model.matrices(), matrices):
        np.testing.assert_allclose(w, v, atol=1e-12)
        np.testing.assert_allclose(b, c, atol=1e-12)


@pytest.mark.parametrize("momentum", [0.0, 0.9])
def test_fit_equals_numpy(data, start, momentum):
    config = TrainConfig(epochs=2, batch_size=25, lr=0.1, momentum=momentum, validate_every=0)
    result = fit(data, start, config)
    assert_same_model(result.model, numpy_sgd(data, start, 25, 2, 0.1, momentum))
    steps = result.batch_metrics.orderBy("epoch", "step").collect()
    assert [(r["batch_num"], r["n"]) for r in steps] == [(0, 25), (1, 25), (2, 10)] * 2


def test_table_training_equals_numpy(data, start):
    config = TrainConfig(epochs=1, batch_size=30, lr=0.1, validate_every=0, strategy="relational")
    assert_same_model(fit(data, start, config).model, numpy_sgd(data, start, 30, 1, 0.1))


def test_fit_learns(data, start):
    config = TrainConfig(epochs=4, batch_size=60, lr=0.5, cache=True)
    result = fit(data, start, config, data)
    history = result.history.orderBy("epoch").collect()
    losses = [r["val_loss"] for r in history]
    assert losses == sorted(losses, reverse=True) and result.best_epoch == 4
    assert validate(data, result.model).first()["accuracy"] > 0.95
    assert history[1]["train_loss"] == pytest.approx(losses[0])


def test_shuffles(data, start):
    def orders(**options):
        config = TrainConfig(epochs=2, batch_size=10, lr=0.01, validate_every=0, **options)
        steps = fit(data, start, config).batch_metrics.orderBy("epoch", "step").collect()
        return [[(r["batch_num"], round(r["loss"], 9)) for r in steps if r["epoch"] == e] for e in (1, 2)]

    first, second = orders(shuffle="batches", seed=3)
    assert sorted(k for k, _ in first) == list(range(6)) and [k for k, _ in first] != [k for k, _ in second]
    again = orders(shuffle="batches", seed=3)
    assert [[k for k, _ in e] for e in again] == [[k for k, _ in e] for e in (first, second)]
    members = orders(shuffle="samples", seed=3)
    assert [k for k, _ in members[0]] == list(range(6)) and members[0] != orders()[0]
    with pytest.raises(ValueError):
        orders(shuffle="rows")


def test_validation_schedule_and_early_stopping(data, start):
    history = fit(data, start, TrainConfig(epochs=3, batch_size=60, validate_every=2), data).history
    assert [r["val_loss"] is None for r in history.orderBy("epoch").collect()] == [True, False, True]
    config = TrainConfig(epochs=9, batch_size=60, lr=0.0, early_stopping=2)
    result = fit(data, start, config, data)
    assert result.stopped_early and result.history.count() == 3 and result.best_epoch == 1


def test_fit_stores_versions(spark, data, start, tmp_path):
    path = str(tmp_path / "model")
    result = fit(data, start, TrainConfig(epochs=2, batch_size=60, validate_every=0, store_path=path))
    store = ModelStore(spark, path)
    assert store.versions() == [0, 1]
    params, biases = store.load()
    assert_same_model(Model(start.layers, params, biases), result.model.matrices())


def test_failed_step_fails_the_run(data, start):
    broken = data.withColumn("x", F.array(F.lit(1.0)))
    with pytest.raises(Exception, match="3 elements"):
        fit(broken, start, TrainConfig(epochs=1, batch_size=60))


def test_score_labelled_out_of_range_label(data, start):
    odd = data.limit(1).withColumn("true_label", F.lit(7))
    row = score_labelled(odd, start).first()
    assert row["p_true"] is None and row["loss"] is None and row["correct"] == 0


def test_model_store_replaces_itself(spark, frame, tmp_path, rows):
    params = frame([(1, 0, 0, 1.0), (1, 0, 1, 2.0)], "layer int, output_idx int, input_idx int, w double")
    biases = frame([(1, 0, 0.5)], "layer int, output_idx int, b double")
    store = ModelStore(spark, str(tmp_path / "store"))
    with pytest.raises(FileNotFoundError):
        store.load()
    assert store.save(params, biases) == 0
    assert store.replace(lambda p, b: (p.withColumn("w", p["w"] * 2), b)) == 1
    new_params, new_biases = store.load()
    assert rows(new_params) == [(1, 0, 0, 2.0), (1, 0, 1, 4.0)] and rows(new_biases) == rows(biases)
    assert rows(store.load(0)[0]) == rows(params)
    (tmp_path / "store" / "version=7").mkdir()
    assert store.versions() == [0, 1]


def test_export_and_history(spark, frame, tmp_path, rows):
    params = frame([(1, 0, 0, 1.0), (1, 0, 1, 2.0)], "layer int, output_idx int, input_idx int, w double")
    biases = frame([(1, 0, 0.5)], "layer int, output_idx int, b double")
    path = str(tmp_path / "out")
    export_params(params, biases, path, as_json=True, fmt="csv")
    exported = spark.read.option("header", True).option("escape", '"').csv(f"{path}/weights")
    assert rows(exported) == [("0", "[1.0,2.0]", "1")] or rows(exported) == [("0", "[1.0,2.0]", 1)]
    again = read_weight_rows(spark, [f"{path}/weights/layer=1"], "csv")
    assert rows(again) == rows(params)
    log = str(tmp_path / "log")
    for epoch in (1, 2):
        append_history(frame([(epoch, 0.5)], "epoch int, loss double"), log)
    assert rows(read_history(spark, log, schema="epoch int, loss double")) == [(1, 0.5), (2, 0.5)]


def test_discard_refuses_other_folders(spark, tmp_path):
    with pytest.raises(ValueError):
        discard(spark, str(tmp_path))
    path = scratch_path(spark, "t")
    materialize(spark.range(1), path=path)
    discard(spark, path)
    with pytest.raises(Exception):
        spark.read.parquet(path)


def test_materialize_and_workspace(spark, rows):
    assert workspace(spark) == spark.conf.get("spark.checkpoint.dir")
    df = materialize(spark.range(5).selectExpr("id", "id % 2 as k"), "t", ["k"])
    assert df.filter("k = 1").count() == 2
    assert rows(inline_values(spark, [("A", 0)], "name string, class int")) == [("A", 0)]
