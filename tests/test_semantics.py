"""One meaning of gaps, NULLs, misplaced elements and labels, whatever plan and size."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import tabgrad.operators.gradients as gradients
import tabgrad.operators.layers as layers
import tabgrad.plans.forward as forward_plans
import tabgrad.plans.model as model_module
import tabgrad.plans.numbering as numbering
import tabgrad.plans.step as step_plans
from tabgrad import Model, TrainConfig, fit, fit_features, forward, score, score_predictions, validate
from tabgrad.operators import batching, codec, prep
from tabgrad.plans.fit import batch_order
from tabgrad.plans.forward import forward_rows, layer_outputs, score_labelled
from tabgrad.plans.step import apply_step, train_step
from tabgrad.schema import outside_elements
from tabgrad.sources import ModelStore, features_from_vectors, read_features, read_labels, scratch_path

PLANS = ("arrow", "hybrid", "relational", "dense")
W1 = [(0, 0, 1.0), (0, 2, -2.0), (1, 1, 3.0), (1, 1, 0.5)]  # a repeated position, a neuron without weights
W2 = [(0, 0, 0.5), (1, 1, 1.0), (1, 2, -0.25)]
ROWS = [(1, 0, 0.5), (1, 2, 0.25), (2, 1, None), (3, 9, 4.0), (3, -1, 1.0), (4, 1, 2.0), (4, 1, 1.0), (5, None, 1.0), (5, 0, -1.0)]


@pytest.fixture(scope="module")
def gaps(spark):
    params = [(1, *r) for r in W1] + [(2, *r) for r in W2]
    biases = [(1, 0, 0.25), (1, 2, 1.0), (2, 0, -0.5)]
    return Model(
        (3, 3, 2),
        spark.createDataFrame(params, "layer int, output_idx int, input_idx int, w double"),
        spark.createDataFrame(biases, "layer int, output_idx int, b double"),
    )


@pytest.fixture(scope="module")
def features(spark):
    return spark.createDataFrame(ROWS, "sample_id bigint, idx int, value double")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 2) for i in range(1, 6)], "sample_id bigint, true_label int")


def dense_numbers():
    w1, w2 = np.zeros((3, 3)), np.zeros((2, 3))
    for w, rows in ((w1, W1), (w2, W2)):
        for o, i, v in rows:
            w[o, i] += v
    x = np.zeros((5, 3))
    for s, i, v in ROWS:
        if i is not None and 0 <= i < 3 and v is not None:
            x[s - 1, i] += v
    return x, w1, np.array([0.25, 0, 1.0]), w2, np.array([-0.5, 0])


@pytest.fixture(params=[128, 1], ids=["packed", "wide"])
def pack_width(request, monkeypatch):
    for module in (layers, gradients, forward_plans, step_plans):
        monkeypatch.setattr(module, "PACK_WIDTH", request.param)


@pytest.mark.parametrize("plan", PLANS)
def test_logits_agree(features, gaps, plan, pack_width):
    x, w1, b1, w2, b2 = dense_numbers()
    expected = np.maximum(x @ w1.T + b1, 0) @ w2.T + b2
    found = {(r["sample_id"], r["class_idx"]): r["logit"] for r in forward(features, gaps, plan).collect()}
    # All elements of the third sample lie outside, so it is none.
    assert found == {(s + 1, c): expected[s, c] for s in (0, 1, 3, 4) for c in range(2)}


def whole(model, table, columns):
    out = {}
    for r in table.collect():
        key = tuple(r[c] for c in columns)
        out[key] = out.get(key, 0.0) + r[-1]
    return {k: v for k, v in out.items() if abs(v) > 1e-12}


@pytest.mark.parametrize("plan", ["hybrid", "relational"])
def test_steps_agree(features, labels, gaps, plan, pack_width):
    wanted = apply_step(gaps, train_step(features, labels, gaps, "arrow"), 0.5)
    step = train_step(features, labels, gaps, plan)
    found = apply_step(gaps, step, 0.5)
    for table, keys in (("params", ("layer", "output_idx", "input_idx")), ("biases", ("layer", "output_idx"))):
        got, want = (whole(m, getattr(m, table), keys) for m in (found, wanted))
        # A repeated position is moved in each of its rows, so only the others compare one to one.
        got.pop((1, 1, 1), None), want.pop((1, 1, 1), None)
        assert got.keys() == want.keys()
        np.testing.assert_allclose([got[k] for k in sorted(got)], [want[k] for k in sorted(got)], atol=1e-12)
    loss = train_step(features, labels, gaps, "arrow").metrics.first()
    np.testing.assert_allclose(tuple(step.metrics.first()), tuple(loss), atol=1e-12)


@pytest.mark.parametrize("plan", ["arrow", "hybrid", "relational"])
@pytest.mark.parametrize("label", [2, -1, None])
def test_labels_that_are_no_class_fail_every_step(features, labels, gaps, plan, label):
    bad = labels.withColumn("true_label", F.when(F.col("sample_id") == 2, F.lit(label).cast("int")).otherwise(F.col("true_label")))
    with pytest.raises(Exception, match="labels must be"):
        train_step(features, bad, gaps, plan).weight_grads.collect()
    with pytest.raises(Exception, match="labels must be"):
        train_step(features, labels.filter("sample_id <> 2"), gaps, plan).weight_grads.collect()


def test_what_counts_as_nothing_is_reported(features):
    assert tuple(outside_elements(features, 3).first()) == (3, 2)


def test_dense_layers_do_not_shift(frame):
    model = Model(
        (2, 2),
        frame([(1, 1, 1, 3.0)], "layer int, output_idx int, input_idx int, w double"),
        frame([(1, 0, 0.5), (1, 1, 0.25)], "layer int, output_idx int, b double"),
    )
    rows = frame([(7, [1.0, 0.0])], "sample_id bigint, x array<double>")
    for plan in ("dense", "arrow"):
        assert score(rows, model, strategy=plan).first()["logits"] == [0.5, 0.25]


def test_positions_outside_the_model_are_rejected(frame, spark):
    params = frame([(1, 0, 5, 3.0)], "layer int, output_idx int, input_idx int, w double")
    with pytest.raises(ValueError, match="positions"):
        Model((2, 2), params, Model.from_layers(spark, [2, 2]).biases).matrices()


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(8)
    rows = [(i, np.round(rng.normal(size=3) * 64).tolist(), i % 2) for i in range(24)]
    rows = [(i, [v / 64 for v in x], y) for i, x, y in rows]
    return spark.createDataFrame(rows, "sample_id bigint, x array<double>, true_label int")


@pytest.fixture
def beyond_the_limit(monkeypatch):
    monkeypatch.setattr(model_module, "DENSE_BYTES", 100)


def test_scoring_above_the_limit(spark, vectors, rows, monkeypatch):
    model = Model.from_layers(spark, [3, 4, 2], seed=3)

    def results():
        return [
            sorted((r["sample_id"], *np.round(r["logits"], 9)) for r in score(vectors, model).collect()),
            sorted((r[0], r["prediction"], round(r["probability"], 9)) for r in score_predictions(vectors, model).collect()),
            sorted((r[0], r["prediction"], round(r["loss"], 9), r["correct"]) for r in score_labelled(vectors, model).collect()),
            sorted((r[0], r[1], round(r[2], 9)) for r in forward_rows(vectors, model).collect()),
            sorted((*r[:3], round(r[3], 9)) for r in layer_outputs(features_from_vectors(vectors, "sample_id", F.col("x")), model).collect()),
            [round(v, 9) for v in validate(vectors, model).first()],
        ]

    small = results()
    monkeypatch.setattr(model_module, "DENSE_BYTES", 8)
    assert results() == small
    with pytest.raises(ValueError, match="sample_id"):
        validate(vectors.drop("sample_id"), model)


def history(result):
    return [tuple(round(v, 9) if isinstance(v, float) else v for v in r[:-1]) for r in result.history.orderBy("epoch").collect()]


def scratch_tables(spark):
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(spark.conf.get("spark.checkpoint.dir") + "/tabgrad")
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return {s.getPath().getName() for s in fs.listStatus(root)} if fs.exists(root) else set()


@pytest.mark.parametrize("plan", ["hybrid", "relational"])
def test_table_training_with_validation_and_momentum(spark, vectors, plan, beyond_the_limit):
    start = Model.from_layers(spark, [3, 4, 2], seed=3)
    settings = {"epochs": 2, "batch_size": 12, "lr": 0.25, "momentum": 0.5}
    before = scratch_tables(spark)
    found = fit(vectors, start, TrainConfig(strategy=plan, **settings), vectors)
    left = scratch_tables(spark) - before
    assert sorted(name.split("-")[0] for name in left) == ["biases", "params"]
    model_module.DENSE_BYTES = 1 << 20
    assert history(found) == history(fit(vectors, start, TrainConfig(**settings), vectors))


def test_fit_from_long_tables(spark, vectors):
    start = Model.from_layers(spark, [3, 4, 2], seed=3)
    features, labels = features_from_vectors(vectors, "sample_id", F.col("x")), vectors.drop("x")
    settings = {"epochs": 2, "batch_size": 12, "lr": 0.25}
    wanted = history(fit(vectors, start, TrainConfig(**settings), vectors))
    for plan in ("auto", "hybrid"):
        config = TrainConfig(strategy=plan, **settings)
        assert history(fit_features(features, labels, start, config, (features, labels))) == wanted


def test_a_failed_run_frees_its_batches(spark, vectors):
    before = scratch_tables(spark)
    with pytest.raises(Exception, match="3 elements"):
        fit(vectors.withColumn("x", F.array(F.lit(1.0))), Model.from_layers(spark, [3, 2]), TrainConfig(epochs=1))
    assert scratch_tables(spark) == before


def test_wrong_widths_fail_table_training(spark, vectors):
    broken = vectors.withColumn("x", F.concat("x", F.array(F.lit(1.0))))
    with pytest.raises(Exception, match="3 elements"):
        fit(broken, Model.from_layers(spark, [3, 2]), TrainConfig(epochs=1, strategy="relational"))


def test_fit_follows_the_batch_order_of_the_operator(spark, vectors):
    config = TrainConfig(epochs=2, batch_size=5, shuffle="batches", seed=9, validate_every=0)
    steps = fit(vectors, Model.from_layers(spark, [3, 2]), config).batch_metrics.orderBy("epoch", "step").collect()
    batches = batching.assign_batches(vectors, 5)
    for epoch in (1, 2):
        order = batching.shuffle_batches(batches, 9, epoch).orderBy("position").collect()
        assert [r["batch_num"] for r in steps if r["epoch"] == epoch] == [r["batch_num"] for r in order]
        assert batch_order(spark, 5, 9, epoch) == [r["batch_num"] for r in order]


def test_gradients_are_summed_in_two_levels(spark, vectors, monkeypatch):
    model = Model.from_layers(spark, [3, 2], seed=1)
    shared = spark.sparkContext.broadcast(model.matrices())
    rows = vectors.repartition(9)
    plain = step_plans.gradient_blocks(rows, shared).collect()
    monkeypatch.setattr(step_plans, "FAN_IN", 2)
    blocks = step_plans.gradient_blocks(rows, shared)
    plan = blocks._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(block") == 2
    for a, b in zip(plain, blocks.collect()):
        assert (a["n"], a["correct"]) == (b["n"], b["correct"])
        np.testing.assert_allclose(a["grad"], b["grad"], atol=1e-12)


def test_slices_follow_the_data(spark, monkeypatch):
    df = spark.range(1000).withColumn("k", F.col("id") % 7)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert numbering.slice_count(df) == partitions
    monkeypatch.setattr(numbering, "SLICE_BYTES", 1000)
    assert numbering.slice_count(df) > partitions
    numbered = numbering.number_rows(df, ["k", "id"]).orderBy("row_num").collect()
    assert [r["row_num"] for r in numbered] == list(range(1000))


def test_csv_is_read_by_name(spark, tmp_path):
    path = str(tmp_path / "f")
    spark.createDataFrame([(5, 100, 0.25)], "idx int, sample_id bigint, value double").write.option("header", True).csv(path)
    assert tuple(read_features(spark, path, "csv").first()) == (100, 5, 0.25)
    assert tuple(read_features(spark, path, "csv", {"idx": "sample_id", "sample_id": "idx"}).first()) == (5, 100, 0.25)
    with pytest.raises(ValueError, match="missing"):
        read_labels(spark, path, "csv")
    bad = str(tmp_path / "bad")
    spark.createDataFrame([("x", "1", "2")], "sample_id string, idx string, value string").write.option("header", True).csv(bad)
    with pytest.raises(Exception):
        read_features(spark, bad, "csv").collect()


def test_labels_beyond_the_classes_are_counted(frame):
    found = prep.label_distribution(frame([(1, 3), (2, 12), (3, None)], "sample_id bigint, true_label int"), 4)
    assert {r["true_label"]: r["n"] for r in found.collect()} == {0: 0, 1: 0, 2: 0, 3: 1, 12: 1, None: 1}


def test_weights_in_runs(frame):
    params = frame([(1, 0, i, float(i)) for i in (0, 1, 4, 9)], "layer int, output_idx int, input_idx int, w double")
    found = sorted(tuple(r) for r in codec.collect_weights(params, chunk=4).collect())
    assert found == [(1, 0, 0, [0, 1], [0.0, 1.0]), (1, 0, 1, [4], [4.0]), (1, 0, 2, [9], [9.0])]


def test_a_stored_model_knows_its_scaling(spark):
    store = ModelStore(spark, scratch_path(spark, "model"))
    model = Model.from_layers(spark, [3, 2], seed=1)
    store.save(model.params, model.biases)
    assert store.normalizer() is None
    store.save(model.params, model.biases, (0.5, 0.25))
    assert store.normalizer() == (0.5, 0.25)
    params, biases = store.load()
    assert params.count() == 6 and biases.count() == 2


def test_sparse_plans_start_no_job(spark, features, gaps):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("plan-only", "")
    units = layers.pack_by_input(gaps.layer_params(1), 3)
    layers.linear_packed(features, units, gaps.layer_biases(1), 3)
    assert not tracker.getJobIdsForGroup("plan-only")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
