"""What must not grow: plans with the width of a layer, the driver with the number of batches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tabgrad import Model, TrainConfig, fit, fit_features, forward
from tabgrad.functions import permuted, permuted_from
from tabgrad.operators import batching
from tabgrad.plans import fit as loop
from tabgrad.plans import kernels, numbering
from tabgrad.plans.forward import first_products, gather_vectors
from tabgrad.sources import features_from_vectors, materialize


def test_wide_first_layer_has_a_plan_of_fixed_size(spark, frame):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(9, 5))
    rows = frame([(i, v.tolist()) for i, v in enumerate(x)], "sample_id bigint, x array<double>")
    # Elements of a sample are dealt over tasks, so products of several rows are summed.
    features = features_from_vectors(rows, "sample_id", F.col("x")).repartition(5, "idx")
    sizes = {}
    spark.conf.set("spark.sql.debug.maxToStringFields", 100_000)  # plans are shown whole
    for width in (200, 1024, 4096):
        model = Model.from_layers(spark, [5, width, 3], seed=2)
        first = first_products(features, model)
        sizes[width] = len(first._jdf.queryExecution().optimizedPlan().toString())
        (w, b), (w2, b2) = model.matrices()
        found = {r["sample_id"]: r["z"] for r in first.collect()}
        np.testing.assert_allclose([found[i] for i in range(9)], x @ w.T + b, atol=1e-12)
        logits = {(r["sample_id"], r["class_idx"]): r["logit"] for r in forward(features, model, "arrow").collect()}
        wanted = np.maximum(x @ w.T + b, 0) @ w2.T + b2
        np.testing.assert_allclose([[logits[i, c] for c in range(3)] for i in range(9)], wanted, atol=1e-9)
    spark.conf.unset("spark.sql.debug.maxToStringFields")
    assert sizes[4096] <= sizes[1024] + 20 and sizes[1024] < 1.2 * sizes[200]


@pytest.mark.parametrize("size", [1, 2, 5, 97, 1000])
def test_permutation_is_one_and_undone(spark, size):
    placed = spark.range(size).select("id", permuted(F.col("id"), F.lit(size), 7, 3).alias("p")).collect()
    assert sorted(r["p"] for r in placed) == list(range(size))
    assert all(permuted_from(r["p"], size, 7, 3) == r["id"] for r in placed)
    if size > 10:
        assert np.corrcoef([r["id"] for r in placed], [r["p"] for r in placed])[0, 1] < 0.4
        other = [permuted_from(p, size, 7, 4) for p in range(size)]
        assert other != [permuted_from(p, size, 7, 3) for p in range(size)]


def test_permutation_beyond_32_bits(spark):
    size = 3 * 2**33 + 1
    ids = [0, 1, 2**31, 2**32 + 5, size - 1]
    df = spark.createDataFrame([(i,) for i in ids], "id bigint")
    placed = df.select("id", permuted(F.col("id"), F.lit(size), 1).alias("p")).collect()
    assert all(0 <= r["p"] < size and permuted_from(r["p"], size, 1) == r["id"] for r in placed)
    assert max(r["p"] for r in placed) > 2**31


def test_batch_numbers_beyond_32_bits(spark, frame, monkeypatch):
    start, number = 2**34 + 3, batching.number_rows
    monkeypatch.setattr(
        batching, "number_rows", lambda df, keys, out: number(df, keys, out).withColumn(out, F.col(out) + start)
    )
    samples = frame([(i,) for i in range(9)], "sample_id bigint")
    batches = batching.assign_batches(samples, 2)
    assert {r["sample_id"]: r["batch_num"] for r in batches.collect()} == {i: (start + i) // 2 for i in range(9)}
    assert batching.select_batch(batches, (start + 8) // 2).count() == 2


def test_step_metrics_go_to_a_table_in_parts(spark, frame, monkeypatch):
    rng = np.random.default_rng(5)
    rows = frame([(i, rng.normal(size=3).tolist(), i % 2) for i in range(21)], "sample_id bigint, x array<double>, true_label int")
    model = Model.from_layers(spark, [3, 2], seed=1)
    config = TrainConfig(epochs=2, batch_size=4, shuffle="batches", validate_every=0, seed=3)
    whole = fit(rows, model, config)
    monkeypatch.setattr(loop, "HELD_STEPS", 4)
    parts = fit(rows, model, config)
    for one, other in ((whole.batch_metrics, parts.batch_metrics), (whole.history.drop("time"), parts.history.drop("time"))):
        assert one.dtypes == other.dtypes
        for r, q in zip(*[sorted(map(tuple, df.collect())) for df in (one, other)], strict=True):
            assert r == pytest.approx(q, nan_ok=True)
    steps = whole.batch_metrics.orderBy("epoch", "step").collect()
    for epoch in (1, 2):
        mine = [r for r in steps if r["epoch"] == epoch]
        assert sorted(r["batch_num"] for r in mine) == list(range(6)) and sum(r["n"] for r in mine) == 21
        row = whole.history.filter(F.col("epoch") == epoch).first()
        assert row["train_loss"] == pytest.approx(np.mean([r["loss"] for r in mine]))
        assert row["weighted_loss"] == pytest.approx(np.average([r["loss"] for r in mine], weights=[r["n"] for r in mine]))


def test_slices_do_not_multiply_with_joins(spark, monkeypatch):
    """A join was taken for the product of its sides, which cut a few rows into a slice each."""
    monkeypatch.setattr(numbering, "SLICE_BYTES", 1 << 20)
    rows = spark.range(40_000).withColumnRenamed("id", "sample_id")
    marks = rows.select("sample_id", (F.col("sample_id") % 3).alias("true_label"))
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for how in ("inner", "left", "full_outer", "left_semi"):
        joined = rows.join(marks, "sample_id", how).join(marks.select("sample_id"), "sample_id", how)
        assert numbering.slice_count(joined) == partitions
        # They still follow the sum of the sides.
        least, most = (0.3, 1) if how == "left_semi" else (1, 3.1)
        assert least <= numbering.slice_count(joined, 32_000) / 10 <= most
    numbered = numbering.number_rows(rows.join(marks, "sample_id"), ["sample_id"]).collect()
    assert all(r["row_num"] == r["sample_id"] for r in numbered) and len(numbered) == 40_000


@pytest.mark.parametrize("plan, gather", [("arrow", "gather_vectors"), ("hybrid", "gather_entries")])
def test_long_tables_are_gathered_once_into_few_slices(spark, frame, monkeypatch, plan, gather):
    rng = np.random.default_rng(8)
    rows = materialize(frame([(i, rng.normal(size=3).tolist(), i % 2) for i in range(90)], "sample_id bigint, x array<double>, true_label int"))
    features, labels = features_from_vectors(rows, "sample_id", F.col("x")), rows.drop("x")
    found = {"BatchTable": [], "validate": [], gather: []}

    def noted(name, real):
        def call(*args):
            result = real(*args)
            found[name].append(result if name == "BatchTable" else args[0])
            return result

        monkeypatch.setattr(loop, name, call)

    for name in found:
        noted(name, getattr(loop, name))
    monkeypatch.setattr(numbering, "SLICE_BYTES", 1 << 16)
    model = Model.from_layers(spark, [3, 4, 2], seed=1)
    epochs = 2 if plan == "arrow" else 1
    config = TrainConfig(epochs=epochs, batch_size=90, lr=0.25, strategy=plan, shuffle="samples")
    other = features.filter("sample_id < 40"), labels.filter("sample_id < 40")
    for validation, times in (((features, labels), 1), (other, 2), (None, 1)):
        for calls in found.values():
            calls.clear()
        history = fit_features(features, labels, model, config, validation).history.orderBy("epoch").collect()
        assert len(found[gather]) == times and len(found["validate"]) == (epochs if validation else 0)
        # Each epoch reads what was written, in slices by its size.
        assert all("Join" not in df._jdf.queryExecution().optimizedPlan().toString() for df in found["validate"])
        assert len(found["BatchTable"]) == epochs
        assert max(len(table.starts) for table in found["BatchTable"]) <= int(spark.conf.get("spark.sql.shuffle.partitions"))
        if plan == "arrow":
            wanted = fit(rows, model, config, validation and (rows if times == 1 else rows.filter("sample_id < 40")))
            for r, q in zip(history, wanted.history.orderBy("epoch").collect(), strict=True):
                assert tuple(r)[:-1] == pytest.approx(tuple(q)[:-1])


@pytest.mark.parametrize("kind", ["bigint", "string"])
def test_vectors_are_whole_wherever_their_elements_lie(spark, frame, kind):
    rng = np.random.default_rng(3)
    wanted, rows = {}, []
    for _ in range(4000):
        sample = None if (k := int(rng.integers(40))) == 7 else str(k) if kind == "string" else k
        idx, value = int(rng.integers(-1, 7)), None if rng.random() < 0.1 else float(rng.integers(-8, 8)) / 4
        rows.append((sample, idx, value))
        if 0 <= idx < 6:
            wanted.setdefault(sample, np.zeros(6))[idx] += value or 0.0
    rows.append((str(99) if kind == "string" else 99, 6, 1.0))  # no sample: its element is outside
    schema = f"sample_id {kind}, idx int, value double"
    shuffled = materialize(frame(rows, schema).repartition(5))
    in_order = materialize(frame(sorted(rows, key=repr), schema).coalesce(1))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 37)
    try:
        for features in (shuffled, in_order):
            found = gather_vectors(features, 6).collect()
            assert len(found) == len(wanted)
            assert all(r["x"] == wanted[r["sample_id"]].tolist() for r in found)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@pytest.mark.parametrize("held", [1, 100, 1 << 20])
def test_merging_holds_a_bounded_part(monkeypatch, held):
    monkeypatch.setattr(kernels, "VECTOR_BYTES", held)
    lists = {"sample_id": pa.int64(), "idx": pa.list_(pa.int32()), "value": pa.list_(pa.float64())}
    rows = [(1, [0, 2], [1.0, 2.0]), (1, [2], [3.0]), (2, [1], [4.0]), (3, [], []), (3, [0], [5.0]), (3, [0], [6.0]), (3, [1], [7.0]), (None, [2], [8.0])]
    for cut in range(len(rows)):
        parts = [pa.RecordBatch.from_pylist([dict(zip(lists, r)) for r in some], schema=pa.schema(lists)) for some in (rows[:cut], rows[cut:])]
        found = [r for b in kernels.merge_entries(iter(parts), 3) for r in b.to_pylist()]
        assert [(r["sample_id"], r["x"]) for r in found] == [(1, [1, 0, 5]), (2, [0, 4, 0]), (3, [11, 7, 0]), (None, [0, 0, 8])]
        assert all(b.num_rows <= max(1, held // 24) for b in kernels.merge_entries(iter(parts), 3))
