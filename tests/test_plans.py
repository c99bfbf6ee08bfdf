"""What the physical plans must and must not contain."""

import pytest
from pyspark.sql import functions as F

from tabgrad import Model, forward, score, score_predictions
from tabgrad.operators import layers, metrics
from workloads import tables as t
from workloads.queries import QUERIES

SF = "/root/testdata/sf0.001"


def executed(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def planned(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def model(spark):
    return t.dyadic_model(spark, t.VECTOR_LAYERS)


def test_scoring_rows_needs_no_shuffle(spark, model):
    for plan in ("arrow", "dense"):
        text = planned(score(t.vector_rows(spark, SF), model, strategy=plan))
        assert "hashpartitioning" not in text.split("Subquery")[0] and "rangepartitioning" not in text


def test_dense_plan_is_one_fold(spark, model):
    text = planned(score(t.vector_rows(spark, SF), model, strategy="dense").select("logits"))
    assert text.count(".units, ") == 1 and text.count("transform(embedding") == 1


def test_hybrid_forward_shuffles_samples_once(spark, model):
    text = planned(forward(t.vector_features(spark, SF), model, "hybrid"))
    assert text.count("Exchange hashpartitioning(sample_id") == 1
    assert "partial_sum" in text and "BroadcastHashJoin" in text


def test_arrow_forward_sums_before_its_only_shuffle(spark, model):
    text = planned(forward(t.vector_features(spark, SF), model))
    assert text.count("Exchange hashpartitioning(sample_id") == 1
    after = text.split("Exchange hashpartitioning(sample_id")[1]
    assert "partial_sum" in after and "MapInArrow" in after


def test_line_scoring_reads_needed_columns_only(spark):
    scored = score_predictions(t.line_rows(spark, SF), t.dyadic_model(spark, t.ORDER_LAYERS))
    text = planned(scored.groupBy("true_label", "prediction").count())
    schema = text.split("ReadSchema: ")[1].split(">")[0]
    assert sorted(c.split(":")[0].strip() for c in schema.removeprefix("struct<").split(",")) == [
        "l_discount", "l_extendedprice", "l_quantity", "l_returnflag", "l_tax",
    ]
    assert text.count("ArrowEvalPython") == 1


def test_lookup_filters_the_scan(spark, model):
    features = t.vector_features(spark, SF)
    found = [
        layers.lookup_sample(forward(features, model, "hybrid"), 7),
        QUERIES["lookup_sample"](spark, SF),
        QUERIES["sample_logits"](spark, SF),
    ]
    for df in found:
        assert "PushedFilters: [IsNotNull(vec_id), EqualTo(vec_id,7)" in planned(df)


def test_top_reports_do_not_sort_everything(spark):
    for name in ("hardest_correct", "confident_wrong"):
        assert "TakeOrderedAndProject" in planned(QUERIES[name](spark, SF))


def test_parity_reuses_the_partitioning(spark):
    labels = spark.range(50).selectExpr("id as sample_id", "cast(id % 3 as int) as true_label")
    predictions = labels.selectExpr("sample_id", "true_label as prediction", "0.5D as logit")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        sides = [
            metrics.score_against_truth(labels.sample(f, 1), predictions.sample(f, 2)) for f in (0.9, 0.8)
        ]
        text = planned(metrics.prediction_parity(*sides))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Labels and predictions move once on each side; the parity join itself moves nothing.
    assert text.count("Exchange hashpartitioning") == 4


def test_wide_layer_is_not_broadcast(spark):
    units, features = t.basket_units(spark, SF), t.basket_features(spark, SF)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        sums = layers.weighted_sums(
            features.withColumnRenamed("idx", "input_idx"), units, "input_idx", "sample_id", t.BASKET_HIDDEN
        )
        # Only the hot keys, at most 128, and their units are broadcast; the layer itself is shuffled.
        text = planned(sums)
        assert "SortMergeJoin" in text and "LeftSemi" in text and "LeftAnti" in text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


CROSS = ("CartesianProduct", "BroadcastNestedLoopJoin")


@pytest.mark.parametrize("name", ["one_hot", "forward_pass", "weight_gradient", "validation_accuracy", "parity_summary", "logit_parity", "label_distribution", "train_step_array"])
def test_no_cross_joins(spark, name):
    text = executed(QUERIES[name](spark, SF))
    assert not any(c in text for c in CROSS)


def test_global_order_never_uses_one_partition(spark):
    text = planned(QUERIES["truth_report"](spark, SF))
    assert "rangepartitioning" in text and "SinglePartition" not in text


def test_model_size_bounds_broadcasts(spark):
    rows = spark.range(10).select(
        F.col("id").alias("sample_id"), (F.col("id") % 2).cast("int").alias("idx"), F.lit(1.0).alias("value")
    )
    model = Model.from_layers(spark, [2, 2])
    small = layers.linear(rows, model.layer_params(1), model.layer_biases(1), 2, 2)
    assert "BroadcastHashJoin" in planned(small)
