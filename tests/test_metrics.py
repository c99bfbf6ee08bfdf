import math

import pytest

from tabgrad.operators import metrics, reports
from tabgrad.plans.fit import best_epoch, epoch_metrics, history_summary
from tabgrad.schema import HISTORY

PROB_DDL = "sample_id bigint, class_idx int, probability double"
LABEL_DDL = "sample_id bigint, true_label int"
PRED_DDL = "sample_id bigint, prediction int, logit double"


@pytest.fixture(scope="module")
def probabilities(spark):
    data = [(1, 0, 0.9), (1, 1, 0.1), (2, 0, 0.5), (2, 1, 0.5), (3, 0, 1.0), (3, 1, 0.0)]
    return spark.createDataFrame(data, PROB_DDL)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 0), (2, 1), (3, 1)], LABEL_DDL)


def test_score_samples(probabilities, labels, rows):
    scored = rows(metrics.score_samples(probabilities, labels))
    assert [r[2] for r in scored] == [0, 0, 0]
    assert [r[5] for r in scored] == [1, 0, 0]
    assert math.isclose(scored[2][4], 23.025850929940457)


def test_losses(probabilities, labels):
    losses = metrics.sample_losses(probabilities, labels)
    values = [-math.log(0.9), -math.log(0.5), 23.025850929940457]
    summary = metrics.loss_summary(losses).first()
    assert math.isclose(summary["average_loss"], sum(values) / 3)
    assert math.isclose(summary["total_loss"], sum(values))
    assert (summary["batch_size"], summary["min_loss"], summary["max_loss"]) == (3, values[0], values[2])
    assert metrics.cross_entropy(losses).first()["batch_size"] == 3


def test_accuracy_and_empty_input(probabilities, labels, frame):
    scored = metrics.score_samples(probabilities, labels)
    row = metrics.validation_accuracy(scored).first()
    assert (row["correct_count"], row["total_count"]) == (1, 3) and math.isclose(row["accuracy"], 1 / 3)
    empty = scored.filter("sample_id > 9")
    assert tuple(metrics.loss_and_accuracy(empty).first()) == (None, None)
    assert tuple(metrics.validation_accuracy(empty).first()) == (0, 0, None, None)
    predictions = frame([(1, 0, 1.0), (2, 0, 1.0), (9, 1, 1.0)], PRED_DDL)
    assert metrics.accuracy(predictions, labels).first()[0] == 0.5
    assert metrics.accuracy(predictions.filter("sample_id = 9"), labels).first()[0] is None


def test_score_against_truth_keeps_unpredicted(labels, frame, rows):
    predictions = frame([(1, 0, 2.0), (2, 0, 3.0)], PRED_DDL)
    assert rows(metrics.score_against_truth(labels, predictions, ordered=True)) == [
        (1, 0, 0, 2.0, 1),
        (2, 1, 0, 3.0, 0),
        (3, 1, None, None, 0),
    ]


@pytest.fixture(scope="module")
def parity(spark):
    schema = "sample_id bigint, true_label int, prediction int, logit double"
    ours = spark.createDataFrame([(1, 0, 0, 1.0), (2, 1, 1, 2.0), (3, 1, 0, 3.0), (4, 0, 0, 1.0)], schema)
    theirs = spark.createDataFrame([(1, 0, 0, 1.5), (2, 1, 0, 2.0), (3, 1, 0, 2.0), (4, 1, 0, 1.0)], schema)
    return metrics.prediction_parity(ours, theirs)


def test_parity(parity, rows):
    assert [r[0] for r in rows(parity)] == [1, 2, 3]
    row = metrics.parity_summary(parity).first()
    assert (row["total_samples"], row["matches"], row["mismatches"], row["verdict"]) == (3, 2, 1, "MISMATCH")
    assert math.isclose(row["avg_logit_diff"], 0.5) and row["max_logit_diff"] == 1.0
    counts = metrics.agreement_counts(parity).first()
    assert tuple(counts) == (3, 1, 1, 1, 2, 1)


def test_parity_verdicts(parity):
    same = parity.filter("predictions_match = 1")
    assert metrics.parity_summary(same).first()["verdict"] == "PARTIAL SUCCESS"
    close = same.withColumn("logit_diff", same["logit_diff"] / 1000)
    assert metrics.parity_summary(close).first()["verdict"] == "SUCCESS"
    none = metrics.parity_summary(parity.filter("sample_id > 9")).first()
    assert none["match_rate"] is None and none["verdict"] == "MISMATCH"


def test_logit_parity_tiers(frame, rows):
    schema = "sample_id bigint, class_idx int, logit double"
    ours = frame([(1, 0, 1.0), (2, 0, 1.0), (3, 0, 1.0), (4, 0, 1.0)], schema)
    theirs = frame([(1, 0, 1.0), (2, 0, 1.0005), (3, 0, 1.005), (4, 0, 2.0)], schema)
    got = {r[0]: r[2:] for r in rows(metrics.logit_parity(ours, theirs))}
    assert got == {
        1: ("EXCELLENT", 1),
        2: ("GOOD", 1),
        3: ("ACCEPTABLE", 1),
        4: ("DIFFERENT", 0),
        None: ("DIFFERENT", 0),
    }


def test_reports(frame, rows):
    schema = "sample_id bigint, true_label int, prediction int, logit double, correct int"
    scored = frame(
        [(1, 0, 0, 5.0, 1), (2, 0, 1, 4.0, 0), (3, 1, 1, 2.0, 1), (4, 1, 0, 4.0, 0), (5, 1, None, None, 0)], schema
    )
    assert tuple(reports.overall_accuracy(scored).first()) == (5, 2, 40.0)
    assert rows(reports.correct_breakdown(scored)) == [("Correct", 2), ("Incorrect", 3)]
    assert rows(reports.confusion_matrix(scored)) == [(0, 1, 1), (1, 0, 1), (1, None, 1)]
    assert reports.confusion_matrix(scored, wrong_only=False).count() == 5
    assert rows(reports.per_class_accuracy(scored)) == [(0, 2, 1, 50.0), (1, 3, 1, 33.33)]
    assert [r["sample_id"] for r in reports.hardest_correct(scored, 1).collect()] == [3]
    assert [r["sample_id"] for r in reports.confident_wrong(scored).collect()] == [2, 4, 5]


def test_history_reports(spark, frame, rows):
    steps = frame(
        [(1, 0, 0, 30, 1.0, 0.5), (1, 1, 1, 10, 3.0, 0.1)],
        "epoch int, step int, batch_num int, n bigint, loss double, accuracy double",
    )
    got = epoch_metrics(steps).first()
    assert got["train_loss"] == 2.0 and got["weighted_loss"] == 1.5 and math.isclose(got["weighted_accuracy"], 0.4)
    losses = [None, 2.0, 0.0, 0.0, 1.0]
    history = spark.createDataFrame(
        [(e, 3.0 - e, 0.1 * e, 1.0, 1.0, v, None, 2.0) for e, v in enumerate(losses, start=1)], HISTORY
    )
    assert [r[2] for r in rows(best_epoch(history))] == [0, 1, 1, 0, 0]
    summary = history_summary(history).first()
    assert tuple(summary) == (5, 10.0, 2.0, 0.0, -2.0, 0.5)
