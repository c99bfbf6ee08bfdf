"""Loss, accuracy and parity. Empty input gives NULL loss and accuracy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOG_FLOOR = 1e-10
LOGIT_TOLERANCE = 0.01

# Bounds of the parity tiers and their names, tightest first.
PARITY_TIERS = ((1e-5, "EXCELLENT"), (1e-3, "GOOD"), (1e-2, "ACCEPTABLE"))


def flag(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)


def clamped_loss(p_true: Column) -> Column:
    return -F.log(F.greatest(p_true, F.lit(LOG_FLOOR)))


def share(hits: Column, total: Column) -> Column:
    return F.try_divide(hits.cast("double"), total)


def score_samples(probabilities: DataFrame, labels: DataFrame) -> DataFrame:
    """``(sample_id, true_label, prediction, p_true, loss, correct)`` in one aggregation per sample."""
    best = F.max(F.struct("probability", (-F.col("class_idx")).alias("_neg")))
    p_true = F.max(F.when(F.col("class_idx") == F.col("true_label"), F.col("probability")))
    grouped = (
        probabilities.join(labels, "sample_id")
        .groupBy("sample_id", "true_label")
        .agg(best.alias("_best"), p_true.alias("p_true"))
    )
    prediction = (-F.col("_best._neg")).cast("int")
    loss = F.when(F.col("p_true").isNotNull(), clamped_loss(F.col("p_true")))
    return grouped.select(
        "sample_id",
        "true_label",
        prediction.alias("prediction"),
        "p_true",
        loss.alias("loss"),
        flag(prediction == F.col("true_label")).alias("correct"),
    )


def sample_losses(probabilities: DataFrame, labels: DataFrame) -> DataFrame:
    """``(sample_id, loss)`` for samples that have a probability for their label."""
    true_class = labels.select("sample_id", F.col("true_label").alias("class_idx"))
    return probabilities.join(true_class, ["sample_id", "class_idx"]).select(
        "sample_id", clamped_loss(F.col("probability")).alias("loss")
    )


def cross_entropy(losses: DataFrame) -> DataFrame:
    return losses.agg(F.avg("loss").alias("loss"), F.count("loss").alias("batch_size"))


def loss_summary(losses: DataFrame) -> DataFrame:
    return losses.agg(
        F.avg("loss").alias("average_loss"),
        F.sum("loss").alias("total_loss"),
        F.count(F.lit(1)).alias("batch_size"),
        F.min("loss").alias("min_loss"),
        F.max("loss").alias("max_loss"),
    )


def accuracy(predictions: DataFrame, labels: DataFrame) -> DataFrame:
    """Share of labelled, predicted samples whose top class is the label."""
    hit = flag(F.col("prediction") == F.col("true_label"))
    joined = predictions.join(labels, "sample_id").select(hit.alias("_hit"))
    return joined.agg(share(F.sum("_hit"), F.count(F.lit(1))).alias("accuracy"))


def validation_accuracy(scored: DataFrame) -> DataFrame:
    """Correct and total counts, accuracy and loss of ``score_samples`` rows, in one aggregate."""
    return scored.agg(
        F.coalesce(F.sum("correct"), F.lit(0)).alias("correct_count"),
        F.count(F.lit(1)).alias("total_count"),
        share(F.sum("correct"), F.count(F.lit(1))).alias("accuracy"),
        F.avg("loss").alias("loss"),
    )


def loss_and_accuracy(scored: DataFrame) -> DataFrame:
    return validation_accuracy(scored).select("loss", "accuracy")


def score_against_truth(labels: DataFrame, predictions: DataFrame, ordered: bool = False) -> DataFrame:
    """Every label with its prediction, if any; an unpredicted sample counts as wrong."""
    hit = flag(F.coalesce(F.col("prediction") == F.col("true_label"), F.lit(False)))
    scored = labels.join(
        predictions.select("sample_id", "prediction", "logit"), "sample_id", "left"
    ).select("sample_id", "true_label", "prediction", "logit", hit.alias("correct"))
    return scored.orderBy("sample_id") if ordered else scored


def paired_parity(labels: DataFrame, scored: DataFrame) -> DataFrame:
    """Two models over the same rows, scored side by side, for every labelled sample.

    ``scored`` has the prediction and logit of both, as ``ours_`` and ``theirs_`` columns of one row,
    so neither is joined to the other.
    """
    sides = [f"{tag}_{what}" for tag in ("ours", "theirs") for what in ("prediction", "logit")]
    joined = labels.select("sample_id", "true_label").join(scored.select("sample_id", *sides), "sample_id", "left")
    return _compared(joined, F.col("true_label"))


def parity_mismatches(parity: DataFrame) -> DataFrame:
    """The samples on which the two predictions differ, or one is missing."""
    return parity.filter("predictions_match = 0").select(
        "sample_id", "true_label", "ours_prediction", "theirs_prediction", "logit_diff"
    )


def prediction_parity(ours: DataFrame, theirs: DataFrame) -> DataFrame:
    """Two scored sets side by side, for samples that both hold with the same label.

    Joined on the id alone, so inputs already partitioned by it need no further shuffle. The labels
    are compared by their difference: as an equality they would become a second join key.
    """

    def side(df: DataFrame, tag: str) -> DataFrame:
        return df.select(
            "sample_id",
            F.col("true_label").alias(f"{tag}_label"),
            F.col("prediction").alias(f"{tag}_prediction"),
            F.col("logit").alias(f"{tag}_logit"),
        )

    joined = side(ours, "ours").join(side(theirs, "theirs"), "sample_id")
    label = F.col("ours_label")
    return _compared(joined.filter(label - F.col("theirs_label") == 0), label)


def _compared(joined: DataFrame, label: Column) -> DataFrame:
    return joined.select(
        "sample_id",
        label.alias("true_label"),
        "ours_prediction",
        "ours_logit",
        "theirs_prediction",
        "theirs_logit",
        flag(F.col("ours_prediction") == F.col("theirs_prediction")).alias("predictions_match"),
        F.abs(F.col("ours_logit") - F.col("theirs_logit")).alias("logit_diff"),
        flag(F.col("ours_prediction") == label).alias("ours_correct"),
        flag(F.col("theirs_prediction") == label).alias("theirs_correct"),
    )


def parity_summary(parity: DataFrame) -> DataFrame:
    """Match rate, accuracies, logit differences and a verdict, in one row."""
    total = F.count(F.lit(1))
    row = parity.agg(
        total.alias("total_samples"),
        F.coalesce(F.sum("predictions_match"), F.lit(0)).alias("matches"),
        (share(F.sum("predictions_match"), total) * 100).alias("match_rate"),
        (share(F.sum("ours_correct"), total) * 100).alias("ours_accuracy"),
        (share(F.sum("theirs_correct"), total) * 100).alias("theirs_accuracy"),
        F.avg("logit_diff").alias("avg_logit_diff"),
        F.max("logit_diff").alias("max_logit_diff"),
    )
    all_match = (F.col("total_samples") > 0) & (F.col("matches") == F.col("total_samples"))
    verdict = (
        F.when(all_match & (F.col("max_logit_diff") < LOGIT_TOLERANCE), "SUCCESS")
        .when(all_match, "PARTIAL SUCCESS")
        .otherwise("MISMATCH")
    )
    return row.select(
        "*",
        (F.col("total_samples") - F.col("matches")).alias("mismatches"),
        verdict.alias("verdict"),
    )


def parity_tier(diff: Column) -> Column:
    chain = None
    for bound, name in PARITY_TIERS:
        chain = (F if chain is None else chain).when(diff < bound, name)
    return chain.otherwise("DIFFERENT")


def paired_logit_parity(scored: DataFrame, ours: str = "ours", theirs: str = "theirs") -> DataFrame:
    """``logit_parity`` of rows that carry both models' logits as arrays; no join."""
    largest = F.array_max(F.zip_with(ours, theirs, lambda a, b: F.abs(a - b)))
    return _parity_tiers(scored.groupBy("sample_id").agg(F.max(largest).alias("max_diff")))


def logit_parity(ours: DataFrame, theirs: DataFrame) -> DataFrame:
    """Largest logit difference with its tier, per sample and, with sample_id NULL, overall."""
    paired = ours.select("sample_id", "class_idx", F.col("logit").alias("_a")).join(
        theirs.select("sample_id", "class_idx", F.col("logit").alias("_b")), ["sample_id", "class_idx"]
    )
    largest = F.max(F.abs(F.col("_a") - F.col("_b"))).alias("max_diff")
    return _parity_tiers(paired.groupBy("sample_id").agg(largest))


def _parity_tiers(per_sample: DataFrame) -> DataFrame:
    diff = F.col("max_diff")
    return (
        per_sample.rollup("sample_id")
        .agg(F.max(diff).alias("max_diff"))
        .select("sample_id", "max_diff", parity_tier(diff).alias("tier"), flag(diff < LOGIT_TOLERANCE).alias("passed"))
    )


def agreement_counts(parity: DataFrame) -> DataFrame:
    """How often two models are both right, both wrong or differ in correctness."""
    ours, theirs = F.col("ours_correct") == 1, F.col("theirs_correct") == 1

    def count_where(condition: Column, name: str) -> Column:
        return F.count(F.when(condition, 1)).alias(name)

    return parity.agg(
        F.count(F.lit(1)).alias("total_samples"),
        count_where(ours & theirs, "both_correct"),
        count_where(~ours & ~theirs, "both_wrong"),
        count_where(ours != theirs, "disagree"),
        count_where(ours, "ours_correct"),
        count_where(theirs, "theirs_correct"),
    )
