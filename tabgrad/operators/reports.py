"""Diagnostic reports over feature, weight, logit and scored tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREVIEW_CHARS = 50


def percent(column: str) -> Column:
    return F.round(F.avg(F.col(column).cast("double")) * 100, 2)


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table, ordered by name."""
    counts = (
        df.agg(F.count(F.lit(1)).alias("count")).select("count", F.lit(name).alias("table_name"))
        for name, df in tables.items()
    )
    return reduce(DataFrame.unionByName, counts).orderBy("table_name")


def weight_preview(weights: DataFrame, n: int = 5) -> DataFrame:
    """Length and first characters of the weight text of the first ``n`` neurons."""
    return (
        weights.orderBy("output_idx")
        .limit(n)
        .select(
            "output_idx",
            F.length("weights").alias("weight_string_length"),
            F.substring("weights", 1, PREVIEW_CHARS).alias("weight_preview"),
        )
    )


def bias_report(biases: DataFrame, n: int = 10) -> DataFrame:
    return (
        biases.orderBy("output_idx")
        .limit(n)
        .select("output_idx", F.col("b").alias("bias_value"), F.abs("b").alias("abs_value"))
    )


def feature_stats(features: DataFrame) -> DataFrame:
    return (
        features.groupBy("sample_id")
        .agg(F.min("value").alias("min_value"), F.max("value").alias("max_value"), F.avg("value").alias("avg_value"))
        .orderBy("sample_id")
    )


def logit_stats(logits: DataFrame) -> DataFrame:
    return (
        logits.groupBy("sample_id")
        .agg(
            F.count(F.lit(1)).alias("num_classes"),
            F.round(F.min("logit"), 4).alias("min_logit"),
            F.round(F.max("logit"), 4).alias("max_logit"),
            F.round(F.avg("logit"), 4).alias("avg_logit"),
        )
        .orderBy("sample_id")
    )


def sample_logits(logits: DataFrame, sample_id: int) -> DataFrame:
    return (
        logits.filter(F.col("sample_id") == sample_id)
        .select("sample_id", "class_idx", F.round("logit", 4).alias("logit"))
        .orderBy("class_idx")
    )


def prediction_report(predictions: DataFrame) -> DataFrame:
    return predictions.select(
        "sample_id",
        "prediction",
        F.round("logit", 4).alias("logit"),
        F.round("probability", 4).alias("probability"),
    ).orderBy("sample_id")


def _scored_row() -> list[Column]:
    return [
        F.col("sample_id"),
        F.col("true_label"),
        F.col("prediction"),
        F.round("logit", 4).alias("logit"),
        F.col("correct"),
    ]


def truth_report(scored: DataFrame) -> DataFrame:
    return scored.select(*_scored_row()).orderBy("sample_id")


def overall_accuracy(scored: DataFrame) -> DataFrame:
    return scored.agg(
        F.count(F.lit(1)).alias("total_samples"),
        F.sum("correct").alias("correct_predictions"),
        percent("correct").alias("accuracy_percentage"),
    )


def correct_breakdown(scored: DataFrame) -> DataFrame:
    result = F.when(F.col("correct") == 1, "Correct").otherwise("Incorrect")
    return scored.groupBy(result.alias("result")).agg(F.count(F.lit(1)).alias("count"))


def confusion_matrix(scored: DataFrame, wrong_only: bool = True) -> DataFrame:
    rows = scored.filter("correct = 0") if wrong_only else scored
    return (
        rows.groupBy("true_label", "prediction")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy("true_label", "prediction")
    )


def per_class_accuracy(scored: DataFrame) -> DataFrame:
    return (
        scored.groupBy("true_label")
        .agg(
            F.count(F.lit(1)).alias("total_samples"),
            F.sum("correct").alias("correct"),
            percent("correct").alias("accuracy_pct"),
        )
        .orderBy("true_label")
    )


def hardest_correct(scored: DataFrame, n: int = 5) -> DataFrame:
    """Correct samples with the lowest logits; ties go to the lowest id."""
    ranked = scored.filter("correct = 1").orderBy(F.asc_nulls_last("logit"), "sample_id")
    return ranked.limit(n).select(*_scored_row())


def confident_wrong(scored: DataFrame, n: int = 5) -> DataFrame:
    """Wrong samples with the highest logits; ties go to the lowest id."""
    ranked = scored.filter("correct = 0").orderBy(F.desc_nulls_last("logit"), "sample_id")
    return ranked.limit(n).select(*_scored_row())
