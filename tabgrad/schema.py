"""Canonical tables: one row per scalar, doubles for values, bigints for sample ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FEATURES = T.StructType(
    [
        T.StructField("sample_id", T.LongType()),
        T.StructField("idx", T.IntegerType()),
        T.StructField("value", T.DoubleType()),
    ]
)
LABELS = T.StructType(
    [
        T.StructField("sample_id", T.LongType()),
        T.StructField("true_label", T.IntegerType()),
    ]
)
PARAMS = T.StructType(
    [
        T.StructField("layer", T.IntegerType()),
        T.StructField("output_idx", T.IntegerType()),
        T.StructField("input_idx", T.IntegerType()),
        T.StructField("w", T.DoubleType()),
    ]
)
BIASES = T.StructType(
    [
        T.StructField("layer", T.IntegerType()),
        T.StructField("output_idx", T.IntegerType()),
        T.StructField("b", T.DoubleType()),
    ]
)
HISTORY = T.StructType(
    [
        T.StructField("epoch", T.IntegerType()),
        T.StructField("train_loss", T.DoubleType()),
        T.StructField("train_accuracy", T.DoubleType()),
        T.StructField("weighted_loss", T.DoubleType()),
        T.StructField("weighted_accuracy", T.DoubleType()),
        T.StructField("val_loss", T.DoubleType()),
        T.StructField("val_accuracy", T.DoubleType()),
        T.StructField("time", T.DoubleType()),
    ]
)
BATCH_METRICS = T.StructType(
    [
        T.StructField("epoch", T.IntegerType()),
        T.StructField("step", T.LongType()),
        T.StructField("batch_num", T.LongType()),
        T.StructField("n", T.LongType()),
        T.StructField("loss", T.DoubleType()),
        T.StructField("accuracy", T.DoubleType()),
    ]
)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project and cast ``df`` to ``schema``; a missing column is an error, an extra one is dropped."""
    missing = [f.name for f in schema if f.name not in df.columns]
    if missing:
        raise ValueError(f"columns {missing} are missing; found {df.columns}")
    return df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in schema))


def known_elements(features: DataFrame, width: int) -> DataFrame:
    """Feature rows by the rules that every plan follows.

    NULL counts as 0.0. An element outside ``0..width - 1`` is none, so a sample without another one
    is no sample; ``outside_elements`` reports them.
    """
    value = F.coalesce("value", F.lit(0.0)).alias("value")
    return features.filter(F.col("idx").between(0, width - 1)).select("sample_id", "idx", value)


def outside_elements(features: DataFrame, width: int) -> DataFrame:
    """One row ``(elements, samples)``: what ``known_elements`` leaves out, and in how many samples."""
    inside = F.coalesce(F.col("idx").between(0, width - 1), F.lit(False))
    return features.filter(~inside).agg(
        F.count(F.lit(1)).alias("elements"), F.countDistinct("sample_id").alias("samples")
    )


def checked_label(n_classes: int) -> Column:
    """``true_label``; a sample without a label in ``0..n_classes - 1`` fails the job that reads it."""
    label = F.col("true_label")
    message = F.format_string(f"labels must be in 0..{n_classes - 1}, found %s", label.cast("string"))
    return F.when(label.between(0, n_classes - 1), label).otherwise(F.raise_error(message).cast("int"))


def key_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that are NULL or occur more than once; duplicates would multiply joined rows."""
    null_key = F.lit(False)
    for key in keys:
        null_key = null_key | F.col(key).isNull()
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("occurrences"))
        .filter((F.col("occurrences") > 1) | null_key)
    )


def training_input_violations(features: DataFrame, labels: DataFrame, n_classes: int) -> DataFrame:
    """Samples that training must reject: no label, no features, a repeated label or a class out of range."""
    seen = features.groupBy("sample_id").agg(F.count(F.lit(1)).alias("_elements"))
    named = labels.groupBy("sample_id").agg(
        F.count("true_label").alias("_labels"),
        F.min("true_label").alias("_low"),
        F.max("true_label").alias("_high"),
    )
    reason = (
        F.when(F.coalesce("_labels", F.lit(0)) == 0, "no label")
        .when(F.col("_elements").isNull(), "no features")
        .when(F.col("_labels") > 1, "repeated label")
        .when((F.col("_low") < 0) | (F.col("_high") >= n_classes), "class out of range")
    )
    return (
        seen.join(named, "sample_id", "full_outer")
        .select("sample_id", reason.alias("reason"))
        .filter("reason is not null")
    )


def require_valid(violations: DataFrame, what: str) -> None:
    """Raise with a few examples when ``violations`` has rows."""
    examples = violations.limit(5).collect()
    if examples:
        raise ValueError(f"invalid {what}: {[row.asDict() for row in examples]}")
