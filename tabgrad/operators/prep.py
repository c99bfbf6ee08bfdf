"""Normalising, splitting and initialising."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabgrad.functions.seeded import PRIME, order_key, seeded_uniform
from tabgrad.plans.numbering import number_rows
from tabgrad.sources.readers import features_from_vectors

# The two published image normalisers (mean, standard deviation).
TRAINING_NORMALIZER = (0.1307, 0.3081)
INFERENCE_NORMALIZER = (0.5, 0.5)


def normalize(features: DataFrame, mean: float, std: float) -> DataFrame:
    return features.withColumn("value", (F.col("value") - mean) / std)


def normalize_flatten(
    df: DataFrame, key: str, vector: Column, mean: float, std: float
) -> DataFrame:
    """One array per sample to scaled elements, one row each."""
    return features_from_vectors(df, key, vector, lambda v: (v - mean) / std)


def fit_normalizer(features: DataFrame) -> DataFrame:
    """One row (mean, std) over all elements."""
    return features.agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"))


_KEY_RANGES = 1024


def _lowest_candidates(keyed: DataFrame, n: int, by: list[str]) -> DataFrame:
    """Rows whose key range can hold one of the ``n`` lowest keys (of each group).

    Counting rows per key range takes one small aggregate and spares ordering the whole table when
    few samples are drawn; every row it drops has at least ``n`` rows below it.
    """
    key_range = F.floor(F.col("_key") * _KEY_RANGES / PRIME).cast("int")
    ranged = keyed.withColumn("_range", key_range)
    counts = ranged.groupBy(*by, "_range").agg(F.count(F.lit(1)).alias("_rows"))
    below = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    needed = counts.withColumn("_below", F.coalesce(F.sum("_rows").over(below), F.lit(0)))
    needed = needed.filter(F.col("_below") < n).select(*by, "_range")
    return ranged.join(needed, [*by, "_range"], "left_semi").drop("_range")


def sample_random(
    labels: DataFrame, n_train: int, n_val: int, seed: int = 42, id_offset: int = 0
) -> DataFrame:
    """Draw ``n_train`` then ``n_val`` ids in a seeded order and number each split from ``id_offset``."""
    keyed = labels.select("sample_id", order_key(F.col("sample_id"), seed).alias("_key"))
    candidates = _lowest_candidates(keyed, n_train + n_val, [])
    ranked = number_rows(candidates, ["_key", "sample_id"], "_rank")
    drawn = ranked.filter(F.col("_rank") < n_train + n_val)
    is_train = F.col("_rank") < n_train
    return drawn.select(
        "sample_id",
        F.when(is_train, "train").otherwise("val").alias("split"),
        (F.when(is_train, F.col("_rank")).otherwise(F.col("_rank") - n_train) + id_offset).alias("new_id"),
    )


def sample_stratified(
    labels: DataFrame, train_per_class: int, val_per_class: int, seed: int = 42, id_offset: int = 0
) -> DataFrame:
    """Draw the same number of ids from each class for each split.

    Ranks come from one numbering over (label, key, id), so no class is gathered in one task; the
    start of each class is its smallest number. Each split is numbered by class, then drawn order.
    """
    keyed = labels.select(
        "sample_id", "true_label", order_key(F.col("sample_id"), seed).alias("_key")
    )
    candidates = _lowest_candidates(keyed, train_per_class + val_per_class, ["true_label"])
    ranked = number_rows(candidates, ["true_label", "_key", "sample_id"], "_row")
    class_starts = ranked.groupBy("true_label").agg(F.min("_row").alias("_start"))
    chosen = (
        ranked.join(class_starts, "true_label")
        .withColumn("_rank", F.col("_row") - F.col("_start"))
        .filter(F.col("_rank") < train_per_class + val_per_class)
    )
    split = F.when(F.col("_rank") < train_per_class, "train").otherwise("val")
    picked = chosen.select("sample_id", split.alias("split"), "true_label", "_rank")
    numbered = number_rows(picked, ["split", "true_label", "_rank", "sample_id"], "_row")
    starts = numbered.groupBy("split").agg(F.min("_row").alias("_start"))
    return numbered.join(F.broadcast(starts), "split").select(
        "sample_id", "split", (F.col("_row") - F.col("_start") + id_offset).alias("new_id")
    )


def label_distribution(labels: DataFrame, n_classes: int = 10) -> DataFrame:
    """Count per label: the classes without samples, labels beyond them and NULL included."""
    classes = labels.sparkSession.range(n_classes).select(F.col("id").cast("int").alias("true_label"), F.lit(0).alias("n"))
    ones = labels.select(F.col("true_label").cast("int").alias("true_label"), F.lit(1).alias("n"))
    return classes.unionByName(ones).groupBy("true_label").agg(F.sum("n").alias("n"))


def _pairs(layers: Sequence[int]) -> list[tuple[int, int, int]]:
    if len(layers) < 2 or min(layers) < 1:
        raise ValueError("layers needs at least an input and an output width")
    return [(k, i, o) for k, (i, o) in enumerate(zip(layers, layers[1:]), start=1)]


def xavier_init(spark: SparkSession, layers: Sequence[int], seed: int = 42) -> DataFrame:
    """Weights uniform in ±sqrt(6 / (fan_in + fan_out)), a function of seed and position only."""

    def one(layer: int, fan_in: int, fan_out: int) -> DataFrame:
        position = spark.range(fan_in * fan_out).select(
            F.lit(layer).alias("layer"),
            ((F.col("id") - F.col("id") % fan_in) / fan_in).cast("int").alias("output_idx"),
            (F.col("id") % fan_in).cast("int").alias("input_idx"),
        )
        limit = math.sqrt(6.0 / (fan_in + fan_out))
        u = seeded_uniform(F.col("layer"), F.col("output_idx"), F.col("input_idx"), seed)
        return position.withColumn("w", (u * 2 - 1) * limit)

    return reduce(DataFrame.unionByName, (one(*p) for p in _pairs(layers)))


def zero_init(spark: SparkSession, layers: Sequence[int]) -> DataFrame:
    def one(layer: int, fan_out: int) -> DataFrame:
        return spark.range(fan_out).select(
            F.lit(layer).alias("layer"),
            F.col("id").cast("int").alias("output_idx"),
            F.lit(0.0).alias("b"),
        )

    return reduce(DataFrame.unionByName, (one(k, o) for k, _, o in _pairs(layers)))


def model_summary(params: DataFrame, biases: DataFrame) -> DataFrame:
    """Weights, biases and parameters per layer and, with layer NULL, in total."""
    weights = params.groupBy("layer").agg(F.count(F.lit(1)).alias("weights"))
    offsets = biases.groupBy("layer").agg(F.count(F.lit(1)).alias("biases"))
    per_layer = weights.join(offsets, "layer", "full_outer").na.fill(0, ["weights", "biases"])
    sums = [F.sum(c).alias(c) for c in ("weights", "biases")]
    return (
        per_layer.rollup("layer")
        .agg(*sums)
        .select("layer", "weights", "biases", (F.col("weights") + F.col("biases")).alias("parameters"))
    )
