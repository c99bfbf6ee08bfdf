"""How the given tables become features, labels and models.

Feature values and weights are multiples of powers of two, so that sums of products are exact and
do not depend on the order in which an engine adds them.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabgrad import Model
from tabgrad.sources import extract_labels, features_from_vectors

# Class of each order status, return flag.
STATUS_CLASSES = (("F", 0), ("O", 1), ("P", 2))
FLAG_CLASSES = (("A", 0), ("N", 1), ("R", 2))

VECTOR_LAYERS = (64, 32, 16, 10)
SMALL_LAYERS = (64, 32, 10)
ORDER_LAYERS = (4, 16, 8, 3)
DOCUMENT_LAYERS = (3, 8, 2)
BASKET_HIDDEN = 16
BASKET_TAIL = (16, 8, 3)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dyadic(value: Column, scale: int = 1024) -> Column:
    return F.floor(value * scale + 0.5) / scale


def class_of(column: Column, classes) -> Column:
    result = None
    for name, number in classes:
        result = (F if result is None else result).when(column == name, number)
    return result


# Embedding vectors: one sample per vector, one element per dimension, ten classes.


def vector_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = F.transform("embedding", lambda v: dyadic(v.cast("double")))
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("sample_id"), x.alias("x"), F.col("label").alias("true_label")
    )


def vector_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features_from_vectors(
        table(spark, sf_dir, "embeddings"), "vec_id", F.col("embedding"), dyadic
    )


def vector_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_labels(table(spark, sf_dir, "embeddings"), "vec_id", F.col("label"))


# The same vectors and network with holes: absent, NULL and misplaced elements, samples of nothing
# but misplaced elements, absent weights and biases.


def gap_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = F.col("sample_id") + F.col("idx")
    misplaced = (place % 11 == 0) | (F.col("sample_id") % 50 == 3)
    return (
        vector_features(spark, sf_dir)
        .filter((F.col("sample_id") * 7 + F.col("idx")) % 5 != 0)
        .select(
            "sample_id",
            F.when(misplaced, F.col("idx") + VECTOR_LAYERS[0]).otherwise(F.col("idx")).alias("idx"),
            F.when(place % 13 != 0, F.col("value")).alias("value"),
        )
    )


def gap_model(spark: SparkSession) -> Model:
    whole = dyadic_model(spark, VECTOR_LAYERS)
    params = whole.params.filter("(output_idx * 3 + input_idx) % 4 <> 0")
    return Model(VECTOR_LAYERS, params, whole.biases.filter("output_idx % 5 <> 1"))


# Orders: one sample per order, its lines summed up, the order status as class.


def order_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("sample_id"))
        .agg(
            F.sum("l_quantity").alias("quantity"),
            F.sum(F.floor(F.col("l_discount") * 100 + 0.5)).alias("discount"),
            F.count(F.lit(1)).alias("n_lines"),
        )
    )
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("sample_id"),
        "o_totalprice",
        class_of(F.col("o_orderstatus"), STATUS_CLASSES).alias("true_label"),
    )
    x = F.array(
        F.col("quantity") / 1024,
        F.floor(F.col("o_totalprice") + 0.5) / 1048576,
        F.col("n_lines") / 8,
        F.col("discount") / 128,
    )
    return lines.join(orders, "sample_id").select("sample_id", x.alias("x"), "true_label")


def order_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features_from_vectors(order_rows(spark, sf_dir), "sample_id", F.col("x"))


def order_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = class_of(F.col("o_orderstatus"), STATUS_CLASSES)
    return extract_labels(table(spark, sf_dir, "orders"), "o_orderkey", status)


# Lines: one sample per order line without an id of its own, the return flag as class.


def line_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = F.array(
        F.col("l_quantity") / 64,
        F.floor(F.col("l_extendedprice") + 0.5) / 131072,
        F.floor(F.col("l_discount") * 100 + 0.5) / 128,
        F.floor(F.col("l_tax") * 100 + 0.5) / 128,
    )
    label = class_of(F.col("l_returnflag"), FLAG_CLASSES)
    return table(spark, sf_dir, "lineitem").select(x.alias("x"), label.alias("true_label"))


# Documents: sizes of the whole text, the quality mark as class.


def document_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    def occurrences(character: str) -> Column:
        return F.length("text") - F.length(F.replace("text", F.lit(character), F.lit("")))

    x = F.array(F.col("n_chars") / 1024, occurrences(" ") / 1024, occurrences("\n") / 64)
    marks = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("true_label"))
    return (
        table(spark, sf_dir, "documents")
        .select("doc_id", x.alias("x"))
        .join(marks, "doc_id")
        .select(F.col("doc_id").alias("sample_id"), "x", "true_label")
    )


# Baskets: one sample per order, one input unit per part; almost every element is absent.


def basket_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("sample_id"), F.col("l_partkey").alias("idx"))
        .agg((F.sum("l_quantity") / 64).alias("value"))
    )


def basket_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First-layer weights packed by input: one row per part."""

    def weight(o: Column) -> Column:
        return ((o * 7919 + F.col("p_partkey") * 104729 + 1000003) % 257 - 128) / 128

    outputs = F.sequence(F.lit(0).cast("bigint"), F.lit(BASKET_HIDDEN - 1).cast("bigint"))
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("input_idx"), F.transform(outputs, weight).alias("ws")
    )


# Prototypes: a network whose first layer has one neuron per stored vector and whose second layer
# lets each of them vote for its label. It grows with the table.


def prototype_weights(spark: SparkSession, sf_dir: str, scale: int = 1024) -> DataFrame:
    weights = F.transform("embedding", lambda v: dyadic(v.cast("double"), scale))
    return table(spark, sf_dir, "embeddings").select(
        F.lit(1).alias("layer"), F.col("vec_id").alias("output_idx"), weights.alias("weights")
    )


def prototype_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = vector_features(spark, sf_dir)
    first = features.select(
        F.lit(1).alias("layer"),
        F.col("sample_id").alias("output_idx"),
        F.col("idx").cast("bigint").alias("input_idx"),
        F.col("value").alias("w"),
    )
    votes = vector_labels(spark, sf_dir).select(
        F.lit(2).alias("layer"),
        F.col("true_label").cast("bigint").alias("output_idx"),
        F.col("sample_id").alias("input_idx"),
        F.lit(1.0).alias("w"),
    )
    return first.unionByName(votes)


def prototype_biases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Minus half the squared norm, which makes the nearest prototype the most active one."""
    first = (
        vector_features(spark, sf_dir)
        .groupBy(F.col("sample_id").alias("output_idx"))
        .agg((F.sum(F.col("value") * F.col("value")) / -2).alias("b"))
        .select(F.lit(1).alias("layer"), "output_idx", "b")
    )
    votes = (
        vector_labels(spark, sf_dir)
        .select(F.lit(2).alias("layer"), F.col("true_label").cast("bigint").alias("output_idx"), F.lit(0.0).alias("b"))
        .distinct()
    )
    return first.unionByName(votes)


@lru_cache
def dyadic_matrices(layers: tuple[int, ...], scale: int = 128) -> tuple:
    """Fixed weights in [-1, 1] for a shape; a smaller ``scale`` gives a coarser copy."""
    pairs = []
    for layer, (fan_in, fan_out) in enumerate(zip(layers, layers[1:]), start=1):
        o, i = np.indices((fan_out, fan_in))
        w = ((layer * 1000003 + o * 7919 + i * 104729) % 257 - 128) / 128
        b = ((layer * 31 + np.arange(fan_out) * 17) % 33 - 16) / 64
        pairs.append((np.floor(w * scale + 0.5) / scale, b))
    return tuple(pairs)


def dyadic_model(spark: SparkSession, layers: tuple[int, ...], scale: int = 128) -> Model:
    return Model.from_matrices(spark, dyadic_matrices(layers, scale))
