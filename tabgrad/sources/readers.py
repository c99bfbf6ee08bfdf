"""Typed readers and projections from ordinary tables to the canonical ones."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabgrad.operators.codec import explode_weights
from tabgrad.schema import BIASES, FEATURES, LABELS, PARAMS, conform


def read_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    fmt: str = "parquet",
    rename: dict[str, str] | None = None,
) -> DataFrame:
    """Read csv / json / parquet / orc into ``schema``, by column name and with no inference pass.

    ``rename`` gives the canonical names of columns that the files call differently. CSV columns may
    stand in any order; a missing one, and text that is no value of its type, is an error.
    """
    rename = rename or {}
    if fmt == "csv":
        rows = spark.read.option("header", True).option("mode", "FAILFAST").csv(path)
    elif fmt == "json":
        given = {new: old for old, new in rename.items()}
        named = T.StructType([T.StructField(given.get(f.name, f.name), f.dataType) for f in schema])
        rows = spark.read.schema(named).option("mode", "FAILFAST").json(path)
    else:
        rows = spark.read.format(fmt).load(path)
    return conform(rows.toDF(*[rename.get(c, c) for c in rows.columns]), schema)


def read_features(spark: SparkSession, path: str, fmt: str = "parquet", rename: dict | None = None) -> DataFrame:
    return read_table(spark, path, FEATURES, fmt, rename)


def read_labels(spark: SparkSession, path: str, fmt: str = "parquet", rename: dict | None = None) -> DataFrame:
    return read_table(spark, path, LABELS, fmt, rename)


def read_params(spark: SparkSession, path: str, fmt: str = "parquet", rename: dict | None = None) -> DataFrame:
    return read_table(spark, path, PARAMS, fmt, rename)


def read_biases(spark: SparkSession, path: str, fmt: str = "parquet", rename: dict | None = None) -> DataFrame:
    return read_table(spark, path, BIASES, fmt, rename)


def read_weight_rows(spark: SparkSession, paths: Sequence[str], fmt: str = "parquet") -> DataFrame:
    """One table of weight arrays ``(output_idx, weights)`` per layer, JSON text or arrays, to weight rows."""

    def one(layer: int, path: str) -> DataFrame:
        reader = spark.read.format(fmt)
        if fmt == "csv":
            # A quote inside a quoted field is doubled.
            reader = reader.option("header", True).option("escape", '"').option("mode", "FAILFAST")
        rows = reader.load(path).select(F.lit(layer).alias("layer"), "output_idx", "weights")
        return conform(explode_weights(rows), PARAMS)

    return reduce(DataFrame.unionByName, (one(k, p) for k, p in enumerate(paths, start=1)))


def features_from_vectors(
    df: DataFrame, key: str, vector: Column, each: Callable[[Column], Column] | None = None
) -> DataFrame:
    """One array per sample to one row per element, ``each`` applied to the exploded value.

    Arithmetic after the explode stays in generated code; inside ``transform`` it is interpreted.
    """
    rows = df.select(
        F.col(key).cast("bigint").alias("sample_id"), F.posexplode(vector).alias("idx", "value")
    )
    value = F.col("value").cast("double")
    return rows.select("sample_id", "idx", (each(value) if each else value).alias("value"))


def features_from_columns(df: DataFrame, key: str, columns: Sequence[Column]) -> DataFrame:
    """Numeric columns of a wide table to one row per element, in the order given."""
    return features_from_vectors(df, key, F.array(*(c.cast("double") for c in columns)))


def extract_labels(df: DataFrame, key: str, label: Column) -> DataFrame:
    return df.select(
        F.col(key).cast("bigint").alias("sample_id"), label.cast("int").alias("true_label")
    )


def inline_values(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A small literal table, such as a class dictionary."""
    return spark.createDataFrame(list(rows), schema)
