"""Conversion between one row per element and one vector per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabgrad.functions.arrays import densify
from tabgrad.schema import known_elements


def _as_array(df: DataFrame, vector: str) -> Column:
    if isinstance(df.schema[vector].dataType, T.StringType):
        return F.from_json(F.col(vector), "array<double>")
    return F.col(vector)


def decode_vector(df: DataFrame, keys: Sequence[str], vector: str) -> DataFrame:
    """JSON text or array per key to ``(keys, idx, value)``; malformed text gives no rows."""
    return df.select(*keys, F.posexplode(_as_array(df, vector)).alias("idx", "value"))


def malformed_vectors(df: DataFrame, keys: Sequence[str], vector: str) -> DataFrame:
    """Keys whose vector text does not parse, which ``decode_vector`` would silently lose."""
    parsed = _as_array(df, vector)
    return df.filter(F.col(vector).isNotNull() & (parsed.isNull() | (F.size(parsed) == 0))).select(*keys)


def encode_vector(
    df: DataFrame,
    keys: Sequence[str],
    size: int | None = None,
    as_json: bool = False,
    out: str = "vector",
) -> DataFrame:
    """``(keys, idx, value)`` to one vector per key, ordered by idx.

    With ``size`` gaps are filled with 0.0 by index; without it elements keep their relative order.
    A key's elements form one array, so keys must identify vectors of bounded length.
    """
    entries = F.collect_list(F.struct(F.col("idx"), F.col("value")))
    grouped = df.groupBy(*keys).agg(entries.alias("_entries"))
    if size is None:
        vector = F.transform(F.sort_array("_entries"), lambda e: e["value"])
    else:
        vector = densify(F.col("_entries"), size)
    return grouped.select(*keys, (F.to_json(vector) if as_json else vector).alias(out))


def sum_repeats(features: DataFrame) -> DataFrame:
    """Add up repeated (sample_id, idx) rows, map-side first."""
    return features.groupBy("sample_id", "idx").agg(F.sum("value").alias("value"))


def pixels_to_array(
    features: DataFrame, size: int, as_json: bool = False, unique: bool = False
) -> DataFrame:
    """Feature rows to one vector per sample, gaps filled by index.

    Repeated elements are summed before a vector is gathered, so that no group outgrows ``size``;
    ``unique`` says that there are none and saves the shuffle.
    """
    known = known_elements(features, size)
    rows = known if unique else sum_repeats(known)
    return encode_vector(rows, ["sample_id"], size, as_json, out="x")


def explode_weights(weights: DataFrame, vector: str = "weights") -> DataFrame:
    """One weight row per neuron to one row per weight."""
    keys = [c for c in weights.columns if c != vector]
    return decode_vector(weights, keys, vector).withColumnsRenamed(
        {"idx": "input_idx", "value": "w"}
    )


def collect_weights(params: DataFrame, size: int | None = None, chunk: int | None = None) -> DataFrame:
    """One row per weight to one weight array per neuron, ordered by input index.

    For neurons whose number of inputs has no bound give ``chunk``: a row then holds the inputs of
    one run of that many positions, as ``(keys, chunk, inputs, weights)``, and no array outgrows it.
    """
    keys = [c for c in params.columns if c not in ("input_idx", "w")]
    if chunk is not None:
        position = F.expr(f"input_idx div {chunk}").cast("bigint").alias("chunk")
        entries = F.sort_array(F.collect_list(F.struct("input_idx", "w")))
        grouped = params.groupBy(*keys, position).agg(entries.alias("_entries"))
        return grouped.select(
            *keys, "chunk", F.col("_entries.input_idx").alias("inputs"), F.col("_entries.w").alias("weights")
        )
    elements = params.withColumnsRenamed({"input_idx": "idx", "w": "value"})
    return encode_vector(elements, keys, size, out="weights")
