"""A fully-connected network held as two tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabgrad.operators.codec import collect_weights
from tabgrad.operators.prep import xavier_init, zero_init
from tabgrad.schema import BIASES, PARAMS, conform, key_violations, require_valid

DENSE_BYTES = 256 << 20


@dataclass(frozen=True)
class Model:
    """``layers`` are the widths from input to output; hidden layers use ReLU, the last is raw.

    In every plan an absent weight or bias is 0.0, and repeated rows of a position add up.

    ``dense`` is the same model in memory, when it was built from there.
    """

    layers: tuple[int, ...]
    params: DataFrame
    biases: DataFrame
    dense: tuple | None = field(default=None, repr=False, compare=False)

    @classmethod
    def from_layers(cls, spark: SparkSession, layers: Sequence[int], seed: int = 42) -> Model:
        """Xavier-uniform weights and zero biases."""
        return cls(tuple(layers), xavier_init(spark, layers, seed), zero_init(spark, layers))

    @classmethod
    def from_matrices(
        cls, spark: SparkSession, matrices: Sequence[tuple[np.ndarray, np.ndarray]]
    ) -> Model:
        """Tables from in-memory ``(W[out, in], b[out])`` pairs."""
        widths = [matrices[0][0].shape[1], *(w.shape[0] for w, _ in matrices)]
        weight_columns, bias_columns = [], []
        for layer, (w, b) in enumerate(matrices, start=1):
            out, into = np.indices(w.shape)
            weight_columns.append((np.full(w.size, layer), out.ravel(), into.ravel(), w.ravel()))
            bias_columns.append((np.full(b.size, layer), np.arange(b.size), b))
        int_names = ("layer", "output_idx", "input_idx")

        def table(parts, value_name, n_ints):
            columns = [np.concatenate(c) for c in zip(*parts)]
            arrays = [pa.array(c.astype(np.int32)) for c in columns[:n_ints]]
            arrays.append(pa.array(columns[n_ints].astype(np.float64)))
            return pa.table(arrays, names=[*int_names[:n_ints], value_name])

        return cls(
            tuple(widths),
            spark.createDataFrame(table(weight_columns, "w", 3)),
            spark.createDataFrame(table(bias_columns, "b", 2)),
            tuple(matrices),
        )

    @property
    def n_layers(self) -> int:
        return len(self.layers) - 1

    @property
    def n_classes(self) -> int:
        return self.layers[-1]

    @property
    def n_params(self) -> int:
        return sum(i * o + o for i, o in zip(self.layers, self.layers[1:]))

    @property
    def n_bytes(self) -> int:
        return 8 * self.n_params

    def fits_in_task(self, limit: int | None = None) -> bool:
        """Whether every task may hold the whole model: at most DENSE_BYTES, if no limit is given."""
        return self.n_bytes <= (DENSE_BYTES if limit is None else limit)

    def layer_params(self, layer: int) -> DataFrame:
        return self.params.filter(F.col("layer") == layer).drop("layer")

    def layer_biases(self, layer: int) -> DataFrame:
        return self.biases.filter(F.col("layer") == layer).drop("layer")

    def validate(self) -> Model:
        """Reject repeated positions, and neurons that a missing bias would drop from a join."""
        require_valid(key_violations(self.params, ["layer", "output_idx", "input_idx"]), "weights")
        require_valid(key_violations(self.biases, ["layer", "output_idx"]), "biases")
        neurons = self.params.select("layer", "output_idx").distinct()
        require_valid(
            neurons.join(self.biases, ["layer", "output_idx"], "left_anti"), "neurons without a bias"
        )
        return self

    def dense_layers(self) -> DataFrame:
        """One row, one column: ``array<struct<layer, units array<struct<o, w, b>>, relu>>``."""
        self._require_dense()
        units = reduce(DataFrame.unionByName, (self._units(k) for k in range(1, self.n_layers + 1)))
        by_layer = units.groupBy("layer").agg(
            F.sort_array(
                F.collect_list(F.struct("output_idx", F.col("weights").alias("w"), "b"))
            ).alias("units")
        )
        relu = F.col("layer") < self.n_layers
        return by_layer.agg(
            F.sort_array(F.collect_list(F.struct("layer", "units", relu.alias("relu")))).alias("layers")
        )

    def _units(self, layer: int) -> DataFrame:
        """``(layer, output_idx, weights, b)`` of every neuron; what is absent is 0.0 at its own place."""
        fan_in, fan_out = self.layers[layer - 1], self.layers[layer]
        neurons = self.params.sparkSession.range(fan_out).select(F.col("id").cast("int").alias("output_idx"))
        weights = collect_weights(self.layer_params(layer), fan_in)
        offsets = self.layer_biases(layer).groupBy("output_idx").agg(F.sum("b").alias("b"))
        joined = neurons.join(weights, "output_idx", "left").join(offsets, "output_idx", "left")
        return joined.select(
            F.lit(layer).alias("layer"),
            "output_idx",
            F.coalesce("weights", F.array_repeat(F.lit(0.0), fan_in)).alias("weights"),
            F.coalesce("b", F.lit(0.0)).alias("b"),
        )

    def matrices(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """The model as numpy pairs on the driver; only for models within DENSE_BYTES."""
        self._require_dense()
        if self.dense is not None:
            return list(self.dense)
        result = [
            (np.zeros((o, i)), np.zeros(o)) for i, o in zip(self.layers, self.layers[1:])
        ]
        # Summed before they are fetched, so that no more rows come than there are positions.
        w = conform(self.params, PARAMS).groupBy("layer", "output_idx", "input_idx").agg(F.sum("w").alias("w"))
        b = conform(self.biases, BIASES).groupBy("layer", "output_idx").agg(F.sum("b").alias("b"))
        place = [(k, i, o) for k, (i, o) in enumerate(zip(self.layers, self.layers[1:]), start=1)]
        outside = F.lit(True)
        for layer, fan_in, fan_out in place:
            here = (F.col("layer") == layer) & F.col("output_idx").between(0, fan_out - 1)
            outside = outside & ~F.coalesce(here & F.col("input_idx").between(0, fan_in - 1), F.lit(False))
        require_valid(w.filter(outside).select("layer", "output_idx", "input_idx"), "positions of weights")
        w, b = w.toArrow(), b.toArrow()
        w_layer, w_out, w_in, w_value = (c.to_numpy() for c in w.columns)
        b_layer, b_out, b_value = (c.to_numpy() for c in b.columns)
        for layer, (weights, bias) in enumerate(result, start=1):
            mine = w_layer == layer
            weights[w_out[mine], w_in[mine]] = w_value[mine]
            mine = b_layer == layer
            bias[b_out[mine]] = b_value[mine]
        return result

    def _require_dense(self) -> None:
        if not self.fits_in_task():
            raise ValueError(
                f"{self.n_params} parameters exceed the {DENSE_BYTES} byte limit of dense plans; "
                "use the relational or sparse strategy"
            )
