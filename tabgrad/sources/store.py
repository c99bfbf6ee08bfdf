"""Written results: scratch tables, versioned models and run history.

Spark commits a directory with ``_SUCCESS`` only when every task has finished, so a version is
visible either whole or not at all, and a table is never replaced while a plan still reads it.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tabgrad.operators.codec import collect_weights, encode_vector
from tabgrad.schema import HISTORY, conform


def workspace(spark: SparkSession) -> str:
    """Shared scratch folder: ``spark.checkpoint.dir``, or a new local one in local mode only."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    return _local_workspace(spark.sparkContext.applicationId)


@cache
def _local_workspace(application_id: str) -> str:
    return tempfile.mkdtemp(prefix=f"tabgrad-{application_id}-")


_scopes: list[list[str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path in the workspace."""
    path = f"{workspace(spark)}/tabgrad/{name}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete at the end every scratch table that was named inside; results must be written outside.

    For code on the driver that is one thread, such as the training loop.
    """
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            discard(spark, path)


def materialize(
    df: DataFrame, name: str = "table", partition_by: list[str] | None = None, path: str | None = None
) -> DataFrame:
    """Write ``df`` as Parquet under a new name and read it back.

    Cuts lineage, survives lost executors and gives Catalyst the true size of the result.
    """
    spark = df.sparkSession
    target = path or scratch_path(spark, name)
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(target)
    return spark.read.schema(df.schema).parquet(target)


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, root, root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def discard(spark: SparkSession, path: str) -> None:
    """Delete a table that ``scratch_path`` named and that nothing reads any more."""
    if not path.startswith(f"{workspace(spark)}/tabgrad/"):
        raise ValueError(f"{path} is not a scratch table")
    _, root, fs = _file_system(spark, path)
    fs.delete(root, True)


class ModelStore:
    """Numbered, immutable model versions below one folder; the highest committed one is current."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def versions(self) -> list[int]:
        jvm, root, fs = _file_system(self.spark, self.path)
        if not fs.exists(root):
            return []
        found = []
        for status in fs.listStatus(root):
            name = status.getPath().getName()
            marker = jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
            if name.startswith("version=") and fs.exists(marker):
                found.append(int(name.split("=")[1]))
        return sorted(found)

    def save(
        self, params: DataFrame, biases: DataFrame, normalizer: tuple[float, float] | None = None
    ) -> int:
        """Commit weights, biases and the inputs' ``(mean, std)`` in one write, as the next version."""
        version = (self.versions() or [-1])[-1] + 1
        rows = params.select("layer", "output_idx", "input_idx", F.col("w").alias("value")).unionByName(
            biases.select("layer", "output_idx", F.col("b").alias("value")), allowMissingColumns=True
        )
        if normalizer is not None:
            # Layer 0 is the scaling of the inputs.
            pair = self.spark.createDataFrame(
                [(0, k, float(v)) for k, v in enumerate(normalizer)], "layer int, output_idx bigint, value double"
            )
            rows = rows.unionByName(pair, allowMissingColumns=True)
        rows.write.mode("errorifexists").parquet(f"{self.path}/version={version}")
        return version

    def _rows(self, version: int | None) -> DataFrame:
        if version is None:
            known = self.versions()
            if not known:
                raise FileNotFoundError(f"no committed model version in {self.path}")
            version = known[-1]
        return self.spark.read.parquet(f"{self.path}/version={version}")

    def normalizer(self, version: int | None = None) -> tuple[float, float] | None:
        """``(mean, std)`` that the version's inputs were scaled with, if it was saved with them."""
        found = self._rows(version).filter("layer = 0").orderBy("output_idx").select("value").collect()
        return tuple(r["value"] for r in found) if found else None

    def load(self, version: int | None = None) -> tuple[DataFrame, DataFrame]:
        """Weights and biases of ``version``, by default the newest committed one."""
        rows = self._rows(version).filter("layer > 0")
        params = rows.filter("input_idx is not null").select(
            "layer", "output_idx", "input_idx", F.col("value").alias("w")
        )
        biases = rows.filter("input_idx is null").select(
            "layer", "output_idx", F.col("value").alias("b")
        )
        return params, biases

    def replace(self, update) -> int:
        """Store ``update(params, biases)`` of the current version as the next one."""
        return self.save(*update(*self.load()))


def export_params(
    params: DataFrame,
    biases: DataFrame,
    path: str,
    as_json: bool = False,
    fmt: str = "parquet",
    chunk: int | None = None,
) -> None:
    """Write one weight row per neuron and a bias table, both partitioned by layer.

    With ``chunk`` a neuron has a row per run of that many inputs, so that any number of them fits.
    """
    weights = collect_weights(params, chunk=chunk)
    if as_json:
        weights = encode_vector(
            params.select("layer", "output_idx", F.col("input_idx").alias("idx"), F.col("w").alias("value")),
            ["layer", "output_idx"],
            out="weights",
            as_json=True,
        )
    for name, table in (("weights", weights), ("biases", biases)):
        writer = table.write.mode("errorifexists").partitionBy("layer")
        if fmt == "csv":
            # A quote inside a quoted field is doubled, as other CSV readers expect.
            writer = writer.option("header", True).option("escape", '"')
        writer.format(fmt).save(f"{path.rstrip('/')}/{name}")


def append_history(rows: DataFrame, path: str, fmt: str = "csv") -> None:
    """Append metric or parity rows to a run's history folder."""
    writer = rows.write.mode("append").format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.save(path)


def read_history(spark: SparkSession, path: str, fmt: str = "csv", schema=HISTORY) -> DataFrame:
    """A history folder with its types, by column name."""
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True).option("mode", "FAILFAST")
    return conform(reader.load(path), schema)
