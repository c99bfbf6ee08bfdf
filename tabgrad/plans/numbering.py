"""Consecutive row numbers without a single-partition window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabgrad.sources.store import materialize

SLICE_BYTES = 256 << 20
MOST_SLICES = 1 << 17
_SLICE_ROW_BITS = 33  # low bits of monotonically_increasing_id hold the row's place in its partition


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def estimated_bytes(plan) -> int:
    """The optimizer's estimate for a logical plan, but for joins the sum of their sides.

    Without statistics of columns its own estimate of a join is the product of the sides.
    """
    size = int(str(plan.stats().sizeInBytes()))
    children = plan.children()
    sides = [children.apply(k) for k in range(children.size())]
    given = sum(int(str(side.stats().sizeInBytes())) for side in sides)
    if not given:
        return size
    followed = sum(estimated_bytes(side) for side in sides)
    return followed * (size if len(sides) == 1 else min(size, given)) // given


def slice_count(df: DataFrame, target_bytes: int | None = None) -> int:
    """Slices of about ``target_bytes`` by ``estimated_bytes``, one per shuffle partition at least."""
    size = estimated_bytes(df._jdf.queryExecution().optimizedPlan())
    wanted = -(-size // (SLICE_BYTES if target_bytes is None else target_bytes))
    return max(shuffle_partitions(df), min(wanted, MOST_SLICES))


def write_slices(
    df: DataFrame, keys: list[str | Column], path: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Write ``df`` in the order of ``keys`` as numbered slices, one folder each.

    Returns the slices, with ``slice`` and the row's 0-based ``place`` in it, and one row
    ``(slice, start, size)`` per slice. Rows are range-partitioned on all keys, so a popular leading
    key is spread over many slices. They are written once: range bounds come from a sample and must
    not be drawn again between counting the slices and using their places.
    """
    order = [F.col(k) if isinstance(k, str) else k for k in keys]
    placed = (
        df.repartitionByRange(slice_count(df), *order)
        .withColumn("slice", F.spark_partition_id())
        .sortWithinPartitions("slice", *order)
        .withColumn(
            "place", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _SLICE_ROW_BITS) - 1))
        )
    )
    slices = materialize(placed, "slices", ["slice"], path)
    # One row per slice, so this window is bounded by the partition count.
    before = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    sizes = slices.groupBy("slice").agg(F.count(F.lit(1)).alias("size"))
    start = F.coalesce(F.sum("size").over(before), F.lit(0))
    return slices, sizes.select("slice", start.alias("start"), "size")


def number_rows(df: DataFrame, keys: list[str | Column], out: str = "row_num") -> DataFrame:
    """Add the 0-based position of each row in the order of ``keys``, which should be unique."""
    slices, starts = write_slices(df, keys)
    return slices.join(F.broadcast(starts), "slice").select(
        *df.columns, (F.col("start") + F.col("place")).alias(out)
    )
