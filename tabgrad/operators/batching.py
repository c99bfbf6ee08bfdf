"""Mini-batch membership, order and storage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabgrad.functions.seeded import order_key, permuted
from tabgrad.plans.numbering import number_rows, write_slices
from tabgrad.sources.store import discard, scratch_path


def assign_batches(
    samples: DataFrame, batch_size: int, seed: int | None = None, epoch: int = 0
) -> DataFrame:
    """``(sample_id, batch_num)``: consecutive ids, or a seeded order that changes with ``epoch``."""
    if batch_size < 1:
        raise ValueError("batch_size must be positive")
    ids = samples.select("sample_id").distinct()
    if seed is None:
        numbered = number_rows(ids, ["sample_id"], "_row")
    else:
        keyed = ids.withColumn("_key", order_key(F.col("sample_id"), seed, epoch))
        numbered = number_rows(keyed, ["_key", "sample_id"], "_row")
    return numbered.select(
        "sample_id", F.expr(f"_row div {int(batch_size)}").cast("bigint").alias("batch_num")
    )


def shuffle_samples(samples: DataFrame, batch_size: int, seed: int, epoch: int) -> DataFrame:
    """New batch membership for one epoch."""
    return assign_batches(samples, batch_size, seed, epoch)


def select_batch(batches: DataFrame, batch_num: int) -> DataFrame:
    return batches.filter(F.col("batch_num") == batch_num).select("sample_id")


def select_rows(samples: DataFrame, start: int, end: int) -> DataFrame:
    """Samples at positions ``start <= row < end`` in id order."""
    numbered = number_rows(samples.select("sample_id").distinct(), ["sample_id"], "_row")
    inside = (F.col("_row") >= start) & (F.col("_row") < end)
    return numbered.filter(inside).select("sample_id")


def batch_features(rows: DataFrame, batch: DataFrame) -> DataFrame:
    """Feature or label rows of the batch's samples."""
    return rows.join(batch.select("sample_id"), "sample_id", "left_semi")


def batch_plan(samples: DataFrame, batch_size: int) -> DataFrame:
    """One row ``(n_samples, n_batches, last_batch_size)``."""
    counted = samples.agg(F.countDistinct("sample_id").alias("n_samples"))
    n = F.col("n_samples")
    n_batches = F.ceil(n / batch_size).cast("bigint")
    return counted.select(
        "n_samples", n_batches.alias("n_batches"), (n - (n_batches - 1) * batch_size).alias("last_batch_size")
    )


def shuffle_batches(batches: DataFrame, seed: int, epoch: int = 0) -> DataFrame:
    """``(position, batch_num)``: the batches in a seeded order, membership unchanged.

    The position of a batch is a permutation of its rank, computed row by row.
    """
    ranked = number_rows(batches.select("batch_num").distinct(), ["batch_num"], "_rank")
    sized = ranked.withColumn("_size", ranked.agg(F.count(F.lit(1))).scalar())
    return sized.select(permuted(F.col("_rank"), F.col("_size"), seed, epoch).alias("position"), "batch_num")


class BatchTable:
    """Training rows written in batch order, so that a batch is a range of rows.

    One shuffle and one write lay the rows out, however many batches there are. Only the start of
    each slice is kept on the driver. Reading a batch opens the folders of the slices it touches,
    and the sorted ``place`` column lets Parquet skip the rest of a file. A batch larger than a
    slice is read by several tasks.
    """

    def __init__(self, rows: DataFrame, batch_size: int, seed: int | None = None, epoch: int = 0):
        if batch_size < 1:
            raise ValueError("batch_size must be positive")
        self.batch_size = batch_size
        self.path = scratch_path(rows.sparkSession, "batches")
        order = ["sample_id"]
        if seed is not None:
            order = [order_key(F.col("sample_id"), seed, epoch), "sample_id"]
        self.table, starts = write_slices(rows, order, self.path)
        self.starts = sorted((r["slice"], r["start"], r["size"]) for r in starts.collect())
        self.n_rows = sum(size for _, _, size in self.starts)
        self.n_batches = -(-self.n_rows // batch_size)

    def read(self, batch_num: int) -> DataFrame:
        """Rows ``batch_num * batch_size`` up to the next batch."""
        low = batch_num * self.batch_size
        high = min(low + self.batch_size, self.n_rows)
        touched = [(s, b, n) for s, b, n in self.starts if b < high and b + n > low]
        if not touched:
            return self.table.filter(F.lit(False))
        place, slice_ = F.col("place"), F.col("slice")
        (first, first_start, _), (last, last_start, _) = touched[0], touched[-1]
        if first == last:
            inside = (slice_ == first) & (place >= low - first_start) & (place < high - first_start)
        else:
            inside = (
                slice_.between(first, last)
                & ((slice_ > first) | (place >= low - first_start))
                & ((slice_ < last) | (place < high - last_start))
            )
        return self.table.filter(inside).drop("slice", "place")

    def discard(self) -> None:
        discard(self.table.sparkSession, self.path)
