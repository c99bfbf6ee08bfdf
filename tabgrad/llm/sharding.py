"""Sharding by proportional stratified interleaving.

The rows of each source get ranks in a seeded order. Sorting all rows by their fractional rank
``(rank - 1/2) / rows of the source`` interleaves the sources in proportion at every place, so any
run of that order has the mixture of the whole, and shards are runs that differ by one row at most.

No source and no shard is ever one window. Draws are hashes, so 4,096 buckets of them are even for a
source of any size: rows are ranked within ``(source, bucket)``, and the rows of earlier buckets are
added. The same is done with buckets of the fractional rank.

Defined results: null counts as the empty source. Rows with equal keys are ordered by a hash of the
row, and rows that are equal throughout are interchangeable. An empty table gives no row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabgrad.llm.common import BUCKETS, before, bucket_of, draw
from tabgrad.sources.store import materialize


def shard_rows(rows: DataFrame, key: str, stratum: str, n_shards: int, seed: int = 42) -> DataFrame:
    """Add ``shard`` (0 to ``n_shards - 1``) and ``slot``, gapless from 0 within a shard.

    Input columns named like these two are replaced. Pass the columns that are needed: all of them
    move through two shuffles, and once through a table in the shared folder.
    """
    columns = [c for c in rows.columns if c not in ("shard", "slot")]
    base = rows.select(
        F.struct(*columns).alias("_row"),
        F.coalesce(F.col(stratum).cast("string"), F.lit("")).alias("_stratum"),
        draw(F.col(key), seed).alias("_draw"),
        F.xxhash64(*columns).alias("_tie"),
    ).withColumn("_bucket", bucket_of(F.col("_draw")))

    counts = base.groupBy("_stratum", "_bucket").agg(F.count(F.lit(1)).alias("_rows"))
    starts = counts.select(
        "_stratum",
        "_bucket",
        before("_rows", "_stratum", order="_bucket").alias("_start"),
        F.sum("_rows").over(Window.partitionBy("_stratum")).alias("_of"),
    )
    within = Window.partitionBy("_stratum", "_bucket").orderBy("_draw", "_tie")
    rank = F.col("_start") + F.row_number().over(within)
    ranked = (
        base.join(starts, ["_stratum", "_bucket"])
        .withColumn("_share", (rank - F.lit(0.5)) / F.col("_of"))
        .withColumn("_place", F.floor(F.col("_share") * BUCKETS).cast("int"))
        .select("_row", "_stratum", "_draw", "_tie", "_share", "_place")
    )
    ranked = materialize(ranked, "ranked")

    # One row for each of at most 4,096 places.
    places = ranked.groupBy("_place").agg(F.count(F.lit(1)).alias("_rows"))
    offsets = places.select(
        "_place",
        before("_rows", order="_place").alias("_before"),
        F.sum("_rows").over(Window.partitionBy()).alias("_all"),
    )
    at = Window.partitionBy("_place").orderBy("_share", "_stratum", "_draw", "_tie")
    position = (F.col("_before") + F.row_number().over(at) - 1).alias("_position")
    return (
        ranked.join(F.broadcast(offsets), "_place")
        .select("_row.*", position, "_all")
        .withColumn("shard", F.expr(f"_position * {n_shards} div _all").cast("int"))
        .withColumn("slot", F.expr(f"_position - (shard * _all + {n_shards - 1}) div {n_shards}"))
        .drop("_position", "_all")
    )


def write_shards(sharded: DataFrame, path: str) -> None:
    """Write one folder per shard; its files are runs of slots, as many as the size asks for."""
    laid = sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    laid.write.partitionBy("shard").parquet(path)
