"""What several operators share: table paths, row digests and bounded cumulative sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

BUCKETS = 4096  # three hexadecimal digits of a draw


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(name: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(name), F.lit(""))


def draw(key: Column, seed: int | str) -> Column:
    """A seeded pseudo-random order key, as 32 hexadecimal digits; a null key draws as ``null``."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null"))))


def bucket_of(drawn: Column) -> Column:
    """The bucket of a draw, 0 to 4095. Buckets follow the order of the draws."""
    return F.conv(F.substring(drawn, 1, 3), 16, 10).cast("int")


def before(total: str, *partition: str, order: str) -> Column:
    """Sum of ``total`` over the earlier rows of a table that is already aggregated by bucket."""
    window = Window.partitionBy(*partition).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(total).over(window), F.lit(0).cast("bigint"))
