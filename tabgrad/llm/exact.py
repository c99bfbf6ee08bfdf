"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash.

1. Rows are counted by the length of their text, in bytes.
2. Those whose length is not alone are counted by length and a hash of the first ``prefix`` bytes.
3. Those whose prefix is not alone get the SHA-256 of the whole text, and equal hashes are a group.

No text is shuffled. What a step leaves is handed to the next one as a bit table of fixed size
(``2**LENGTH_BITS`` and ``2**PREFIX_BITS`` bits, 128 KB and 2 MB), the only broadcast: a row goes on
if the bit of its hash is set. A bit that another value set by chance lets a row through that is
alone, which the next, exact step finds out; no row is ever lost, however full the table is. Counts
and groups combine map-side, so a group of any size is a few rows. Its rows meet the group by a plain
join of narrow rows, which adaptive execution splits where a group is large.

Equality is that of SHA-256 over the whole text, within equal length and prefix hash.

Defined results: null is equal to the empty text. The row with the largest ``key`` stays, one without
a key only if no row of the group has one; of rows that repeat key and text one stays. An empty table
gives no row. Texts of any length are read as one value. Columns of the documents named like a
result are replaced, those named like a helper (``_HELPERS``) left out; all others are passed on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabgrad.llm.common import text_of
from tabgrad.sources.store import materialize

PREFIX = 256
LENGTH_BITS = 20
PREFIX_BITS = 24
RESULTS = ("keep_id", "group_size", "kept")
_HELPERS = ("_text", "_key", "_row", "_full", "_many", "_more", "_place", "_bits", "_n", "_keep")


def _place(value: Column, bits: int) -> Column:
    """Where a value's bit is: 1 to ``2**bits``."""
    return F.pmod(F.xxhash64(value), F.lit(1 << bits)) + 1


def _bit_table(values: DataFrame, column: str, bits: int) -> DataFrame:
    """The bits of the values that come twice or more, in rows of 4 KB: ``_place, _bits``."""
    many = values.groupBy(column).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    places = many.select(_place(F.col(column), bits).alias("_at")).select(
        F.bitmap_bucket_number("_at").alias("_place"), F.bitmap_bit_position("_at").alias("_at")
    )
    return places.groupBy("_place").agg(F.bitmap_construct_agg("_at").alias("_bits"))


def _marked(rows: DataFrame, value: Column, table: DataFrame, bits: int, name: str) -> DataFrame:
    """``name``: whether the bit of ``value`` is set. The table is at most ``2**bits`` bits."""
    at = _place(value, bits)
    joined = rows.withColumn("_place", F.bitmap_bucket_number(at)).join(F.broadcast(table), "_place", "left")
    position = F.bitmap_bit_position(at)
    byte = F.conv(F.hex(F.substring(F.col("_bits"), (position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_set = F.getbit(byte, (position % 8).cast("int")) == 1
    return joined.withColumn(name, F.coalesce(is_set, F.lit(False))).drop("_place", "_bits")


def mark_duplicates(
    documents: DataFrame, key: str = "doc_id", text: str = "text", prefix: int = PREFIX, keep_text: bool = False
) -> DataFrame:
    """Add ``keep_id`` (key of the row that stays), ``group_size`` and ``kept`` to every document."""
    if prefix < 1:
        raise ValueError("prefix is at least 1")
    passed = [c for c in documents.columns if c not in RESULTS + _HELPERS and (keep_text or c != text)]
    whole = text_of(text).cast("binary")
    length = F.octet_length(whole).cast("bigint")
    start = F.xxhash64(length, F.substring(whole, 1, prefix))

    lengths = documents.select(length.alias("_length"))
    by_length = materialize(_bit_table(lengths, "_length", LENGTH_BITS), "lengths")
    some = _marked(documents.select(F.col(text)), length, by_length, LENGTH_BITS, "_many").filter("_many")
    by_prefix = materialize(_bit_table(some.select(start.alias("_prefix")), "_prefix", PREFIX_BITS), "prefixes")

    # Rows that share length and prefix get their full hash; each row a number that tells it apart.
    rows = documents.select(*passed, F.col(key).cast("bigint").alias("_key"), F.col(text).alias("_text"))
    here = text_of("_text").cast("binary")
    size = F.octet_length(here).cast("bigint")
    rows = _marked(rows, size, by_length, LENGTH_BITS, "_many")
    rows = _marked(rows, F.xxhash64(size, F.substring(here, 1, prefix)), by_prefix, PREFIX_BITS, "_more")
    full = F.when(F.col("_many") & F.col("_more"), F.sha2(here, 256))
    rows = rows.select(*passed, "_key", full.alias("_full"), F.monotonically_increasing_id().alias("_row"))
    rows = materialize(rows, "hashed")

    last = F.max(F.struct(F.col("_key").alias("key"), F.col("_row").alias("row"))).alias("_keep")
    groups = rows.filter("_full is not null").groupBy("_full").agg(F.count(F.lit(1)).alias("_n"), last).filter("_n > 1")
    # Rows without a full hash are alone. They stay out of the join, where they would be one key.
    lone = rows.filter("_full is null").select(
        *passed, F.col("_key").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"), F.lit(True).alias("kept")
    )
    alone = F.col("_n").isNull()
    joined = rows.filter("_full is not null").join(groups, "_full", "left").select(
        *passed,
        F.when(alone, F.col("_key")).otherwise(F.col("_keep.key")).alias("keep_id"),
        F.coalesce("_n", F.lit(1)).cast("bigint").alias("group_size"),
        (alone | (F.col("_row") == F.col("_keep.row"))).alias("kept"),
    )
    return lone.unionByName(joined)


def drop_duplicates(documents: DataFrame, key: str = "doc_id", text: str = "text", prefix: int = PREFIX) -> DataFrame:
    """The documents that stay, with all their columns; whole rows are written once and joined."""
    packed = documents.select(F.struct(*documents.columns).alias("_doc"), F.col(key).alias("doc_id"), F.col(text).alias("text"))
    return mark_duplicates(packed, prefix=prefix).filter("kept").select("_doc.*")
