"""SimHash near-duplicates: meet-in-the-middle ball hashing.

Two fingerprints that differ in 1 to 3 bits have a common variant at most 2 flips from one and 1
from the other. So every fingerprint emits the variants within half the radius, the shuffle brings
equal variants together, and those who meet are linked. Parity halves the work: fingerprints with an
odd and an even number of ones are 1 or 3 apart, and there the even one emits its 2,016 variants of
two flips and the odd one its 64 of one flip; fingerprints of equal parity are 2 apart, and both emit
their variants of one flip.

What meets needs no pairs. All that reach a variant by one flip are within 2 of each other, and those
who reach it by two are within 3 of each of them: linking all to the least of the former is exact,
and gives one link per row. Fingerprints are deduplicated first, so at most 2,080 meet at a variant,
whatever the number of copies.

Only fingerprints that can have a partner emit. Cut into six pieces, fingerprints within 3 bits agree
in three of the pieces; a fingerprint that shares none of its 20 choices of three pieces with another
one has no partner. This loses nothing, and keeps the variants in proportion to the near-copies.

Defined results: null counts as empty, and texts without a word have fingerprint zero. Repeated rows
are near-copies of each other like others. ``component_id`` is the least doc_id of the component,
null only if no document of it has an id. An empty table gives no row. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tabgrad.llm.graph import components
from tabgrad.plans.numbering import shuffle_partitions
from tabgrad.sources.store import materialize

SHINGLE = 3
SEED = 42
RADIUS = 3
EMITTING = 2048  # fingerprints whose variants one task emits
_CHUNK = 1 << 15
_PIECES = 6


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash of a text: words at ASCII white space, A-Z lower-cased."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    length = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(length + 1) - 1
    start = end - length
    width = min(shingle, len(words))
    spans = list(zip(start[: len(words) - width + 1].tolist(), end[width - 1 :].tolist()))
    ones = np.zeros(64, np.int64)
    for at in range(0, len(spans), _CHUNK):
        some = spans[at : at + _CHUNK]
        hashes = np.fromiter((xxhash.xxh64_intdigest(joined[s:e], SEED) for s, e in some), np.uint64, len(some))
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(spans), bitorder="little").view(np.uint64)[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(batch.num_columns - 1).to_pylist()
        prints = np.fromiter((fingerprint(t or b"") for t in texts), np.uint64, len(texts)).view(np.int64)
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(prints)], names=[*batch.schema.names[:-1], "fp"])


def fingerprints(documents: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """``keys`` (as bigint) and ``fp``, the fingerprint as a signed long, of every document."""
    rows = documents.select(*[F.col(k).cast("bigint").alias(k) for k in keys], F.col(text).cast("binary").alias("_text"))
    return rows.mapInArrow(_fingerprints, ", ".join([*[f"{k} bigint" for k in keys], "fp bigint"]))


def _choices() -> list[int]:
    """Masks of every choice of three pieces, as signed longs."""
    cuts = [round(64 * i / _PIECES) for i in range(_PIECES + 1)]
    masks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts, cuts[1:])]
    picked = [sum(masks[i] for i in c) for c in combinations(range(_PIECES), _PIECES - RADIUS)]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in picked]


def _with_possible_partner(distinct: DataFrame) -> DataFrame:
    """The fingerprints that agree with another one in three of six pieces."""
    shared = F.array(
        *[F.struct(F.lit(n).alias("choice"), F.col("fp").bitwiseAND(F.lit(m)).alias("bits")) for n, m in enumerate(_choices())]
    )
    keys = distinct.select("fp", F.explode(shared).alias("k")).select("fp", "k.choice", "k.bits")
    ends = keys.groupBy("choice", "bits").agg(F.min("fp").alias("low"), F.max("fp").alias("high"))
    return keys.join(ends.filter("low <> high"), ["choice", "bits"], "left_semi").select("fp").distinct()


def _flips(fp: Column, masks: list[int]) -> Column:
    return F.transform(F.array(*[F.lit(m) for m in masks]), lambda m: fp.bitwiseXOR(m))


def links(distinct: DataFrame) -> DataFrame:
    """``(a, b)``: links between distinct fingerprints (``fp``) that connect all pairs within 3 bits."""
    ones = [(1 << i) - (1 << 64 if i == 63 else 0) for i in range(64)]
    twos = [x ^ y for x, y in combinations(ones, 2)]
    # A row becomes up to 2,080, so tasks follow the rows and not the files that hold them.
    distinct = distinct.repartition(max(shuffle_partitions(distinct), -(-distinct.count() // EMITTING)), "fp")
    odd = F.bit_count("fp") % 2 == 1
    fp = F.col("fp")
    near = distinct.select("fp", F.lit(True).alias("one"), F.explode(_flips(fp, ones)).alias("variant"))
    far = distinct.filter(~odd).select("fp", F.lit(False).alias("one"), F.explode(_flips(fp, twos)).alias("variant"))
    # At most 64 + 2,016 distinct fingerprints have a variant in common.
    centre = F.min(F.when(F.col("one"), F.col("fp"))).over(Window.partitionBy("variant"))
    return (
        near.union(far)
        .withColumn("centre", centre)
        .filter("centre <> fp")
        .select(F.least("fp", "centre").alias("a"), F.greatest("fp", "centre").alias("b"))
        .distinct()
    )


def _components(prints: DataFrame) -> DataFrame:
    """``(fp, component)`` of every distinct fingerprint of a written table."""
    distinct = prints.select("fp").distinct()
    emitting = materialize(_with_possible_partner(distinct), "emitting")
    grouped = components(links(emitting)).withColumnRenamed("node", "fp")
    return distinct.join(grouped, "fp", "left").select("fp", F.coalesce("component", "fp").alias("component"))


def near_duplicates(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``key, fingerprint`` (16 hexadecimal digits), ``component_id``."""
    prints = materialize(fingerprints(documents, [key], text), "fingerprints")
    named = _components(prints)
    firsts = prints.groupBy("fp").agg(F.min(key).alias("first"))
    least = firsts.join(named, "fp").groupBy("component").agg(F.min("first").alias("component_id"))
    by_print = materialize(named.join(least, "component").select("fp", "component_id"), "groups")
    shown = F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint")
    return prints.join(by_print, "fp").select(key, shown, "component_id")


def keep_one(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents, all columns, without all but one of each component of ``near_duplicates``.

    The least ``key`` stays (one without a key only if none has one), ties by a hash of the row.
    """
    columns = documents.columns
    row = F.struct(*[F.col(c) for c in columns])
    rows = documents.select(row.alias("_row"), F.col(key).cast("bigint").alias("_key"), F.xxhash64(*columns).alias("_tie"))
    texts = rows.select("_key", "_tie", F.col(f"_row.{text}").alias("_text"))
    prints = materialize(fingerprints(texts, ["_key", "_tie"], "_text"), "fingerprints")
    order = F.struct(F.col("_key").isNull().alias("missing"), F.col("_key").alias("key"), F.col("_tie").alias("tie"))
    first = prints.groupBy("fp").agg(F.min(order).alias("first")).join(_components(prints), "fp")
    stays = first.groupBy("component").agg(F.min("first").alias("first")).select(
        F.col("first.tie").alias("_tie"), F.coalesce("first.key", F.lit(0)).alias("_id")
    )
    placed = rows.select("_row", "_tie", F.coalesce("_key", F.lit(0)).alias("_id"))
    # Of rows that are equal throughout one stays.
    nth = F.row_number().over(Window.partitionBy("_tie", "_id").orderBy(F.lit(0)))
    return placed.join(stays, ["_tie", "_id"]).withColumn("_nth", nth).filter("_nth = 1").select("_row.*")
