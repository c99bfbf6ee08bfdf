"""Exact top-k search by distributed histogram selection.

Every query is scored against every candidate, in blocks of queries, by matrix products inside the
tasks that read the candidates. Each pass counts the scores of a query in ``BINS`` bins of its
current range; the sums over all tasks show the bin that holds the k-th highest score, and that bin
is the range of the next pass. When bins are one wide, the k-th score is known exactly. A last pass
keeps what lies above it and, of those equal to it, the smallest ids that are still needed.

A task sends, per query, the bins that hold its own k highest scores, and at the end at most k rows
above and k rows at the threshold. So nothing that moves grows with the number of equal scores, and
scores are never stored. A block of queries is bounded by ``QUERY_BLOCK`` vectors, which are the
broadcast side.

Scores are whole numbers. They are computed in doubles where no sum can reach 2**53, else with
unbounded integers; a score that no bigint holds raises an error. Defined results: vectors that are
null, or hold a null or a value that is not finite, take no part, nor do rows without an id. A
missing element counts as 0. A query is a row of the candidates and does not meet itself: one more
than k rows are found, and the first with the query's id and its score with itself goes. Rows that
repeat an id are rows of their own, as candidates and as queries, whose results then stand side by
side under one id. Empty tables give no row. Only the two columns named are read, so others cannot
clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabgrad.sources.store import materialize

BINS = 4096
QUERY_BLOCK = 1024
_AT_ONCE = 1 << 20  # scores held at once by a task
_EXACT = 1 << 53


def whole_numbers(vector: Column, scale: int) -> Column:
    """``floor(scale * x)`` of each element as whole doubles; null if an element is null or not finite."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    scaled = F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("double"))
    return F.when(F.coalesce(good, F.lit(False)), scaled)


def padded(vectors: pa.Array, width: int) -> np.ndarray:
    """Rows padded with 0, or cut, to ``width``: what lies beyond meets zeros only."""
    length = np.diff(vectors.offsets.to_numpy())
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    if len(length) and (length == length[0]).all():
        full = flat.reshape(len(length), length[0])[:, :width]
        return np.pad(full, ((0, 0), (0, width - full.shape[1])))
    out = np.zeros((len(length), width))
    row = np.repeat(np.arange(len(length)), length)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(length) - length, length)
    inside = place < width
    out[row[inside], place[inside]] = flat[inside]
    return out


def unbounded(matrix: np.ndarray) -> np.ndarray:
    """The whole doubles of a matrix as Python's unbounded integers."""
    return np.array([[int(x) for x in row] for row in matrix], object).reshape(matrix.shape)


def _scores(batches: Iterator[pa.RecordBatch], ids: np.ndarray, queries: np.ndarray) -> Iterator[tuple]:
    """Scores of some candidates: their ids, and a matrix with a row per query."""
    step = max(1, _AT_ONCE // max(1, len(ids)))
    for batch in batches:
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            own = part.column(0).to_numpy(zero_copy_only=False)
            vectors = padded(pa.concat_arrays([part.column(1)]), queries.shape[1])
            if queries.dtype == object:
                vectors = unbounded(vectors)
            scores = queries @ vectors.T if queries.shape[1] else np.zeros((len(ids), len(own)), queries.dtype)
            yield own, scores


def _histograms(batches, block, low: np.ndarray, high: np.ndarray, width: np.ndarray, need: np.ndarray) -> Iterator[pa.RecordBatch]:
    ids, queries = block.value
    counts = np.zeros((len(ids), BINS), np.int64)
    for _, scores in _scores(batches, ids, queries):
        query, column = np.nonzero((scores >= low[:, None]) & (scores < high[:, None]))
        bins = ((scores[query, column] - low[query]) // width[query]).astype(np.int64)
        counts += np.bincount(query * BINS + bins, minlength=len(ids) * BINS).reshape(len(ids), BINS)
    # Bins below those that already hold enough cannot hold the k-th score.
    higher = np.cumsum(counts[:, ::-1], axis=1)[:, ::-1] - counts
    query, bins = np.nonzero((counts > 0) & (higher < need[:, None]))
    yield pa.RecordBatch.from_arrays(
        [pa.array(query, pa.int32()), pa.array(bins, pa.int32()), pa.array(counts[query, bins], pa.int64())],
        names=["query", "bin", "n"],
    )


def _selected(batches, block, threshold: np.ndarray, need: np.ndarray) -> Iterator[pa.RecordBatch]:
    ids, queries = block.value
    ties = [np.zeros(0, np.int64) for _ in ids]
    kinds = (pa.int64(), pa.int64(), pa.int64())
    names = ["query", "vec_id", "score"]
    for own, scores in _scores(batches, ids, queries):
        query, column = np.nonzero(scores > threshold[:, None])
        found = [int(s) for s in scores[query, column]]
        yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip((query, own[column], found), kinds)], names=names)
        equal = scores == threshold[:, None]
        for q in np.flatnonzero(equal.any(axis=1)):
            ties[q] = np.sort(np.concatenate([ties[q], own[equal[q]]]))[: need[q]]
    for q, tied in enumerate(ties):
        if len(tied):
            columns = (np.full(len(tied), q), tied, [int(threshold[q])] * len(tied))
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds)], names=names)


def _search_block(queries: pa.Table, candidates: DataFrame, largest: int, k: int) -> DataFrame:
    spark = candidates.sparkSession
    queries = queries.sort_by([("vec_id", "ascending")])
    ids = queries["vec_id"].to_numpy()
    vectors = queries["vector"].combine_chunks()
    matrix = padded(vectors, int(np.diff(vectors.offsets.to_numpy()).max()))
    reach = [int(r) * largest + 1 for r in np.abs(matrix).astype(object).sum(axis=1)] if matrix.size else [1] * len(ids)
    kind = np.float64 if 4 * max(reach) + BINS < _EXACT else object
    if kind is object:
        matrix = unbounded(matrix)
    block = spark.sparkContext.broadcast((ids, matrix))

    with_itself = [int(s) for s in (matrix * matrix).sum(axis=1)] if matrix.size else [0] * len(ids)
    low, high = [-r for r in reach], [r + 1 for r in reach]
    need = np.full(len(ids), k + 1)
    while max(h - x for x, h in zip(low, high)) > 1:
        width = [-(-(h - x) // BINS) for x, h in zip(low, high)]
        bounds = {"low": np.array(low, kind), "high": np.array(high, kind), "width": np.array(width, kind)}
        counted = partial(_histograms, block=block, need=need.copy(), **bounds)
        bins = candidates.mapInArrow(counted, "query int, bin int, n bigint").groupBy("query", "bin").agg(F.sum("n").alias("n"))
        above = F.sum("n").over(Window.partitionBy("query").orderBy(F.desc("bin"))) - F.col("n")
        asked = F.get(F.lit(need.tolist()), F.col("query"))
        # One row per query: the lowest bin with fewer scores above it than are needed.
        hit = bins.withColumn("above", above).filter(F.col("above") < asked)
        for row in hit.groupBy("query").agg(F.min(F.struct("bin", "above")).alias("hit")).select("query", "hit.*").collect():
            q = row["query"]
            low[q] += row["bin"] * width[q]
            high[q] = min(high[q], low[q] + width[q])
            need[q] -= row["above"]
        if not any(w > 1 for w in width):
            break
    rows = candidates.mapInArrow(
        partial(_selected, block=block, threshold=np.array(low, kind), need=need),
        "query bigint, vec_id bigint, score bigint",
    )
    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    ranked = rows.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k + 1)
    at = F.col("query").cast("int")
    ranked = ranked.withColumn("query_id", F.get(F.lit(ids.tolist()), at))
    itself = (F.col("vec_id") == F.col("query_id")) & (F.col("score") == F.get(F.lit(with_itself), at))
    # At most k + 1 rows a query.
    own = F.min(F.when(itself, F.col("rank"))).over(Window.partitionBy("query"))
    left = ranked.withColumn("own", own).filter(F.col("own").isNull() | (F.col("rank") != F.col("own")))
    after = F.when(F.col("rank") > F.col("own"), 1).otherwise(0)
    left = left.withColumn("rank", (F.col("rank") - after).cast("int")).filter(F.col("rank") <= k)
    return left.select("query_id", "rank", "vec_id", "score")


def top_k(queries: DataFrame, candidates: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` highest inner products per query, ties to the smaller id: ``query_id, rank, vec_id, score``.

    Both sides have ``vec_id`` and ``vector``, an array of whole doubles; ``queries`` are rows of
    ``candidates``.
    """
    spark = candidates.sparkSession
    usable = F.col("vec_id").isNotNull() & F.col("vector").isNotNull()
    candidates = candidates.filter(usable).select(F.col("vec_id").cast("bigint").alias("vec_id"), "vector")
    queries = queries.filter(usable).select(F.col("vec_id").cast("bigint").alias("vec_id"), "vector")
    size = F.array_max(F.transform("vector", F.abs))
    largest = int(candidates.agg(F.max(size)).first()[0] or 0)
    # Written once, with numbers that tell repeated rows apart, so that every block is of its size.
    queries = materialize(queries.withColumn("row", F.monotonically_increasing_id()), "queries")
    n_blocks = -(-queries.count() // QUERY_BLOCK)
    blocks = []
    for n in range(n_blocks):
        mine = queries.filter(F.pmod(F.xxhash64("row"), F.lit(n_blocks)) == n)
        some = mine.select("vec_id", "vector").toArrow()
        if some.num_rows:
            found = _search_block(some, candidates, largest, k)
            blocks.append(found if n_blocks == 1 else materialize(found, "top_k"))
    if not blocks:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    return reduce(DataFrame.union, blocks)
