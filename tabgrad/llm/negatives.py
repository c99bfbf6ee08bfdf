"""Hard negatives by the threshold algorithm over per-dimension sorted lists.

A row's score is its integer inner product with the anchor. Of each anchor, the ``n_positives``
highest rows of the same label are its positives; a positive's window holds the scores from ``low`` to
``high`` percent of its own, and the ``n_negatives`` highest rows of other labels in the window are its
hard negatives.

The rows are laid out once as a table of blocks of at most ``BLOCK`` rows: their values, and for every
dimension the rows sorted by value. Against a block, an anchor reads all lists side by side, from the
high end where its own element is positive and from the low end where it is negative (lists of zeros
are not read), and scores each row when a list first names it. What no list has named yet cannot
score above the threshold, the sum of anchor times value at the places reached. The search ends when
the threshold is strictly below the k-th score of every window, or below the window itself where it
holds fewer than k; rows equal to the k-th score are thus always seen, and ties go by ``vec_id``.

Lists are read in strides that double, so a block takes a few steps of numpy for each anchor. Each
block gives at most k rows for each window and the best of all blocks are merged, first for the
positives, then for the windows that these define. Anchors pass over the table in batches of at most
``ANCHOR_BYTES``, which are the broadcast side and the only rows that reach the driver; the table is read twice for each batch.

Scores are exact: doubles where no sum can reach 2**53, else unbounded integers; a score that no
bigint holds raises an error. Defined results: rows without id or label, and vectors that are null or
hold a null or a value that is not finite, take no part. A missing element counts as 0. Rows that
repeat an id are rows of their own: each is an anchor, and each is another row to the others. Equal
scores and ids leave the result alone, since only score and id are returned. Empty tables, and anchors
without another row of their label, give no row. Only the three columns named are read, so others
cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial, reduce
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabgrad.llm.topk import padded, unbounded
from tabgrad.sources.store import materialize

BLOCK = 4096
ANCHOR_BYTES = 16 << 20
_STRIDE = 16
_EXACT = 1 << 53

_BLOCKS = "block bigint, ids binary, labels binary, kind string, vectors binary, lists binary"
_FOUND = "anchor int, window int, vec_id bigint, score bigint"


def _layout(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """``(block, vec_id, label, vector)`` in the order of ``block`` to one row per block."""
    held: list[pa.RecordBatch] = []

    def one() -> pa.RecordBatch:
        rows = pa.Table.from_batches(held).combine_chunks()
        values = padded(rows["vector"].combine_chunks(), width)
        kind = next((k for k in ("<i2", "<i4") if not values.size or np.abs(values).max() <= np.iinfo(k).max), "<f8")
        lists = np.argsort(values, axis=0, kind="stable").T.astype("<u2")
        row = {
            "block": rows["block"][0].as_py(),
            "ids": rows["vec_id"].to_numpy().astype("<i8").tobytes(),
            "labels": rows["label"].to_numpy().astype("<i8").tobytes(),
            "kind": kind,
            "vectors": values.astype(kind).tobytes(),
            "lists": np.ascontiguousarray(lists).tobytes(),
        }
        return pa.RecordBatch.from_pylist([row], schema=pa.schema([("block", pa.int64()), ("ids", pa.binary()), ("labels", pa.binary()), ("kind", pa.string()), ("vectors", pa.binary()), ("lists", pa.binary())]))

    for batch in batches:
        blocks = batch.column(0).to_numpy()
        cuts = [0, *(np.flatnonzero(blocks[1:] != blocks[:-1]) + 1).tolist(), len(blocks)]
        for a, b in zip(cuts, cuts[1:]):
            if a == b:
                continue
            if held and held[0].column(0)[0].as_py() != int(blocks[a]):
                yield one()
                held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield one()


class _Block:
    """One block in memory: ids, labels, vectors, and the lists of rows by value."""

    def __init__(self, row: dict, width: int, exact: bool):
        self.number = row["block"]
        self.ids = np.frombuffer(row["ids"], "<i8")
        self.labels = np.frombuffer(row["labels"], "<i8")
        n = len(self.ids)
        values = np.frombuffer(row["vectors"], row["kind"]).reshape(n, width).astype(np.float64)
        self.vectors = values if exact else unbounded(values)
        self.lists = np.frombuffer(row["lists"], "<u2").reshape(width, n)


class _Best:
    """The highest ``k`` rows seen in the scores from ``low`` to ``high``."""

    def __init__(self, low, high, k: int):
        self.low, self.high, self.k = low, high, k
        self.ids, self.scores = np.zeros(0, np.int64), None

    def add(self, ids: np.ndarray, scores: np.ndarray) -> None:
        inside = (scores >= self.low) & (scores <= self.high)
        if not inside.any():
            return
        ids, scores = ids[inside], scores[inside]
        if self.scores is not None:
            ids, scores = np.concatenate([self.ids, ids]), np.concatenate([self.scores, scores])
        order = np.lexsort((ids, -scores))[: self.k] if scores.dtype != object else np.array(sorted(range(len(ids)), key=lambda i: (-scores[i], ids[i]))[: self.k])
        self.ids, self.scores = ids[order], scores[order]

    def closed(self, threshold) -> bool:
        """Whether nothing that scores at most ``threshold`` can come in."""
        full = self.scores is not None and len(self.scores) == self.k
        return threshold < (self.scores[-1] if full else self.low)


def threshold_search(block: _Block, anchor: np.ndarray, own: int | None, allowed: np.ndarray, windows: list[_Best]) -> int:
    """Fill ``windows`` with rows of the block where ``allowed``; returns how many rows were scored.

    ``own`` is the anchor's place if it lives in the block.
    """
    n = len(block.ids)
    read = np.flatnonzero(anchor != 0)
    up = anchor[read] > 0
    seen = np.zeros(n, np.bool_)
    if own is not None:
        seen[own] = True
    at, stride = 0, _STRIDE
    scored = 0
    while at < n:
        to = min(n, at + stride)
        named = np.zeros(n, np.bool_)
        # Sorted access: the next places of each list, from the end that the anchor's sign asks for.
        named[block.lists[read[~up], at:to].ravel()] = True
        named[block.lists[read[up], n - to : n - at].ravel()] = True
        if not len(read):
            named[:] = True  # an anchor of zeros scores 0 with every row
            to = n
        new = np.flatnonzero(named & ~seen)
        seen[new] = True
        new = new[allowed[new]]
        scored += len(new)
        # Random access.
        scores = block.vectors[new] @ anchor
        for window in windows:
            window.add(block.ids[new], scores)
        if to == n:
            break
        last = np.where(up, n - to, to - 1)
        frontier = block.vectors[block.lists[read, last], read]
        threshold = frontier @ anchor[read]
        if all(w.closed(threshold) for w in windows):
            break
        at, stride = to, 2 * stride
    return scored


def _search(batches: Iterator[pa.RecordBatch], shared, width: int, exact: bool, k: int, same: bool) -> Iterator[pa.RecordBatch]:
    """Blocks to the best rows of each anchor's windows: of the anchor's own label if ``same``, else of others."""
    anchors = shared.value
    schema = pa.schema([("anchor", pa.int32()), ("window", pa.int32()), ("vec_id", pa.int64()), ("score", pa.int64())])
    for batch in batches:
        for at in range(batch.num_rows):
            block = _Block(batch.slice(at, 1).to_pylist()[0], width, exact)
            own_label = {label: block.labels == label for label in np.unique([a["label"] for a in anchors])}
            out: list[tuple] = []
            for n, anchor in enumerate(anchors):
                windows = [_Best(low, high, k) for low, high in anchor["windows"]]
                allowed = own_label[anchor["label"]] if same else ~own_label[anchor["label"]]
                own = anchor["place"] if anchor["block"] == block.number else None
                threshold_search(block, anchor["vector"], own, allowed, windows)
                for w, best in enumerate(windows):
                    if best.scores is not None:
                        out.extend((n, w, i, int(s)) for i, s in zip(best.ids.tolist(), best.scores))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out) if out else [[]] * 4, schema)], schema=schema)


def _merged(blocks: DataFrame, anchors: list[dict], width: int, exact: bool, k: int, same: bool) -> DataFrame:
    """The best ``k`` rows over all blocks: ``anchor, window, vec_id, score, rank``."""
    shared = blocks.sparkSession.sparkContext.broadcast(anchors)
    found = blocks.mapInArrow(partial(_search, shared=shared, width=width, exact=exact, k=k, same=same), _FOUND)
    rank = F.row_number().over(Window.partitionBy("anchor", "window").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k)


def _window(positive: int, low: int, high: int) -> tuple[int, int]:
    """The least and the highest whole score from ``low`` to ``high`` percent of a positive's."""
    return -(-low * positive // 100), high * positive // 100


def _mine(blocks: DataFrame, anchors: list[dict], width: int, exact: bool, n_positives: int, n_negatives: int, low: int, high: int) -> DataFrame | None:
    """One batch of anchors."""
    spark = blocks.sparkSession
    anything = (-(1 << 63), (1 << 63) - 1) if exact else (-(1 << 200), 1 << 200)
    asked = [a | {"windows": [anything]} for a in anchors]
    # At most ``n_positives`` rows for each anchor of the batch.
    positives = _merged(blocks, asked, width, exact, n_positives, True).orderBy("anchor", "rank").collect()
    if not positives:
        return None
    asked, rows = [], []
    for n, members in groupby(positives, key=itemgetter("anchor")):
        members = list(members)
        rows.extend((len(asked), w, anchors[n]["vec_id"], r["vec_id"], r["score"]) for w, r in enumerate(members))
        asked.append(anchors[n] | {"windows": [_window(r["score"], low, high) for r in members]})
    named = spark.createDataFrame(rows, "anchor int, window int, anchor_id bigint, positive_id bigint, positive_score bigint")
    best = _merged(blocks, asked, width, exact, n_negatives, False)
    return best.join(F.broadcast(named), ["anchor", "window"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


def hard_negatives(
    rows: DataFrame, is_anchor: str, n_positives: int = 5, n_negatives: int = 10, low: int = 30, high: int = 90, block: int = BLOCK
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``rows`` has ``vec_id``, ``label`` and ``vector``, an array of whole doubles; ``is_anchor`` is a
    condition on ``vec_id`` in SQL.
    """
    if not 1 <= block <= 1 << 16:
        raise ValueError("block is 1 to 65536 rows")
    spark = rows.sparkSession
    result = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    usable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull()
    rows = rows.filter(usable).select(F.col("vec_id").cast("bigint"), F.col("label").cast("bigint"), "vector")
    size = F.array_max(F.transform("vector", F.abs))
    total, width, largest = rows.agg(F.count(F.lit(1)), F.max(F.size("vector")), F.max(size)).first()
    if not total:
        return spark.createDataFrame([], result)
    width, largest = width or 0, int(largest or 0)
    exact = 4 * width * largest * largest < _EXACT

    # Blocks: rows have numbers of their own, are dealt by a hash of these, and cut into runs.
    rows = materialize(rows.withColumn("row", F.monotonically_increasing_id()), "rows")
    parts = -(-2 * total // block) if total > block else 1
    numbered = rows.withColumn("part", F.pmod(F.xxhash64("row"), F.lit(parts)))
    numbered = numbered.withColumn("n", F.row_number().over(Window.partitionBy("part").orderBy("row")) - 1)
    at = (F.col("part") + F.floor(F.col("n") / block) * parts).cast("bigint")
    dealt = numbered.select(at.alias("block"), "vec_id", "label", "vector", (F.col("n") % block).cast("int").alias("place"))
    laid = dealt.repartition("block").sortWithinPartitions("block", "place").drop("place")
    blocks = materialize(laid.mapInArrow(partial(_layout, width=width), _BLOCKS), "blocks")

    anchors = materialize(dealt.filter(is_anchor), "anchors")
    batch = max(1, ANCHOR_BYTES // (8 * width + 64))
    batches = -(-anchors.count() // batch)
    out = []
    for n in range(batches):
        mine = anchors.filter(F.pmod(F.xxhash64("vec_id", "block", "place"), F.lit(batches)) == n).toArrow()
        vectors = padded(mine["vector"].combine_chunks(), width) if mine.num_rows else np.zeros((0, width))
        vectors = vectors if exact else unbounded(vectors)
        some = [r | {"vector": v} for r, v in zip(mine.drop_columns(["vector"]).to_pylist(), vectors)]
        found = _mine(blocks, some, width, exact, n_positives, n_negatives, low, high) if some else None
        if found is not None:
            out.append(found if batches == 1 else materialize(found, "negatives"))
    return reduce(DataFrame.union, out) if out else spark.createDataFrame([], result)
