"""Quality classifier: hashed word n-grams, logistic regression, follow-the-regularised-leader.

Features are n-grams of words (1 and 2) and of word shapes (1 to 3), hashed into 2**18 places. A
shape says which marks and how many digits a word carries, whether it is written in capitals and
whether it repeats the word before; it makes words that were never seen comparable. A place's value
is ``log(1 + count)``, and a document's values have length 1. The score is the logistic function of
the sparse dot product with the weights.

The model is fitted on at most ``max_rows`` labelled documents, those with the smallest seeded
draws, by per-coordinate FTRL-proximal updates with an L1 term, in one task whose input that bound
limits: one text for each document of the sample, of at most 2**18 places (2 MB) however long it is. Scoring is a scan of whole texts, in pieces of about a megabyte or one text; the weights (1 MB)
are the broadcast side.

Defined results: a null or empty text has no features and scores by the bias alone. Of several
labels of a document the lowest counts; null labels are ignored. Without labels nothing speaks
against a document, and every score is 1. Repeated documents each get their own row; of the texts of
a repeated doc_id one, by a hash of the text, is learnt from. A column of the
documents named ``score`` is replaced; all others are passed on.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabgrad.llm.common import draw
from tabgrad.llm.wordhash import SPACES, find_words, mix, pieces

BITS = 18
MAX_ROWS = 4096

_CODES = np.arange(256)
_IS_WORD = ~SPACES
_UPPER = (_CODES >= 0x41) & (_CODES <= 0x5A)
_LOWER = (_CODES >= 0x61) & (_CODES <= 0x7A)
_DIGIT = (_CODES >= 0x30) & (_CODES <= 0x39)
_MARK = (_CODES < 0x80) & ~(_UPPER | _LOWER | _DIGIT | SPACES)
# Letters count nothing, digits alike, every mark by itself.
_SHAPE = np.where(_MARK, mix(np.arange(1, 257, dtype=np.uint64)), np.uint64(0))
_SHAPE[_DIGIT] = mix(np.array([1000], np.uint64))[0]


@dataclass(frozen=True)
class Ftrl:
    """Learning rate, its offset, L1 and L2 terms, passes over the sample."""

    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.002
    l2: float = 0.001
    epochs: int = 3


def _sums(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Sum of ``values`` over each word."""
    total = np.zeros(len(values) + 1, values.dtype)
    np.cumsum(values, out=total[1:])
    return total[end] - total[start]


def _ngrams(tokens: np.ndarray, doc: np.ndarray, n: int, kind: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-grams inside a document, and the documents."""
    count = max(0, len(tokens) - n + 1)
    total = np.full(count, mix(np.array([kind], np.uint64))[0])
    for j in range(n):
        total = mix(total + tokens[j : j + count])
    inside = doc[:count] == doc[len(doc) - count :]
    return total[inside], doc[:count][inside]


def featurize(texts: list[bytes | None]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """For runs of texts: first and last index, then document, place and value of each feature."""
    for first, to, data, offsets in pieces(texts):
        raw = np.frombuffer(data, np.uint8)
        words = find_words(np.where(_UPPER[raw], raw + 32, raw).astype(np.uint8), _IS_WORD)
        bounds = np.append(np.searchsorted(words.start, offsets), len(words.start))
        doc = np.repeat(np.arange(to - first), np.diff(bounds))
        capitals = _sums(_UPPER[raw].astype(np.int64), words.start, words.end)
        small = _sums(_LOWER[raw].astype(np.int64), words.start, words.end)
        shape = _sums(_SHAPE[raw], words.start, words.end)
        again = np.zeros(len(doc), np.bool_)
        again[1:] = (words.hash[1:] == words.hash[:-1]) & (doc[1:] == doc[:-1])
        written = ((capitals > 1) & (small == 0)).astype(np.uint64) + 2 * again.astype(np.uint64)
        shape = mix(shape + written)
        found = [_ngrams(words.hash, doc, n, n) for n in (1, 2)] + [_ngrams(shape, doc, n, 10 + n) for n in (1, 2, 3)]
        keys = np.concatenate([(d.astype(np.uint64) << np.uint64(BITS)) | (h >> np.uint64(64 - BITS)) for h, d in found])
        keys, count = np.unique(keys, return_counts=True)
        owner = (keys >> np.uint64(BITS)).astype(np.int64)
        value = np.log1p(count)
        norm = np.sqrt(np.bincount(owner, value * value, to - first))
        yield first, to, owner, (keys & np.uint64((1 << BITS) - 1)).astype(np.int32), value / norm[owner]


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(drawn, label, text)`` to ``(drawn, label, place, value)``."""
    for batch in batches:
        drawn, label, texts = (c.to_pylist() for c in batch.columns)
        for first, to, owner, place, value in featurize(texts):
            cut = np.searchsorted(owner, np.arange(to - first + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(drawn[first:to], pa.string()),
                    pa.array(label[first:to], pa.int32()),
                    pa.ListArray.from_arrays(cut, pa.array(place)),
                    pa.ListArray.from_arrays(cut, pa.array(value.astype(np.float32))),
                ],
                names=["drawn", "label", "place", "value"],
            )


def _train(table: pa.Table, settings: Ftrl) -> pa.Table:
    """FTRL-proximal over the examples in the order of their draws; the last place is the bias."""
    table = table.sort_by([("drawn", "ascending")])
    drawn, labels = table["drawn"].to_pylist(), table["label"].to_pylist()
    examples = [
        (np.append(p.values.to_numpy(), 1 << BITS), np.append(v.values.to_numpy(), np.float32(1)), y)
        for n, (p, v, y) in enumerate(zip(table["place"], table["value"], labels))
        if n == 0 or drawn[n] != drawn[n - 1]
    ]
    z, n, weights = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)
    for _ in range(settings.epochs):
        for place, value, y in examples:
            score = 1 / (1 + math.exp(-max(-35.0, min(35.0, float(weights[place] @ value)))))
            g = (score - y) * value
            before = n[place]
            n[place] = before + g * g
            root = np.sqrt(n[place])
            z[place] += g - (root - np.sqrt(before)) / settings.alpha * weights[place]
            kept = z[place]
            small = np.sign(kept) * settings.l1 - kept
            weights[place] = np.where(np.abs(kept) <= settings.l1, 0, small / ((settings.beta + root) / settings.alpha + settings.l2))
    return pa.table({"weights": pa.array([weights.astype("<f4").tobytes()], pa.binary())})


def in_training(key: Column) -> Column:
    """False for the held-out quarter: crc32 of the key as text leaves 2 when divided by 4."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 4 != 2


def fit(
    documents: DataFrame,
    labels: DataFrame,
    label: str,
    key: str = "doc_id",
    text: str = "text",
    max_rows: int = MAX_ROWS,
    settings: Ftrl = Ftrl(),
    seed: int = 42,
) -> np.ndarray | None:
    """Weights (2**18 and the bias), or None without labelled documents outside the held-out part."""
    known = labels.filter(F.col(label).isNotNull() & F.col(key).isNotNull() & in_training(F.col(key)))
    known = known.groupBy(key).agg(F.min(label).cast("int").alias("label"))
    sample = known.withColumn("drawn", draw(F.col(key), seed)).orderBy("drawn", key).limit(max_rows)
    texts = documents.select(key, F.col(text).cast("binary").alias("_text"))
    # The sample is at most ``max_rows`` narrow rows.
    # Of the texts of a repeated key the one with the least hash goes on: a fixed-size aggregate of at
    # most ``max_rows`` rows. Copies of that same text are left out by the task that fits the model.
    chosen = texts.join(F.broadcast(sample), key).groupBy(key, "drawn", "label").agg(F.min(F.xxhash64("_text")).alias("_hash"))
    chosen = F.broadcast(chosen.select(F.col(key).alias("_key"), "drawn", "label", "_hash"))
    rows = texts.join(chosen, (F.col(key) == F.col("_key")) & (F.xxhash64("_text") == F.col("_hash"))).select("drawn", "label", "_text")
    features = rows.mapInArrow(_features, "drawn string, label int, place array<int>, value array<float>")
    one = features.withColumn("model", F.lit(0)).groupBy("model")
    model = one.applyInArrow(lambda table: _train(table, settings), "weights binary").first()
    return None if model is None else np.frombuffer(bytes(model["weights"]), "<f4").astype(np.float64)


def _score(batches: Iterator[pa.RecordBatch], weights) -> Iterator[pa.RecordBatch]:
    w = weights.value
    for batch in batches:
        dots = np.full(batch.num_rows, w[-1])
        for first, to, owner, place, value in featurize(batch.column(batch.num_columns - 1).to_pylist()):
            dots[first:to] += np.bincount(owner, w[place] * value, to - first)
        scores = 1 / (1 + np.exp(-np.clip(dots, -35, 35)))
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(scores)], names=[*batch.schema.names[:-1], "score"])


def score(documents: DataFrame, weights: np.ndarray | None, text: str = "text", keep_text: bool = True) -> DataFrame:
    """Add ``score``, from 0 to 1."""
    others = [c for c in documents.columns if c != "score" and (keep_text or c != text)]
    if weights is None:
        return documents.select(*others, F.lit(1.0).alias("score"))
    rows = documents.select(*others, F.col(text).cast("binary").alias("_text"))
    schema = T.StructType([rows.schema[c] for c in others] + [T.StructField("score", T.DoubleType())])
    shared = documents.sparkSession.sparkContext.broadcast(weights)
    return rows.mapInArrow(partial(_score, weights=shared), schema)
