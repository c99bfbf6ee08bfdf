"""Benchmark decontamination by winnowing.

Texts become words; a window is ``span`` consecutive words of an item, or all words of a shorter
item. Of each window the smallest hash among its k-grams is its fingerprint, so two equal windows
have equal fingerprints: every shared span of that length is found. Windows of the documents are
joined to those of the benchmark by fingerprint, the hits are compared word by word, and each hit
extends over all words of its window.

A benchmark of at most ``BLOCK`` distinct windows is broadcast, and the documents are not shuffled.
A larger one is joined by shuffle: a table of 2**``SIEVE_BITS`` flags, whatever the size of the
benchmark, is broadcast and sieves the documents' fingerprints; the runs of words that pass, and no
others, meet the windows with equal words, and hits come back to the documents by the digest of their
text. Texts are read twice then and never written.

Defined results: a null or empty text has no words. An empty benchmark hits nothing. An item without
an id marks words but is not listed. Repeated documents each get their own row. Texts of any length are
taken whole, in pieces of about a megabyte. Columns of the
documents named like a result are replaced; all others are passed on.
"""

from __future__ import annotations

import pickle
from collections import defaultdict
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabgrad.llm.wordhash import find_words, grams, pieces, sliding_min
from tabgrad.sources.store import materialize

SPAN = 10
BLOCK = 1 << 17
SIEVE_BITS = 27  # 16 MiB of flags
_FILTER_BITS = 20

# [^\x00-\x2F\x3A-\x60\x7B-\x7F], after A-Z became a-z
_CODES = np.arange(256)
IS_WORD = ((_CODES >= 0x30) & (_CODES <= 0x39)) | ((_CODES >= 0x61) & (_CODES <= 0x7A)) | (_CODES >= 0x80)

RESULTS = ("n_words", "hits", "items")
_HITS = T.ArrayType(T.StructType([T.StructField("first", T.LongType()), T.StructField("n", T.LongType())]))
_ITEMS = T.ArrayType(T.LongType())


def _fingerprints(hashes: np.ndarray, length: int) -> np.ndarray:
    """The fingerprint of each run of ``length`` words: its smallest k-gram, k half the length."""
    k = (length + 1) // 2
    return sliding_min(grams(hashes, k), length - k + 1)


def _windows(batches: Iterator[pa.RecordBatch], span: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = defaultdict(list)
        for item, text in zip(*[c.to_pylist() for c in batch.columns]):
            data = (text or b"").lower()
            found = find_words(np.frombuffer(data, np.uint8), IS_WORD)
            words = [data[s:e] for s, e in zip(found.start, found.end)]
            length = min(span, len(words))
            for i, low in enumerate(_fingerprints(found.hash, length).tolist() if length else []):
                out["fingerprint"].append(np.uint64(low).astype(np.int64))
                out["length"].append(length)
                out["window"].append(b" ".join(words[i : i + length]))
                out["item_id"].append(item)
        yield pa.RecordBatch.from_arrays(
            [pa.array(out[k], t) for k, t in (("fingerprint", pa.int64()), ("length", pa.int32()), ("window", pa.binary()), ("item_id", pa.int64()))],
            names=["fingerprint", "length", "window", "item_id"],
        )


def benchmark_windows(benchmark: DataFrame, span: int = SPAN) -> DataFrame:
    """Distinct ``(fingerprint, length, window, item_id)`` of the items."""
    items = benchmark.select(F.col("item_id").cast("bigint"), F.col("text").cast("binary"))
    schema = "fingerprint bigint, length int, window binary, item_id bigint"
    return items.mapInArrow(partial(_windows, span=span), schema).distinct()


class _Index:
    """One block of windows: sorted fingerprints by length behind a bit table, and the windows' items."""

    def __init__(self, rows: list[tuple]):
        self.items: dict[bytes, list[int]] = defaultdict(list)
        lows = defaultdict(set)
        for low, length, window, item in rows:
            lows[length].add(low)
            if item is not None:
                self.items[window].append(item)
            else:
                self.items[window]
        self.by_length = {}
        for length, values in lows.items():
            known = np.sort(np.array(list(values), np.int64).view(np.uint64))
            table = np.zeros(1 << _FILTER_BITS, np.bool_)
            table[known >> np.uint64(64 - _FILTER_BITS)] = True
            self.by_length[length] = known, table

    def candidates(self, hashes: np.ndarray) -> Iterator[tuple[int, int]]:
        """Where a run of words has a fingerprint of this block: first word, number of words."""
        for length, (known, table) in self.by_length.items():
            low = _fingerprints(hashes, length)
            maybe = np.flatnonzero(table[low >> np.uint64(64 - _FILTER_BITS)])
            at = np.minimum(np.searchsorted(known, low[maybe]), len(known) - 1)
            for i in maybe[known[at] == low[maybe]].tolist():
                yield i, length


def _sieve(windows: DataFrame) -> bytes:
    """One flag for each value of a fingerprint's first ``SIEVE_BITS`` bits, in words of 64."""
    low = F.shiftrightunsigned("fingerprint", 64 - SIEVE_BITS)
    flag = F.expr("shiftleft(1L, cast(low & 63 as int))")
    words = windows.select(low.alias("low")).select(F.shiftright("low", 6).alias("at"), flag.alias("flag"))
    table = np.zeros(1 << (SIEVE_BITS - 6), np.int64)
    # At most one row for each word of the table.
    rows = words.groupBy("at").agg(F.bit_or("flag").alias("flags")).toArrow()
    table[rows["at"].to_numpy()] = rows["flags"].to_numpy()
    return table.tobytes()


def _sift(batches: Iterator[pa.RecordBatch], sieve, lengths: list[int], bits: int) -> Iterator[pa.RecordBatch]:
    """``(blob, text)`` to the runs of words whose fingerprint passes the sieve."""
    table = np.frombuffer(sieve.value, np.uint64)
    names, kinds = ["blob", "first", "n", "window"], [pa.binary(), pa.int64(), pa.int64(), pa.binary()]
    for batch in batches:
        texts = [None if t is None else t.lower() for t in batch.column(1).to_pylist()]
        for start, _, data, offsets in pieces(texts):
            words = find_words(np.frombuffer(data, np.uint8), IS_WORD)
            bounds = np.append(np.searchsorted(words.start, offsets), len(words.start))
            for length in lengths:
                low = _fingerprints(words.hash, length) >> np.uint64(64 - bits)
                at = np.flatnonzero(table[low >> np.uint64(6)] >> (low & np.uint64(63)) & np.uint64(1))
                doc = np.searchsorted(bounds, at, "right") - 1
                inside = at + length <= bounds[doc + 1]
                at, doc = at[inside], doc[inside]
                for some in range(0, len(at), 4096):
                    here, mine = at[some : some + 4096], doc[some : some + 4096]
                    runs = [b" ".join(data[words.start[j] : words.end[j]] for j in range(i, i + length)) for i in here.tolist()]
                    columns = [batch.column(0).take(pa.array(mine + start)), here - bounds[mine], np.full(len(here), length), runs]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def _count_words(batches: Iterator[pa.RecordBatch], text_at: int, keep: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts = []
        for _, _, data, offsets in pieces(batch.column(text_at).to_pylist()):
            words = find_words(np.frombuffer(data.lower(), np.uint8), IS_WORD)
            counts.extend(np.diff(np.append(np.searchsorted(words.start, offsets), len(words.start))).tolist())
        columns = [pa.array(counts, pa.int64()) if c == "n_words" else batch.column(c) for c in keep]
        yield pa.RecordBatch.from_arrays(columns, names=keep)


def _join_hits(marked: DataFrame, windows: DataFrame, keep: list[str]) -> DataFrame:
    """What ``_match`` gives, by a shuffle of the runs that pass the sieve."""
    spark = marked.sparkSession
    sieve = spark.sparkContext.broadcast(_sieve(windows))
    lengths = sorted(r["length"] for r in windows.select("length").distinct().collect())  # 1 to ``span``
    blob = F.unhex(F.sha2(F.coalesce("_text", F.lit(b"")), 256)).alias("_blob")
    runs = marked.filter(F.length("_text") > 0).select(blob, "_text")
    runs = runs.mapInArrow(
        partial(_sift, sieve=sieve, lengths=lengths, bits=SIEVE_BITS), "_blob binary, first bigint, n bigint, window binary"
    )
    known = windows.groupBy(F.col("length").cast("bigint").alias("n"), "window").agg(F.collect_set("item_id").alias("ids"))
    # Written, so that adaptive execution can split the joins at a window or a text of many documents.
    met = materialize(runs.join(materialize(known, "known"), ["n", "window"]).drop("window"), "met")
    hits = met.groupBy("_blob").agg(F.collect_set(F.struct("first", "n")).alias("_hits"))
    items = met.select("_blob", F.explode("ids").alias("item")).distinct()
    items = items.groupBy("_blob").agg(F.sort_array(F.collect_set("item")).alias("_items"))
    found = materialize(hits.join(items, "_blob", "left"), "hits")
    counted = marked.select(blob, *marked.columns)
    schema = T.StructType([counted.schema[c] for c in ["_blob", *keep]])
    counted = counted.mapInArrow(partial(_count_words, text_at=counted.columns.index("_text"), keep=["_blob", *keep]), schema)
    return counted.join(found, "_blob", "left").select(
        *[F.coalesce(f"_{c}", c).alias(c) if c in ("hits", "items") else F.col(f"`{c}`") for c in keep]
    )


def _match(batches: Iterator[pa.RecordBatch], block, text_at: int, keep: list[str]) -> Iterator[pa.RecordBatch]:
    index = _Index(pickle.loads(block.value))
    for batch in batches:
        texts = [None if t is None else t.lower() for t in batch.column(text_at).to_pylist()]
        counts, hits, items = [], [[] for _ in texts], [set() for _ in texts]
        for first, to, data, offsets in pieces(texts):
            words = find_words(np.frombuffer(data, np.uint8), IS_WORD)
            bounds = np.append(np.searchsorted(words.start, offsets), len(words.start))
            counts.extend(np.diff(bounds).tolist())
            for at, length in index.candidates(words.hash):
                doc = int(np.searchsorted(bounds, at, "right")) - 1
                if at + length > bounds[doc + 1]:
                    continue
                window = b" ".join(data[words.start[i] : words.end[i]] for i in range(at, at + length))
                found = index.items.get(window)
                if found is not None:
                    hits[first + doc].append({"first": at - int(bounds[doc]), "n": length})
                    items[first + doc].update(found)
        named = {
            "n_words": pa.array(counts, pa.int64()),
            "hits": pa.array(
                [a + b for a, b in zip(batch.column("hits").to_pylist(), hits)],
                pa.list_(pa.struct([("first", pa.int64()), ("n", pa.int64())])),
            ),
            "items": pa.array([sorted({*a, *b}) for a, b in zip(batch.column("items").to_pylist(), items)], pa.list_(pa.int64())),
        }
        yield pa.RecordBatch.from_arrays([named[c] if c in named else batch.column(c) for c in keep], names=keep)


def mark_contamination(
    documents: DataFrame, benchmark: DataFrame, text: str = "text", span: int = SPAN, keep_text: bool = True
) -> DataFrame:
    """Add ``n_words``, ``hits`` (first word and length of each window found), ``items`` and ``n_hit``."""
    spark = documents.sparkSession
    windows = materialize(benchmark_windows(benchmark, span), "windows")
    others = [c for c in documents.columns if c not in (*RESULTS, "n_hit")]
    marked = documents.select(
        *others,
        F.lit(0).cast("bigint").alias("n_words"),
        F.array().cast(_HITS).alias("hits"),
        F.array().cast(_ITEMS).alias("items"),
        F.col(text).cast("binary").alias("_text"),
    )
    if not keep_text:
        marked = marked.drop(text)
    text_at = marked.columns.index("_text")
    keep = [c for c in marked.columns if c != "_text"]
    if windows.count() <= BLOCK:
        rows = [tuple(r.values()) for r in windows.toArrow().to_pylist()]
        block = spark.sparkContext.broadcast(pickle.dumps(rows))
        schema = T.StructType([marked.schema[c] for c in keep])
        marked = marked.mapInArrow(partial(_match, block=block, text_at=text_at, keep=keep), schema)
    else:
        marked = _join_hits(marked, windows, keep)
    ends = F.aggregate(
        F.array_sort("hits"),
        F.struct(F.lit(0).cast("bigint").alias("end"), F.lit(0).cast("bigint").alias("n")),
        lambda seen, hit: F.struct(
            F.greatest(seen.end, hit.first + hit.n).alias("end"),
            (seen.n + F.greatest(F.lit(0), hit.first + hit.n - F.greatest(seen.end, hit.first))).alias("n"),
        ),
        lambda seen: seen.n,
    )
    return marked.withColumn("n_hit", ends)
