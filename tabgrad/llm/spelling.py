"""Spelling variants: words within one edit of each other, by a trie of letter frequencies.

A word's letters fall into ``GROUPS``; the counts of the groups, one after the other, are its path in
the trie. One inserted or deleted letter changes one count by one, one replaced letter raises one
count and lowers another, or changes none. So all near words of a word are found by a depth-first
search that may leave the word's own path once upwards (the surplus) and once downwards (the deficit);
the words in the leaves that it reaches are verified letter by letter.

The top of the trie is cut into subtrees, the unit of the shuffle. Its depth follows the words: it is
the least at which no subtree holds more than ``HELD`` of them, and all of the groups at most. A word
goes once into its own subtree and asks in every subtree that the budget reaches, each pair of
subtrees in one direction only. A subtree that is still fuller at the full depth is dealt into blocks
of about ``HELD`` words, and whoever asks there asks each block. A task holds one block at a time; those who
ask pass through it in batches and are never held. So no pair is lost and nothing grows with a subtree.

Words come from whole texts: maximal runs of ``LETTERS`` with A-Z lower-cased. ``noise`` puts spelling
slips of a known kind into them. Each document's runs are counted in the task that reads it, and the
counts are summed map-side again, so a frequent word is a few rows.

The form of a word is its near word of the largest count (ties: the least in code-point order), if
that is at least ``ratio`` times its own; the root is found by pointer jumping, each round of
which doubles the reach. Counts rise tenfold along forms, so a few rounds do.

Defined results: a null text has no words; a null doc_id counts as an empty text in the slips, and
repeated rows count each time. A text of any length is read whole. An empty table gives no row. Only
the two columns named are read, so others cannot clash.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import partial
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabgrad.sources.store import materialize

LETTERS = "[a-zÀ-ÿ]"  # after A-Z became a-z
LEAST_LENGTH = 7
LEAST_COUNT = 2
RATIO = 10
NOISE = 31
HELD = 20_000  # words of a subtree or block in a task
# Letters by how often they come in European languages, so that the first counts part words well;
# whatever is not listed falls into one more group.
GROUPS = ("e", "a", "i", "n", "r", "s", "t", "o", "l", "u", "d", "c", "m", "p", "g", "h", "b", "fv", "kqwxyz", "j")
_GROUP = {letter: n for n, letters in enumerate(GROUPS) for letter in letters}
_N = len(GROUPS) + 1
_DEPTHS = (2, 4, 6, 9, 13, _N)  # of the cut
_LEAF = 16  # words that need no further branch
_COUNTED = 1 << 18  # distinct words that a task counts before it hands them on


def _count_words(batches: Iterator[pa.RecordBatch], least: int, noise: int | None) -> Iterator[pa.RecordBatch]:
    """``(doc_id, text)`` to partial counts ``(word, n)``."""
    # A run that is too short fails at each of its letters, so what is found are whole runs.
    find, counts = re.compile(f"{LETTERS}{{{max(1, least)},}}").findall, Counter()

    def out() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])
        counts.clear()
        return batch

    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
            for run, n in Counter(find(text.as_py().lower().decode("utf-8", "replace"))).items():
                if noise and (h := zlib.crc32(run.encode(), start)) % noise == 0:
                    at = h % len(run)
                    run = run[:at] + run[at + 1 :]
                    if len(run) < least:
                        continue
                counts[run] += n
            if len(counts) >= _COUNTED:
                yield out()
    if counts:
        yield out()


def count_words(
    documents: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
    noise: int | None = None,
) -> DataFrame:
    """``(word, n)``: words of at least ``least_length`` letters that come ``least_count`` times or more.

    With ``noise``, a run whose checksum together with the document's id it divides loses a letter.
    """
    # As bytes, since lower-casing these changes A-Z alone.
    rows = documents.select(F.col(key).cast("string"), F.coalesce(F.col(text), F.lit("")).cast("binary"))
    partial_counts = rows.mapInArrow(partial(_count_words, least=least_length, noise=noise), "word string, n bigint")
    return partial_counts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


def counts_of(word: str) -> bytes:
    """The word's path: how often each group of letters comes (255 stands for more, too)."""
    counts = [0] * _N
    for letter in word:
        counts[_GROUP.get(letter, _N - 1)] += 1
    return bytes(min(c, 255) for c in counts)


def reached(path: bytes) -> set[bytes]:
    """Subtrees that a surplus and a deficit of one each lead to from ``path``, itself among them."""
    out = {path}
    for i, c in enumerate(path):
        if c < 255:
            more = path[:i] + bytes([c + 1]) + path[i + 1 :]
            out.add(more)
            out.update(more[:j] + bytes([d - 1]) + more[j + 1 :] for j, d in enumerate(path) if j != i and d)
        if c:
            out.add(path[:i] + bytes([c - 1]) + path[i + 1 :])
    return out


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        paths = pa.array([counts_of(w) for w in batch.column(0).to_pylist()], pa.binary())
        yield pa.RecordBatch.from_arrays([*batch.columns, paths], names=["word", "n", "path"])


def _asks(batches: Iterator[pa.RecordBatch], depth: int) -> Iterator[pa.RecordBatch]:
    """``(word, n, path)`` to a row for each subtree in which the word asks, those before its own left out."""
    for batch in batches:
        places, subtrees = [], []
        for i, path in enumerate(batch.column(2).to_pylist()):
            own = path[:depth]
            some = [s for s in reached(own) if s >= own]
            places.extend([i] * len(some))
            subtrees.extend(some)
        places = pa.array(places, pa.int32())
        yield pa.RecordBatch.from_arrays([*[c.take(places) for c in batch.columns], pa.array(subtrees, pa.binary())], names=["word", "n", "path", "subtree"])


def build(words: list[tuple[bytes, str, int]], depth: int = 0):
    """A trie of ``(path, word, n)``: dictionaries by the count of the next group, lists as leaves."""
    if len(words) <= _LEAF or depth == _N:
        return words
    children: dict[int, list] = {}
    for row in words:
        children.setdefault(row[0][depth], []).append(row)
    return {count: build(rows, depth + 1) for count, rows in children.items()}


def search(trie, path: bytes) -> list[tuple[bytes, str, int]]:
    """Words of the leaves within a surplus and a deficit of one, depth first."""
    found: list[tuple[bytes, str, int]] = []
    stack = [(trie, 0, True, True)]
    while stack:
        node, depth, surplus, deficit = stack.pop()
        while type(node) is dict:
            count = path[depth]
            depth += 1
            if count < 255:  # which may stand for any larger count
                if surplus and (child := node.get(count + 1)) is not None:
                    stack.append((child, depth, False, deficit))
                if deficit and (child := node.get(count - 1)) is not None:
                    stack.append((child, depth, surplus, False))
            node = node.get(count)
        if node is not None:
            found += node
    return found


def is_near(a: str, b: str) -> bool:
    """Exactly one inserted, deleted or replaced code point."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    at, end = 0, len(a)
    while at < end and a[at] == b[at]:
        at += 1
    return a[at + 1 :] == b[at + 1 :] if len(a) == len(b) else a[at:] == b[at + 1 :]


_PAIR = "word string, n bigint, near string, near_n bigint"


def _near_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (``subtree, block, asks, own, path, word, n``) in the order of the first three to verified pairs."""
    schema = pa.schema([("word", pa.string()), ("n", pa.int64()), ("near", pa.string()), ("near_n", pa.int64())])
    rows = (row for batch in batches for at in range(0, batch.num_rows, 4096) for row in zip(*[c.to_pylist() for c in batch.slice(at, 4096).columns]))
    out: list[tuple] = []
    for _, block in groupby(rows, key=itemgetter(0, 1)):
        trie = None
        for asks, members in groupby(block, key=itemgetter(2)):
            if not asks:
                trie = build([(path, word, n) for *_, path, word, n in members])
                continue
            if trie is None:  # nobody lives there
                break
            for *_, own, path, word, n in members:
                # One edit leaves the first half of a word as it is, or the last.
                half = len(word) // 2
                head, tail = word[:half], word[len(word) - half :]
                some = [r for r in search(trie, path) if r[1].startswith(head) or r[1].endswith(tail)]
                for _, other, m in some:
                    # Within a subtree each of two words asks; the lesser one is heard.
                    if (not own or word < other) and is_near(word, other):
                        out.append((word, n, other, m))
                        out.append((other, m, word, n))
                if len(out) > 1 << 15:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
                    out = []
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)


def near_pairs(words: DataFrame, held: int = HELD) -> DataFrame:
    """``(word, n, near, near_n)``: both directions of every pair of near words of a table ``(word, n)``."""
    words = materialize(words.select("word", "n").mapInArrow(_paths, "word string, n bigint, path binary"), "paths")

    # The least depth at which no subtree is too full; the driver sees one row for each depth.
    levels = F.explode(F.array(*[F.struct(F.lit(d).alias("depth"), F.substring("path", 1, d).alias("subtree")) for d in _DEPTHS]))
    sizes = words.select(levels.alias("at")).groupBy("at").agg(F.count(F.lit(1)).alias("size"))
    fullest = {r["depth"]: r["most"] for r in sizes.groupBy("at.depth").agg(F.max("size").alias("most")).collect()}
    depth = next((d for d in _DEPTHS if fullest.get(d, 0) <= held), _DEPTHS[-1])

    live = words.withColumn("subtree", F.substring("path", 1, depth)).withColumn("asks", F.lit(False))
    ask = words.mapInArrow(partial(_asks, depth=depth), "word string, n bigint, path binary, subtree binary").withColumn("asks", F.lit(True))
    if fullest.get(depth, 0) > held:
        full = live.groupBy("subtree").agg(F.ceil(F.count(F.lit(1)) / held).cast("int").alias("blocks")).filter("blocks > 1")
        full = materialize(full, "full")
        blocks = F.coalesce("blocks", F.lit(1))
        live = live.join(full, "subtree", "left").withColumn("block", F.pmod(F.xxhash64("word"), blocks).cast("int")).drop("blocks")
        ask = ask.join(full, "subtree", "left").withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1))).drop("blocks")
    else:
        live, ask = live.withColumn("block", F.lit(0)), ask.withColumn("block", F.lit(0))
    own = F.substring("path", 1, depth) == F.col("subtree")
    rows = live.unionByName(ask).select("subtree", "block", "asks", own.alias("own"), "path", "word", "n")
    dealt = rows.repartition("subtree", "block").sortWithinPartitions("subtree", "block", "asks")
    return dealt.mapInArrow(_near_pairs, _PAIR)


def _roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` of the words that have a form (``word, form``): the end of their chain."""
    heads = materialize(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = heads.select(F.col("word").alias("root"), F.col("root").alias("further"))
        joined = heads.join(further, "root", "left")
        moved = materialize(joined.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        heads = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            return heads


def spelling_variants(words: DataFrame, ratio: int = RATIO, held: int = HELD) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every row of a table of distinct ``(word, n)``."""
    words = materialize(words.select("word", "n"), "words")
    pairs = near_pairs(words, held)
    # At most a few thousand words are near one, so a group is never large.
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("word")))
    nearest = pairs.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    joined = words.join(nearest, "word", "left")
    is_form = -F.col("best.less") >= F.col("n").cast("decimal(28,0)") * ratio
    named = materialize(
        joined.select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(is_form, F.col("best.word")).alias("form"),
            F.when(is_form, -F.col("best.less")).alias("form_n"),
        ),
        "forms",
    )
    roots = _roots(named.filter("form is not null"))
    return named.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
