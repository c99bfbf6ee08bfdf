"""Repeated strings by longest-previous-factor arrays over a sampled, distributed suffix order.

A byte goes if a string of ``least`` bytes that covers it also starts elsewhere. A start is repeated
if its suffix agrees with that of another start in ``least`` bytes; in suffix order, that is a
neighbour whose common prefix is that long. The previous and the next smaller position among such
neighbours tell whether one of them is earlier: the longest previous factor has ``least`` bytes.
With ``keep="first"`` only starts with an earlier match count, with ``keep="none"`` all repeated ones.

Not every suffix is moved. Of the k-grams (k half of ``least``) that begin in the first half of the
string at a start, the one with the smallest hash is its anchor. Equal strings have equal anchors at
equal distances, so starts can only match if their anchors' k-grams are equal. One row per anchor
goes through the shuffles, for the run of starts that share it, with a hash of the anchor's k-gram
(its class) and a hash of the bytes that those starts cover (its context).

1. Classes with one anchor are dropped. Equal contexts are repeated whole, and one stands for all.
2. The different contexts of a class meet, with their bytes. They are sorted by what follows the
   anchor, which is suffix order; for each distance before the anchor, a stable sort by the byte
   there keeps suffix order while it separates what differs in front, and common prefixes come from
   range minima. All classes of a task advance together, as numpy arrays.
3. A class of more than ``GROUP`` contexts is split until its parts fit a task. A start at some
   distance before the anchor matches only if all bytes match that the distances of its range have
   in common, so each context is cut to the nearer and to the farther half of its distances, and
   those with equal common bytes form a part. Equal cuts are repeated whole, and one stands for all.
   Parts that fit are sorted as in step 2; where one distance is left, a cut is a whole string.
4. The repeated starts of each document come back to its text.

Hashes decide which rows meet and which contexts count as equal: 64 bits for the class and another
64 for the context, 128 for the cuts of step 3. What is sorted is compared byte by byte. Texts are
shuffled once, and that exchange serves steps 2 and 4. Step 3 runs before it and shuffles the texts
that hold a context of a large class, and no others but by chance: a table of ``2**OWNER_BITS`` bits
(2 MB), the only forced broadcast, sieves them in the scan, however many they are.

Defined results: a null text is empty; texts shorter than ``least`` keep all. Repeated rows are
documents of their own, so each removes the other, and with ``keep="first"`` they count as one.
Order is by ``doc_id`` (null as 0), a hash of the text, and place. An empty table gives no row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import partial, reduce
from itertools import batched, groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabgrad.llm.exact import _place
from tabgrad.llm.wordhash import mix, pieces, powers, sliding_min
from tabgrad.sources.store import materialize

LEAST = 400
GROUP = 1024
OWNER_BITS = 24
_ODD = np.uint64(0x9E3779B97F4A7C15)
_BITS = 18  # places within a segment; the arrays of a task are as long
_SEGMENT = (1 << _BITS) - 1
_POWERS = powers(1 << _BITS)
_INVERSES = powers(1 << _BITS, np.uint64(pow(int(_ODD), -1, 1 << 64)))
_TOGETHER = 1 << 14  # contexts that a task sorts at once

_CONTEXT_ARROW = pa.schema(
    [(c, pa.int64()) for c in ("part", "near", "far", "class", "context", "owner", "tie", "anchor", "before", "reach")]
    + [("bytes", pa.binary()), ("cut", pa.binary())]
)
_CONTEXT = ", ".join(f"{f.name} {'binary' if pa.types.is_binary(f.type) else 'bigint'}" for f in _CONTEXT_ARROW)
CELL = "owner bigint, tie bigint, class bigint, context bigint, anchor bigint, low bigint, high bigint"


class _Hashes:
    """Hashes of any substring of a segment, by prefix sums."""

    def __init__(self, data: np.ndarray):
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _POWERS[: len(data)], out=self.sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * _INVERSES[start]


def _segments(texts: list[bytes | None], least: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """First document, place of the segment in it, bytes, and where documents start and end in them."""
    for first, _, data, offsets in pieces(texts, _SEGMENT):
        raw = np.frombuffer(data, np.uint8)
        ends = np.append(offsets[1:] - 1, len(raw))
        if len(raw) <= _SEGMENT:
            yield first, 0, raw, offsets, ends
            continue
        for at in range(0, len(raw) - least + 1, _SEGMENT - least + 1):
            part = raw[at : at + _SEGMENT]
            yield first, at, part, np.zeros(1, np.int64), np.array([len(part)])


def _cells(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """``(owner, tie, text)`` to anchors."""
    k = least // 2
    place = np.uint64((1 << _BITS) - 1)
    for batch in (batch.slice(at, 256) for batch in batches for at in range(0, batch.num_rows, 256)):
        ids, ties = batch.column(0), batch.column(1)
        for first, at, data, starts, ends in _segments(batch.column(2).to_pylist(), least):
            if len(data) < least:
                continue
            hashes = _Hashes(data)
            n = len(data) - k + 1
            grams = mix(hashes(np.arange(n), np.arange(k, n + k)))
            lowest = sliding_min((grams & ~place) | np.arange(n, dtype=np.uint64), least - k + 1)
            anchor = (lowest & place).astype(np.int64)
            inside = np.zeros(len(anchor) + 1, np.int32)
            fits = ends - starts >= least
            np.add.at(inside, starts[fits], 1)
            np.add.at(inside, ends[fits] - least + 1, -1)
            valid = np.cumsum(inside)[:-1] > 0
            new = np.ones(len(anchor), np.bool_)
            new[1:] = (anchor[1:] != anchor[:-1]) | (valid[1:] != valid[:-1])
            low = np.flatnonzero(new)
            high = np.append(low[1:], len(anchor)) - 1
            low, high = low[valid[low]], high[valid[low]]
            if not len(low):
                continue
            a = anchor[low]
            doc = np.searchsorted(starts, low, "right") - 1
            shape = (a - low).astype(np.uint64) << np.uint64(32) | (high - low).astype(np.uint64)
            context = mix(hashes(low, high + least) ^ mix(shape))
            back = at - starts[doc]
            owner = pa.array(first + doc)
            yield pa.RecordBatch.from_arrays(
                [ids.take(owner), ties.take(owner), *[pa.array(x.view(np.int64)) for x in (grams[a], context, a + back, low + back, high + back)]],
                names=["owner", "tie", "class", "context", "anchor", "low", "high"],
            )


def _contexts(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """The chosen contexts of each text, a part for each class, with all their distances and bytes."""
    far = least - least // 2
    for batch in batches:
        for at in range(0, batch.num_rows, 64):
            part = batch.slice(at, 64)
            out = []
            columns = [part.column(c).to_pylist() for c in ("owner", "tie", "body", "chosen")]
            for owner, tie, text, chosen in zip(*columns):
                for c in chosen:
                    before, reach = c["anchor"] - c["low"], c["high"] - c["low"]
                    data = text[c["low"] : c["high"] + least]
                    out.append((c["class"], 0, far, c["class"], c["context"], owner, tie, c["anchor"], before, reach, data, b""))
            columns = list(zip(*out)) or [()] * len(_CONTEXT_ARROW)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, _CONTEXT_ARROW.types)], schema=_CONTEXT_ARROW)


def _common(rows: list[bytes], depth: int) -> np.ndarray:
    """Length of the common prefix of each string with the one before it, up to ``depth``."""
    length = np.fromiter((min(len(r), depth) for r in rows), np.int64, len(rows))
    table = np.frombuffer(b"".join(r[:depth].ljust(depth, b"\0") for r in rows), np.uint8).reshape(len(rows), depth)
    differs = np.ones((len(rows), depth + 1), np.bool_)
    differs[1:, :depth] = table[1:] != table[:-1]
    common = differs.argmax(axis=1)
    common[1:] = np.minimum(common[1:], np.minimum(length[1:], length[:-1]))
    common[0] = 0
    return common


class _RangeMin:
    """Minimum of ``values`` between any two places, by tables of powers of two."""

    def __init__(self, values: np.ndarray):
        self.tables = [values]
        while 2 << (len(self.tables) - 1) <= len(values):
            half = 1 << (len(self.tables) - 1)
            last = self.tables[-1]
            self.tables.append(np.minimum(last[:-half], last[half:]))
        self.level = np.zeros(len(values) + 1, np.int64)
        self.level[1:] = np.log2(np.arange(1, len(values) + 1) + 0.5).astype(np.int64)

    def __call__(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Over ``low`` to ``high``, both included."""
        out = np.empty(len(low), np.int64)
        level = self.level[high - low + 1]
        for n in np.unique(level):
            here, table = level == n, self.tables[n]
            out[here] = np.minimum(table[low[here]], table[high[here] - (1 << n) + 1])
        return out


def factors(group: np.ndarray, place: np.ndarray, before: np.ndarray, contexts: list[bytes], least: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Repeated starts of contexts that share an anchor's k-gram within each ``group``.

    ``before`` says how many bytes stand before the anchor, ``place`` orders the contexts. For each
    distance before the anchor: the distance, the contexts whose start there has a match, and
    whether one of the matches is at an earlier place, that is, has a smaller previous or next
    position in suffix order within the common prefix.
    """
    suffixes = [c[b:] for c, b in zip(contexts, before.tolist())]
    order = np.array(sorted(range(len(contexts)), key=list(zip(group.tolist(), suffixes)).__getitem__))
    follows = [suffixes[i] for i in order.tolist()]
    common = _common(follows, least)
    common[1:][group[order[1:]] != group[order[:-1]]] = 0
    least_between = _RangeMin(common)
    front = before[order]
    depth = int(front.max())
    left = np.frombuffer(b"".join(contexts[i][: before[i]][::-1].ljust(depth, b"\0") for i in order), np.uint8).reshape(len(order), depth)
    here, part = np.arange(len(order)), np.unique(group[order], return_inverse=True)[1]
    for distance in range(depth + 1):
        if distance:
            reach = front[here] >= distance
            here, part = here[reach], part[reach]
            key = part * 256 + left[here, distance - 1]
            sort = np.argsort(key, kind="stable")
            here, key = here[sort], key[sort]
            part = np.cumsum(np.append(0, key[1:] != key[:-1])[: len(key)])
        # Alone in its part, a context matches nothing from here on.
        size = np.bincount(part)
        shared = size[part] > 1
        here, part = here[shared], part[shared]
        if not len(here):
            return
        same = part[1:] == part[:-1]
        linked = np.zeros(len(here), np.bool_)
        at = np.flatnonzero(same) + 1
        linked[at] = least_between(here[at - 1] + 1, here[at]) >= least - distance
        block = np.cumsum(~linked)
        many = np.bincount(block)[block] > 1
        if many.any():
            some, block = here[many], block[many]
            rank = place[order[some]]
            span = np.int64(len(place) + 1)
            previous = np.minimum.accumulate(rank - block * span) + block * span
            following = np.minimum.accumulate((rank + block * span)[::-1])[::-1] - block * span
            yield distance, order[some], np.minimum(previous, following) < rank


def _runs(distances: list[int]) -> list[dict]:
    """Maximal runs of ascending distances."""
    out = []
    for d in distances:
        if out and out[-1]["to"] == d - 1:
            out[-1]["to"] = d
        else:
            out.append({"from": d, "to": d})
    return out


_RUNS = "array<struct<from:bigint,to:bigint>>"
_MATCHED = f"class bigint, context bigint, repeated {_RUNS}, later {_RUNS}"
_RUNS_ARROW = pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))


def _matched(classes: list, contexts: list, repeated: list, later: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(classes, pa.int64()), pa.array(contexts, pa.int64()), pa.array(repeated, _RUNS_ARROW), pa.array(later, _RUNS_ARROW)],
        names=["class", "context", "repeated", "later"],
    )


def _match(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Contexts sorted by part to the distances before the anchor at which they are repeated."""
    rows = (row for batch in batches for at in range(0, batch.num_rows, 1024) for row in batch.slice(at, 1024).to_pylist())
    waiting: list[dict] = []
    for _, members in groupby(rows, key=lambda r: r["part"]):
        waiting.extend(members)
        if len(waiting) >= _TOGETHER:
            yield _match_some(waiting, least)
            waiting = []
    if waiting:
        yield _match_some(waiting, least)


def _match_some(rows: list[dict], least: int) -> pa.RecordBatch:
    def position(i: int) -> tuple:
        row = rows[i]
        return row["owner"], row["tie"], row["anchor"]

    place = np.empty(len(rows), np.int64)
    place[sorted(range(len(rows)), key=position)] = np.arange(len(rows))
    group = np.array([r["part"] for r in rows], np.int64)
    before = np.array([r["before"] for r in rows], np.int64)
    repeated, later = [[] for _ in rows], [[] for _ in rows]
    for distance, members, earlier in factors(group, place, before, [r["bytes"] for r in rows], least):
        for i, is_later in zip(members.tolist(), earlier.tolist()):
            repeated[i].append(distance)
            if is_later:
                later[i].append(distance)
    return _matched([r["class"] for r in rows], [r["context"] for r in rows], list(map(_runs, repeated)), list(map(_runs, later)))


def _halves(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Contexts cut to the nearer and the farther half of their distances, ``near`` to ``far``."""
    names = [f.name for f in _CONTEXT_ARROW]
    rows = (row for batch in batches for at in range(0, batch.num_rows, 256) for row in batch.slice(at, 256).to_pylist())
    for some in batched(rows, 256):
        out = []
        for row in some:
            anchor, data = row["before"], row["bytes"]
            middle = (row["near"] + row["far"]) // 2
            for near, far in ((row["near"], middle), (middle + 1, row["far"])):
                before, nearest = min(anchor, far), max(anchor - row["reach"], near)
                if nearest > before:
                    continue
                common = hashlib.blake2b(data[anchor - near : anchor + least - far], digest_size=8, salt=b"%d-%d" % (near, far))
                common.update(row["part"].to_bytes(8, "little", signed=True))
                cut = data[anchor - before : anchor + least - nearest]
                out.append(
                    row
                    | {
                        "part": int.from_bytes(common.digest(), "little", signed=True),
                        "near": near,
                        "far": far,
                        "before": before,
                        "reach": before - nearest,
                        "bytes": cut,
                        "cut": hashlib.blake2b(cut, digest_size=16).digest(),
                    }
                )
        yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], _CONTEXT_ARROW.field(c).type) for c in names], names=names)


def _chosen_halves(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Both at once, so that a task needs one Python worker."""
    return _halves(_contexts(batches, least), least)


def _split(contexts: DataFrame, least: int, halve: Callable = _halves) -> tuple[DataFrame, DataFrame]:
    """Contexts of classes too large for a task: in parts that fit one, and what is repeated whole.

    ``halve`` makes the first cuts of the rows given.

    Each round halves the ranges of distances of the parts that are still too large, so rounds are
    the logarithm of ``least`` at most. Where many contexts share a passage, its inner ranges become
    equal cuts at once, and only the ranges that hold an end of it go on.
    """
    part = ["part", "near", "far"]
    equal = [*part, "before", "reach", "cut"]
    position = F.struct("owner", "tie", "anchor")
    run = F.array(F.struct((F.col("before") - F.col("reach")).alias("from"), F.col("before").alias("to")))
    fitting, whole = [], []
    while True:
        halves = materialize(contexts.mapInArrow(partial(halve, least=least), _CONTEXT), "halves")
        cuts = materialize(halves.groupBy(*equal).agg(F.count(F.lit(1)).alias("n"), F.min(position).alias("first")), "cuts")
        later = F.when(position != F.col("first"), run).otherwise(F.array().cast(_RUNS))
        shared = halves.join(cuts.filter("n > 1"), equal)
        whole.append(shared.select("class", "context", run.cast(_RUNS).alias("repeated"), later.alias("later")))
        open_cuts = cuts.filter("near < far")
        sizes = materialize(open_cuts.groupBy(*part).agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "parts")
        standing = halves.join(open_cuts.join(sizes, part, "left_semi").select(*equal, "first.*"), [*equal, "owner", "tie", "anchor"], "left_semi")
        fitting.append(standing.join(sizes.filter(F.col("n") <= GROUP), part, "left_semi"))
        large = sizes.filter(F.col("n") > GROUP)
        if large.isEmpty():
            return reduce(DataFrame.unionByName, fitting), reduce(DataFrame.unionByName, whole)
        contexts, halve = standing.join(large, part, "left_semi").select(*_CONTEXT_ARROW.names), _halves


def _chosen(contexts: DataFrame, classes: DataFrame) -> DataFrame:
    """``owner, tie, chosen``: for each document the contexts of ``classes`` that it stands for."""
    chosen = contexts.join(classes.select("class"), "class").select("first.*", "class", "context").groupBy("owner", "tie")
    return chosen.agg(F.collect_list(F.struct("class", "context", "anchor", "low", "high")).alias("chosen"))


def _owning(rows: DataFrame, chosen: DataFrame) -> DataFrame:
    """The documents that ``chosen`` names, and a few others whose bit is set by chance."""
    owner = F.struct("owner", "tie")
    at = chosen.select(_place(owner, OWNER_BITS).alias("_at"))
    at = at.select(F.bitmap_bucket_number("_at").alias("_place"), F.bitmap_bit_position("_at").alias("_at"))
    table = at.groupBy("_place").agg(F.bitmap_construct_agg("_at").alias("_bits"))
    # A condition of the join, so that texts are not copied together with bits.
    at = _place(owner, OWNER_BITS)
    position = F.bitmap_bit_position(at)
    byte = F.conv(F.hex(F.substring(F.col("_bits"), (position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_set = F.getbit(byte, (position % 8).cast("int")) == 1
    return rows.join(F.broadcast(table), (F.bitmap_bucket_number(at) == F.col("_place")) & is_set, "left_semi")


def _cut(batches: Iterator[pa.RecordBatch], least: int, with_text: bool) -> Iterator[pa.RecordBatch]:
    """Remove what the repeated starts cover."""
    spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        out = []
        for doc_id, text, runs in zip(batch.column("doc_id"), batch.column("body"), batch.column("runs")):
            text, spans = text.as_py(), []
            for run in sorted((r["from"], r["to"]) for r in runs.as_py() or []):
                if spans and run[0] <= spans[-1]["end"]:
                    spans[-1]["end"] = max(spans[-1]["end"], run[1] + least)
                else:
                    spans.append({"start": run[0], "end": run[1] + least})
            kept, at = [], 0
            for span in spans:
                kept.append(text[at : span["start"]])
                at = span["end"]
            kept = b"".join([*kept, text[at:]])
            out.append((doc_id.as_py(), len(text), len(text) - len(kept), spans, hashlib.sha256(kept).hexdigest(), kept if with_text else None))
        kinds = (pa.int64(), pa.int64(), pa.int64(), spans_type, pa.string(), pa.binary())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(list(zip(*out)) or [()] * 6, kinds)],
            names=["doc_id", "n_bytes", "n_removed", "spans", "kept_sha256", "kept"],
        )


def remove_repeats(
    documents: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST, keep: str = "none", with_text: bool = False
) -> DataFrame:
    """``doc_id, n_bytes, n_removed, spans, kept_sha256, kept`` of every document.

    ``keep`` is ``"none"`` or ``"first"``; ``kept`` holds the remaining bytes if ``with_text``.
    """
    if keep not in ("none", "first"):
        raise ValueError("keep is none or first")
    if least < 2:
        raise ValueError("least is at least 2")
    body = F.coalesce(F.col(text), F.lit(""))
    doc_id = F.col(key).cast("bigint")
    rows = documents.select(
        F.coalesce(doc_id, F.lit(0)).alias("owner"),
        F.xxhash64(body, doc_id.isNull()).alias("tie"),
        # Not the id itself: a bare column would be renamed on one side, and the exchange not reused.
        doc_id.isNotNull().alias("known"),
        body.cast("binary").alias("body"),
    )

    # Step 1: anchors whose class is not alone, and for each context one anchor that stands for it.
    anchors = rows.filter(F.length("body") >= least).select("owner", "tie", "body").mapInArrow(partial(_cells, least=least), CELL)
    if keep == "first":
        anchors = anchors.distinct()
    repeated = anchors.groupBy("class").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("class")
    cells = materialize(anchors.join(materialize(repeated, "classes"), "class"), "anchors")
    position = F.struct("owner", "tie", "anchor", "low", "high")
    contexts = cells.groupBy("class", "context").agg(F.count(F.lit(1)).alias("n"), F.min(position).alias("first"))
    contexts = materialize(contexts, "contexts")
    classes = contexts.groupBy("class").agg(F.count(F.lit(1)).alias("n_contexts")).filter("n_contexts > 1")
    classes = materialize(classes, "classes")

    # Step 2: the bytes of the contexts that have to be compared, cut from the texts.
    same = ["owner", "tie"]
    placed = rows.repartition(*same)
    huge = classes.filter(F.col("n_contexts") > GROUP)
    any_huge = not huge.isEmpty()
    chosen = _chosen(contexts, classes.filter(F.col("n_contexts") <= GROUP))
    meeting = placed.join(chosen, same).mapInArrow(partial(_contexts, least=least), _CONTEXT)
    if any_huge:
        # Step 3
        chosen = materialize(_chosen(contexts, huge), "owners")
        fitting, whole = _split(_owning(rows, chosen).join(chosen, same), least, _chosen_halves)
        meeting = meeting.unionByName(fitting)
    meeting = meeting.repartition("part").sortWithinPartitions("part", "context")
    matched = meeting.mapInArrow(partial(_match, least=least), _MATCHED)
    if any_huge:
        matched = matched.unionByName(whole)

    # Step 4: starts of each document. What has an equal context is repeated whole, but for the first.
    equal = cells.join(contexts.filter("n > 1").select("class", "context", "first"), ["class", "context"])
    if keep == "first":
        equal = equal.filter(position != F.col("first"))
    standing = contexts.filter("n = 1") if keep == "none" else contexts
    compared = standing.join(matched, ["class", "context"]).select(
        "first.*", F.explode("repeated" if keep == "none" else "later").alias("run")
    )
    marked = equal.select(*same, F.struct(F.col("low").alias("from"), F.col("high").alias("to")).alias("run")).union(
        compared.select(
            *same, F.struct((F.col("anchor") - F.col("run.to")).alias("from"), (F.col("anchor") - F.col("run.from")).alias("to"))
        )
    )
    runs = marked.groupBy(*same).agg(F.collect_set("run").alias("runs"))
    named = F.when(F.col("known"), F.col("owner")).alias("doc_id")
    return placed.join(runs, same, "left").select(named, "body", "runs").mapInArrow(
        partial(_cut, least=least, with_text=with_text),
        "doc_id bigint, n_bytes bigint, n_removed bigint, spans array<struct<start:bigint,end:bigint>>, kept_sha256 string, kept binary",
    )
