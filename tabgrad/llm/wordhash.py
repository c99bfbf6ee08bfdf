"""Words of many texts at once: places and 64-bit hashes, as numpy arrays.

Used inside tasks, on Arrow batches. Work goes in pieces of about a megabyte, so memory follows the
number of words, not eight times the bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np

PIECE_BYTES = 1 << 20
_LONG = 1 << 16
_BASE = np.uint64(0x9E3779B97F4A7C15)
SPACES = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])


def powers(n: int, base: np.uint64 = _BASE) -> np.ndarray:
    """``base`` to the powers 0 to n - 1, modulo 2**64."""
    out = np.ones(n, np.uint64)
    out[1:] = base
    return np.multiply.accumulate(out)


_POWERS = powers(_LONG)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit over all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words(NamedTuple):
    """Start and end of each word in the bytes, and its hash."""

    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray


def find_words(data: np.ndarray, is_word: np.ndarray) -> Words:
    """Maximal runs of the byte values that ``is_word`` (256 flags) marks. Equal words hash equally."""
    parts, at = [], 0
    while at < len(data):
        to = min(at + PIECE_BYTES, len(data))
        while to < len(data) and is_word[data[to - 1]]:
            gaps = np.flatnonzero(~is_word[data[to : to + PIECE_BYTES]])
            to = to + int(gaps[0]) + 1 if len(gaps) else min(to + PIECE_BYTES, len(data))
        parts.append(_piece(data[at:to], is_word, at))
        at = to
    if not parts:
        nothing = np.zeros(0, np.int64)
        return Words(nothing, nothing, np.zeros(0, np.uint64))
    return Words(*[np.concatenate(x) for x in zip(*parts)])


def _piece(data: np.ndarray, is_word: np.ndarray, at: int) -> Words:
    mask = np.zeros(len(data) + 2, np.bool_)
    mask[1:-1] = is_word[data]
    edges = np.flatnonzero(mask[1:] != mask[:-1])
    start, end = edges[::2], edges[1::2]
    if not len(start):
        return Words(start, end, np.zeros(0, np.uint64))
    length = end - start
    first = np.cumsum(length) - length
    place = np.arange(int(length.sum())) - np.repeat(first, length)
    value = (data[mask[1:-1]].astype(np.uint64) + np.uint64(1)) * _POWERS[place & (_LONG - 1)]
    return Words(start + at, end + at, mix(np.add.reduceat(value, first) + length.astype(np.uint64)))


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the runs of ``n`` consecutive words; fewer words give none."""
    count = max(0, len(hashes) - n + 1)
    total = np.zeros(count, np.uint64)
    for j, p in enumerate(powers(n, np.uint64(0xD6E8FEB86659FD93))):
        total += hashes[j : j + count] * p
    return mix(total)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each window of ``width`` values, by doubling."""
    have, low = 1, values
    while have < width:
        step = min(have, width - have)
        low = np.minimum(low[: max(0, len(low) - step)], low[step:])
        have += step
    return low


def pieces(texts: list[bytes | None], limit: int = PIECE_BYTES) -> Iterator[tuple[int, int, bytes, np.ndarray]]:
    """Neighbouring texts joined by line ends: first and last index, the bytes, where each starts."""
    at = 0
    while at < len(texts):
        to, size = at, 0
        while to < len(texts) and (to == at or size + len(texts[to] or b"") < limit):
            size += len(texts[to] or b"") + 1
            to += 1
        run = [t or b"" for t in texts[at:to]]
        length = np.fromiter((len(t) + 1 for t in run), np.int64, len(run))
        yield at, to, b"\n".join(run), np.cumsum(length) - length
        at = to
