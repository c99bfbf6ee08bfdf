"""Seeded pseudo-random expressions that depend only on their inputs.

``rand(seed)`` depends on the partition layout, so a retried or repartitioned job would draw other
numbers. These are plain integer arithmetic below 2**62, hence identical on every engine.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PRIME = 2147483647  # 2**31 - 1
ROUNDS = 48


def scramble(n: Column) -> Column:
    """Mix a non-negative bigint into ``0..PRIME-1``."""
    t = (n % PRIME) * 48271 % PRIME
    return (t * t % PRIME * 31337 + t * 17 + 11) % PRIME


def order_key(sample_id: Column, seed: int, epoch: int = 0) -> Column:
    """Key that puts ids in a seeded order; break its ties by id."""
    n = sample_id.cast("bigint")
    low = F.pmod(n, F.lit(PRIME).cast("bigint"))
    high = F.floor((n - low) / PRIME)
    offset = (seed * 40692 + epoch * 69621) % PRIME
    return scramble(low + F.pmod(high, F.lit(PRIME).cast("bigint")) * 16807 + offset)


def _scrambled(n: int) -> int:
    """``scramble`` of a plain integer."""
    t = n % PRIME * 48271 % PRIME
    return (t * t % PRIME * 31337 + t * 17 + 11) % PRIME


def round_keys(seed: int, epoch: int = 0) -> list[int]:
    """Keys below 2**62 of the rounds of a permutation."""
    start = [_scrambled(seed * 40692 + epoch * 69621 + 2 * r) for r in range(ROUNDS)]
    return [a * PRIME + _scrambled(a + 2 * r + 1) for r, a in enumerate(start)]


def permuted(n: Column, size: Column, seed: int, epoch: int = 0) -> Column:
    """A seeded permutation of the integers below ``size``: where it takes ``n``.

    Swap-or-not rounds: each pairs every integer with another by a reflection and swaps a pair or
    not, by one bit of a mixed value. So a position is computed from the integer alone, without a
    sort, and any ``size`` is permuted exactly.
    """

    def swap_or_not(x: Column, key: Column) -> Column:
        partner = F.pmod(key % size - x, size)
        mixed = scramble(F.greatest(x, partner) % PRIME + key % PRIME)
        return F.when(mixed % 8192 >= 4096, partner).otherwise(x)

    keys = F.array(*[F.lit(k).cast("bigint") for k in round_keys(seed, epoch)])
    return F.aggregate(keys, n.cast("bigint"), swap_or_not)


def permuted_from(position: int, size: int, seed: int, epoch: int = 0) -> int:
    """The integer that ``permuted`` takes to ``position``. A round undoes itself."""
    x = position
    for key in reversed(round_keys(seed, epoch)):
        partner = (key % size - x) % size
        if _scrambled(max(x, partner) % PRIME + key % PRIME) % 8192 >= 4096:
            x = partner
    return x


def seeded_uniform(layer: Column, output_idx: Column, input_idx: Column, seed: int) -> Column:
    """Uniform draw in [0, 1) for one weight position."""
    position = (
        output_idx.cast("bigint") * 4099
        + input_idx.cast("bigint") * 65537
        + layer.cast("bigint") * 131
        + seed * 7
    )
    return scramble(position) / F.lit(float(PRIME))
