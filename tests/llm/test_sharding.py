"""Shards against a plain sort by fractional rank."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest

from tabgrad.llm.queries import op3_sharding
from tabgrad.llm.sharding import shard_rows, write_shards

SF = "/root/testdata/sf0.01"


def plain(rows: list[tuple], n_shards: int, seed: int = 42) -> dict:
    """``(key, source)`` to ``key: (shard, slot)``."""
    by_source = defaultdict(list)
    for key, source in rows:
        by_source[source or ""].append((hashlib.md5(f"{seed}:{'null' if key is None else key}".encode()).hexdigest(), key))
    ranked = []
    for source, members in by_source.items():
        for n, (drawn, key) in enumerate(sorted(members)):
            ranked.append(((n + 0.5) / len(members), source, drawn, key))
    out, slots = {}, Counter()
    for n, (_, _, _, key) in enumerate(sorted(ranked)):
        shard = n * n_shards // len(ranked)
        out[key] = (shard, slots[shard])
        slots[shard] += 1
    return out


def test_query_matches_plain_sort(spark, table, by):
    documents = table("documents", SF)
    found = by(op3_sharding(spark, SF), "doc_id")
    expected = plain([(r["doc_id"], r["source"]) for r in documents], 24)
    assert {k: (r["shard"], r["slot"]) for k, r in found.items()} == expected
    for r in documents:
        data = r["text"].encode()
        assert found[r["doc_id"]]["size"] == len(data) + 8
        assert found[r["doc_id"]]["text_crc32"] == zlib.crc32(data)


@pytest.mark.parametrize("n_shards", [1, 7, 24, 200])
def test_counts_slots_and_mixture(spark, n_shards):
    draw = random.Random(n_shards)
    rows = [(i, draw.choice(["hot"] * 6 + ["a", "b", None])) for i in range(150)]
    df = spark.createDataFrame([(k, s, "clash", 5) for k, s in rows], "doc_id long, source string, shard string, slot int")
    found = {r.doc_id: (r.shard, r.slot) for r in shard_rows(df, "doc_id", "source", n_shards).collect()}
    assert found == plain(rows, n_shards)
    sizes = Counter(s for s, _ in found.values())
    counts = [sizes[s] for s in range(n_shards)]
    assert max(counts) - min(counts) <= 1
    of = Counter(s for _, s in rows)
    for source, n in of.items():
        for shard in range(n_shards):
            have = sum(found[k][0] == shard for k, s in rows if s == source)
            assert abs(have - sizes[shard] * n / len(rows)) < len(of) + 1


def test_repeated_rows_missing_ids_and_nulls(spark):
    rows = [(1, "a"), (1, "a"), (None, None), (None, "a"), (2, None)]
    found = shard_rows(spark.createDataFrame(rows, "doc_id long, source string"), "doc_id", "source", 2).collect()
    assert sorted((r.shard, r.slot) for r in found) == [(0, 0), (0, 1), (0, 2), (1, 0), (1, 1)]


def test_empty_table(spark):
    assert shard_rows(spark.createDataFrame([], "doc_id long, source string"), "doc_id", "source", 3).collect() == []


def test_written_shards(spark, tmp_path):
    df = shard_rows(spark.createDataFrame([(i, "x" * (i % 3)) for i in range(30)], "doc_id long, source string"), "doc_id", "source", 4)
    write_shards(df, str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert sorted(map(tuple, back.select(*df.columns).collect())) == sorted(map(tuple, df.collect()))
