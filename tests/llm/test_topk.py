"""Exact top-k against sorting all scores, with ties, large numbers and rows that take no part."""

from __future__ import annotations

import random

import pytest

import tabgrad.llm.topk as operator
from tabgrad.llm.topk import top_k


def plain(queries, candidates, k):
    out = {}
    for q, x in queries:
        scored = [(-sum(int(a) * int(b) for a, b in zip(x, y)), c) for c, y in candidates if c != q]
        out[q] = [(c, -s) for s, c in sorted(scored)[:k]]
    return {q: found for q, found in out.items() if found}


def run(spark, queries, candidates, k):
    schema = "vec_id long, vector array<double>, score string"
    frames = [spark.createDataFrame([(i, v, "clash") for i, v in rows], schema) for rows in (queries, candidates)]
    found = {}
    for row in top_k(*frames, k).orderBy("query_id", "rank").collect():
        listed = found.setdefault(row["query_id"], [])
        assert row["rank"] == len(listed) + 1
        listed.append((row["vec_id"], row["score"]))
    return found


def vectors(seed, n, d, size, repeat=1):
    draw = random.Random(seed)
    return [(i, [float(draw.randint(-size, size)) for _ in range(d)]) for i in range(n)] * repeat


@pytest.mark.parametrize("size", [0, 1, 3, 1000, 10**7, 10**9])
def test_matches_a_full_sort(spark, size):
    rows = vectors(size, 60, 3, size)
    assert run(spark, rows[::9], rows, 7) == plain(rows[::9], rows, 7)


def test_sums_beyond_doubles_are_exact(spark):
    rows = [(i, [float(2**31 - 1), float(i % 5), float(-(2**30))]) for i in range(40)]
    assert run(spark, rows[:3], rows, 9) == plain(rows[:3], rows, 9)


def test_many_equal_vectors(spark):
    rows = [(i, [2.0, 1.0]) for i in range(500)] + [(900, [3.0, 0.0])]
    assert run(spark, rows[:2], rows, 5) == plain(rows[:2], rows, 5)


def test_blocks_of_queries(spark, monkeypatch):
    monkeypatch.setattr(operator, "QUERY_BLOCK", 4)
    rows = vectors(5, 50, 4, 9)
    assert run(spark, rows[::3], rows, 4) == plain(rows[::3], rows, 4)


def test_lengths_may_differ(spark):
    rows = [(0, [1.0, 2.0, 3.0]), (1, []), (2, [5.0]), (3, [1.0, 1.0, 1.0, 9.0])]
    assert run(spark, rows, rows, 2) == plain(rows, rows, 2)


def test_fewer_than_k_and_repeated_candidates(spark):
    rows = [(0, [1.0]), (1, [2.0]), (1, [2.0])]
    assert run(spark, [(0, [1.0])], rows, 10) == {0: [(1, 2), (1, 2)]}


def test_repeated_ids_are_rows_of_their_own(spark):
    rows = [(0, [1.0]), (0, [1.0]), (0, [3.0]), (1, [2.0]), (2, [1.0]), (2, [1.0])]
    schema = "vec_id long, vector array<double>"
    whole = spark.createDataFrame(rows, schema)
    found = sorted(map(tuple, top_k(whole.filter("vec_id % 2 = 0"), whole, 3).collect()))
    wanted = []
    for n, (q, x) in enumerate(rows):
        if q % 2 == 0:
            scored = sorted((-int(x[0] * y[0]), c) for m, (c, y) in enumerate(rows) if m != n)[:3]
            wanted += [(q, r + 1, c, -s) for r, (s, c) in enumerate(scored)]
    assert found == sorted(wanted)


def test_rows_that_take_no_part(spark):
    values = [(0, [1.0, 0.5]), (1, None), (2, [1.0, None]), (3, [float("nan")]), (4, [float("inf")]), (5, [-0.001, 1.0]), (None, [1.0])]
    df = spark.createDataFrame(values, "vec_id long, embedding array<double>")
    whole = df.select("vec_id", operator.whole_numbers(df.embedding, 1024).alias("vector"))
    assert [tuple(r) for r in top_k(whole.filter("vec_id = 0"), whole).collect()] == [(0, 1, 5, -2 * 1024 + 1024 * 512)]


def test_empty_tables(spark):
    rows = [(0, [1.0])]
    assert run(spark, [], rows, 3) == {} and run(spark, rows, [], 3) == {} and run(spark, rows, rows, 3) == {}


def test_a_score_beyond_bigint_raises(spark):
    with pytest.raises(Exception):
        run(spark, [(0, [1e18])], [(1, [1e18])], 1)
