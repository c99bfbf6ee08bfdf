"""Exact duplicates against grouping in plain Python."""

from __future__ import annotations

import hashlib
from collections import defaultdict

import pytest

from tabgrad.llm import exact
from tabgrad.llm.queries import op12_exact_dedup

SF = "/root/testdata/sf0.001"


def plain(rows: list[tuple]) -> dict[str, tuple]:
    """``keep_id, group_size`` by text."""
    groups = defaultdict(list)
    for key, text in rows:
        groups[text or ""].append(key)
    return {t: (max((k for k in keys if k is not None), default=None), len(keys)) for t, keys in groups.items()}


def check(df, rows: list[tuple], key: str = "doc_id") -> None:
    expected = plain(rows)
    found = sorted(((r[key], r["keep_id"], r["group_size"]) for r in df.collect()), key=repr)
    assert found == sorted(((k, *expected[t or ""]) for k, t in rows), key=repr)
    kept = sorted((r["keep_id"] for r in df.filter("kept").collect()), key=repr)
    assert kept == sorted((k for k, _ in expected.values()), key=repr)


def test_query_matches_brute_force(spark, table):
    rows = [(r["doc_id"], r["text"]) for r in table("documents", SF)]
    result = op12_exact_dedup(spark, SF)
    check(result, rows)
    digests = {k: hashlib.sha256((t or "").encode()).hexdigest() for k, t in rows}
    assert {r["doc_id"]: r["text_sha256"] for r in result.collect()} == digests


@pytest.mark.parametrize("prefix", [1, 4, 1000])
def test_edge_cases(spark, prefix):
    texts = [None, "", "a", "A", "same length x", "same length y", "same start, then one", "same start, then two", "é" * 90_000, "é" * 90_000 + "e"]
    rows = [(k, t) for k, t in enumerate(texts)] + [(100 + k, t) for k, t in enumerate(texts)]
    rows += [(None, "no id"), (None, "no id"), (None, "a"), (7, "same start, then two")]
    clashing = [(k, t, "x", "y", 1, 2) for k, t in rows]
    df = spark.createDataFrame(clashing, "doc_id long, text string, keep_id string, _full string, _row int, kept int")
    marked = exact.mark_duplicates(df, prefix=prefix)
    assert marked.columns == ["doc_id", "keep_id", "group_size", "kept"]
    check(marked, rows)


def test_full_bit_tables_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(exact, "LENGTH_BITS", 1)
    monkeypatch.setattr(exact, "PREFIX_BITS", 1)
    rows = [(k, f"{k % 40:03}" * (1 + k % 7)) for k in range(200)]
    check(exact.mark_duplicates(spark.createDataFrame(rows, "doc_id long, text string")), rows)


def test_large_group(spark):
    rows = [(k, "copy" if k % 3 == 0 else f"text {k}") for k in range(6000)]
    check(exact.mark_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(7)), rows)


def test_dropping_keeps_whole_rows(spark):
    rows = [(1, "a", 5), (2, "a", 6), (3, None, 7), (2, "a", 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept int")
    kept = exact.drop_duplicates(df)
    assert kept.columns == df.columns
    assert sorted(map(tuple, kept.collect())) == [(2, "a", 6), (3, None, 7)]


def test_empty_table_and_wrong_prefix(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert exact.mark_duplicates(empty).collect() == []
    with pytest.raises(ValueError):
        exact.mark_duplicates(empty, prefix=0)


def test_runs_no_python(spark):
    plan = op12_exact_dedup(spark, SF)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
