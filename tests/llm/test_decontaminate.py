"""Contaminated words against a scan for every window."""

from __future__ import annotations

import hashlib
import re

import pytest

import tabgrad.llm.decontaminate as operator
from tabgrad.llm.queries import op10_benchmark_decontamination

SF = "/root/testdata/sf0.01"
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text: str | None) -> list[str]:
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain(documents: dict, benchmark: list[tuple]) -> dict:
    windows: dict[tuple, set] = {}
    for item, text in benchmark:
        w = words(text)
        n = min(10, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add(item)
    lengths = {len(w) for w in windows}
    out = {}
    for key, text in documents.items():
        w = words(text)
        hit, items = set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                if (found := windows.get(tuple(w[i : i + n]))) is not None:
                    hit.update(range(i, i + n))
                    items |= found - {None}
        out[key] = {"n_words": len(w), "n_hit": len(hit), "items": sorted(items)}
    return out


def test_query_matches_brute_force(spark, table, by):
    documents = {r["doc_id"]: r["text"] for r in table("documents", SF)}
    expected = plain(documents, [(r["item_id"], r["text"]) for r in table("benchmark", SF)])
    found = by(op10_benchmark_decontamination(spark, SF), "doc_id")
    assert found.keys() == expected.keys()
    assert sum(r["n_hit"] > 0 for r in expected.values()) > 5
    for key, e in expected.items():
        listed = ",".join(sorted(map(str, e["items"])))
        assert found[key] == {
            "doc_id": key,
            "n_words": e["n_words"],
            "n_hit": e["n_hit"],
            "n_items": len(e["items"]),
            "items_sha256": hashlib.sha256(listed.encode()).hexdigest(),
            "contaminated": e["n_hit"] > 0,
        }


CASES = {
    1: None,
    2: "",
    3: "alpha beta gamma",
    4: "x Alpha, beta. GAMMA y",
    5: "one two three four five six seven eight nine ten",
    6: "zero one two three four five six seven eight nine ten eleven one two",
    7: "one two three four five six seven eight nine",
    8: "ÉTÉ été",
    9: "word " * 300_000 + "one two three four five six seven eight nine ten",
    10: "twelve",
}
BENCHMARK = [
    (1, "alpha BETA gamma"),
    (2, "one two three four five six seven eight nine ten eleven"),
    (3, "one two three four five six seven eight nine ten"),
    (4, None),
    (5, "..."),
    (6, "Été"),
    (None, "twelve"),
]


def marked(spark, by, cases=CASES, benchmark=BENCHMARK):
    documents = spark.createDataFrame([(k, t, "clash", k) for k, t in cases.items()], "doc_id long, text string, hits string, extra long")
    df = operator.mark_contamination(documents, spark.createDataFrame(benchmark, "item_id long, text string"))
    assert df.columns == ["doc_id", "text", "extra", "n_words", "hits", "items", "n_hit"]
    found = by(df, "doc_id")
    assert {k: r["text"] for k, r in found.items()} == cases
    return {k: {c: r[c] for c in ("n_words", "n_hit", "items")} for k, r in found.items()}


def test_edge_cases(spark, by):
    found = marked(spark, by)
    assert found == plain(CASES, BENCHMARK)
    assert found[10] == {"n_words": 1, "n_hit": 1, "items": []}


@pytest.mark.parametrize("bits", [7, 27])
def test_large_benchmarks_give_the_same(spark, by, monkeypatch, bits):
    """By the shuffle of what passes the sieve, also where it lets nearly everything pass."""
    whole = marked(spark, by)
    monkeypatch.setattr(operator, "BLOCK", 2)
    monkeypatch.setattr(operator, "SIEVE_BITS", bits)
    assert marked(spark, by) == whole == plain(CASES, BENCHMARK)


def test_large_benchmark_over_the_given_table(spark, table, by, monkeypatch):
    monkeypatch.setattr(operator, "BLOCK", 0)
    test_query_matches_brute_force(spark, table, by)


def test_copies_without_ids_in_both_ways(spark, monkeypatch):
    rows = [(None, CASES[6]), (None, CASES[6]), (None, "clean"), (None, None)]
    documents = spark.createDataFrame(rows, "doc_id long, text string").withColumnRenamed("doc_id", "items")
    benchmark = spark.createDataFrame(BENCHMARK, "item_id long, text string")

    def found():
        df = operator.mark_contamination(documents, benchmark, keep_text=False)
        return sorted((r.n_words, r.n_hit, r["items"]) for r in df.collect())

    whole = found()
    expected = plain(dict(enumerate(text for _, text in rows)), BENCHMARK).values()
    assert whole == sorted((e["n_words"], e["n_hit"], e["items"]) for e in expected)
    monkeypatch.setattr(operator, "BLOCK", 0)
    assert found() == whole


def test_empty_benchmark(spark, by):
    assert all(r["n_hit"] == 0 for r in marked(spark, by, benchmark=[]).values())


def test_empty_documents(spark):
    documents = spark.createDataFrame([], "doc_id long, text string")
    benchmark = spark.createDataFrame(BENCHMARK, "item_id long, text string")
    assert operator.mark_contamination(documents, benchmark).collect() == []
