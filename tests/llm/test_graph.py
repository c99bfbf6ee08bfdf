"""Connected components against plain ones, and how many rounds they take."""

from __future__ import annotations

import random

import pytest

from tabgrad.llm import graph
from tabgrad.llm.graph import components


def plain(edges: list[tuple]) -> dict[int, int]:
    parent = {}

    def root(n):
        while parent.setdefault(n, n) != n:
            n = parent[n]
        return n

    for a, b in edges:
        low, high = sorted((root(a), root(b)))
        if a != b:
            parent[high] = low
    return {n: root(n) for n in {x for e in edges if e[0] != e[1] for x in e}}


def found(spark, edges: list[tuple]) -> dict[int, int]:
    rows = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert len({r["node"] for r in rows}) == len(rows)
    return {r["node"]: r["component"] for r in rows}


@pytest.fixture
def writes(monkeypatch):
    """Names of the tables that are written."""
    names, path = [], graph.scratch_path
    monkeypatch.setattr(graph, "scratch_path", lambda spark, name: names.append(name) or path(spark, name))
    return names


def test_random_graphs(spark):
    draw = random.Random(3)
    edges = [(draw.randint(-60, 60), draw.randint(-60, 60)) for _ in range(70)]
    edges += [(1000, n) for n in range(2000, 2200)] + [(5, 5), (5, 5), (-7, 9), (9, -7)]
    assert found(spark, edges) == plain(edges)


@pytest.mark.parametrize("step", [1, -1])
def test_a_chain_takes_few_rounds(spark, writes, step):
    chain = list(range(0, 4096 * step, step))
    assert set(found(spark, list(zip(chain, chain[1:]))).values()) == {min(chain)}
    assert writes.count("moves") <= 15


def test_empty_graph(spark):
    assert found(spark, []) == {}
