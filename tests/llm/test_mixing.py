"""Budgets against a recursive water-filling, choices against a walk through each leaf."""

from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict

import pytest

from tabgrad.llm.mixing import Mixture, mix
from tabgrad.llm.oracle import ORACLE
from tabgrad.llm.queries import op9_source_mixing

SF = "/root/testdata/sf0.01"


def fill(budget: int, children: list[tuple[int, int, str]]) -> dict[str, int]:
    """``(supply, weight, name)`` to amounts: who cannot use a share gets what it has, until all can."""
    out, open_ = {}, sorted(children, key=lambda c: (c[0] / c[1] if c[1] else -1.0, c[2]))
    left = budget
    while open_:
        supply, weight, name = open_[0]
        total = sum(w for _, w, _ in open_)
        if supply * total > weight * left:
            return out | {n: w * left // total for _, w, n in open_}
        out[name] = supply
        left -= supply
        open_.pop(0)
    return out


def plain(rows: list[dict], m: Mixture) -> list[tuple]:
    docs = []
    for r in rows:
        tokens = len(re.findall("[^\x20\x09-\x0D]+", r["text"] or ""))
        source = r["source"] or ""
        docs.append((m.domains.get(source, "other"), r["lang"] or "", source, r["doc_id"], tokens))
    leaves: dict[tuple, int] = defaultdict(int)
    for *leaf, _, tokens in docs:
        leaves[tuple(leaf)] += tokens
    named = (m.domain_weights, m.lang_weights, m.source_weights)
    weight = lambda level, name: named[level].get(name, 1)
    open_ = {leaf: all(weight(i, x) for i, x in enumerate(leaf)) for leaf in leaves}
    supply = {leaf: n * m.max_epochs * open_[leaf] for leaf, n in leaves.items()}
    budgets: dict[tuple, int] = {(): sum(leaves.values()) * m.budget_percent // 100}
    for level in range(3):
        for parent in [p for p in budgets if len(p) == level]:
            below: dict[str, int] = defaultdict(int)
            for leaf, n in supply.items():
                if leaf[:level] == parent:
                    below[leaf[level]] += n
            for name, got in fill(budgets[parent], [(n, weight(level, x), x) for x, n in below.items()]).items():
                budgets[(*parent, name)] = got
    out = []
    for leaf, total in leaves.items():
        mine = [(d[3], d[4]) for d in docs if d[:3] == leaf]
        left = budgets[leaf]
        for epoch in range(m.max_epochs):
            if not open_[leaf] or (total and left <= 0) or (not total and epoch):
                break
            drawn = lambda d: hashlib.md5(f"{m.seed}:{epoch}:{'null' if d[0] is None else d[0]}".encode()).hexdigest()  # noqa: B023, E731
            so_far = 0
            for key, tokens in sorted(mine, key=drawn):
                so_far += tokens
                if so_far > left:
                    break
                out.append((key, leaf[0], leaf[1], leaf[2], tokens, epoch))
            left -= total
    return sorted(out, key=repr)


def run(spark, rows, m):
    schema = "doc_id long, text string, lang string, source string, epoch string, extra int"
    df = spark.createDataFrame([(r["doc_id"], r["text"], r["lang"], r["source"], "clash", 1) for r in rows], schema)
    found = mix(df, m)
    assert found.columns == ["doc_id", "text", "lang", "source", "extra", "domain", "tokens", "epoch"]
    return sorted(((r.doc_id, r.domain, r.lang or "", r.source or "", r.tokens, r.epoch) for r in found.collect()), key=repr)


def made(seed: int, n: int) -> list[dict]:
    draw = random.Random(seed)
    return [
        {
            "doc_id": i,
            "text": draw.choice([None, "", "w " * draw.randint(1, 40), "long text " * draw.randint(1, 9)]),
            "lang": draw.choice(["en", "en", "en", "de", None]),
            "source": draw.choice(["a", "a", "a", "a", "b", "c", "d", None]),
        }
        for i in range(n)
    ]


@pytest.mark.parametrize("percent", [0, 7, 60, 100, 250])
@pytest.mark.parametrize("epochs", [1, 3])
def test_matches_plain_walk(spark, percent, epochs):
    m = Mixture({"a": "x", "b": "x", "c": "y"}, {"x": 1, "y": 5}, {"de": 3}, {"a": 2, "d": 0}, percent, epochs)
    rows = made(percent + epochs, 90)
    assert run(spark, rows, m) == plain(rows, m)


def test_shortage_goes_to_siblings_first(spark):
    """Source b has little, so a gets its rest, and the other domain only what both cannot use."""
    rows = [{"doc_id": i, "text": "w", "lang": "en", "source": "a" if i < 60 else "b" if i < 65 else "c"} for i in range(165)]
    m = Mixture({"a": "x", "b": "x", "c": "y"}, {"x": 1, "y": 1}, budget_percent=60, max_epochs=1)
    counts = defaultdict(int)
    for r in run(spark, rows, m):
        counts[r[3]] += 1
    assert counts == {"b": 5, "a": 44, "c": 49}


def test_repeated_rows_and_missing_ids(spark):
    rows = [{"doc_id": k, "text": "a b", "lang": "en", "source": "s"} for k in (1, 1, None, None, 4)]
    assert len(run(spark, rows, Mixture(budget_percent=100, max_epochs=2))) == 5
    assert len(run(spark, rows, Mixture(budget_percent=200, max_epochs=2))) == 10


def test_very_long_text(spark):
    rows = [{"doc_id": 1, "text": "w " * 500_000, "lang": "en", "source": "s"}, {"doc_id": 2, "text": "w", "lang": "en", "source": "s"}]
    m = Mixture(budget_percent=50, max_epochs=1)
    assert run(spark, rows, m) == plain(rows, m)


def test_empty_table(spark):
    assert run(spark, [], Mixture()) == []


def test_query_matches_sql(spark):
    from oracle_check import differences, duck

    assert differences(duck(SF), op9_source_mixing(spark, SF), ORACLE["op9_source_mixing"]) is None
