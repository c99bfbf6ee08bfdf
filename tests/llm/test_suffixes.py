"""Removed bytes against a dictionary of all strings of the given length."""

from __future__ import annotations

import hashlib
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

import tabgrad.llm.suffixes as operator
from tabgrad.llm.queries import op8_suffix_array_dedup
from tabgrad.llm.suffixes import factors, remove_repeats

SF = "/root/testdata/sf0.01"


def plain(rows: list[tuple], least: int, keep: str = "none") -> list[tuple]:
    """``rows`` in order of position."""
    seen: dict[bytes, list] = {}
    texts = [(t or "").encode() for _, t in rows]
    for n, text in enumerate(texts):
        for i in range(len(text) - least + 1):
            entry = seen.setdefault(hashlib.blake2b(text[i : i + least], digest_size=16).digest(), [0, (n, i)])
            entry[0] += 1
    out = []
    for n, ((key, _), text) in enumerate(zip(rows, texts)):
        gone = np.zeros(len(text), bool)
        for i in range(len(text) - least + 1):
            count, first = seen[hashlib.blake2b(text[i : i + least], digest_size=16).digest()]
            if count > 1 and (keep == "none" or first != (n, i)):
                gone[i : i + least] = True
        kept = bytes(np.frombuffer(text, np.uint8)[~gone])
        spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        out.append((key, len(text), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def run(spark, rows, least, keep="none"):
    df = spark.createDataFrame([(k, t, "clash", 1) for k, t in rows], "doc_id long, text string, body string, low int")
    found = remove_repeats(df, least=least, keep=keep, with_text=True).collect()
    for r in found:
        assert hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 and len(r.kept) == r.n_bytes - r.n_removed
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, len(r.spans), r.kept_sha256) for r in found), key=repr)


def test_query_matches_brute_force(spark, table):
    rows = [(r["doc_id"], r["text"]) for r in table("documents", SF)]
    found = op8_suffix_array_dedup(spark, SF).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    expected = plain(rows, 400)
    assert sum(r[2] > 0 for r in expected) > 20
    assert sorted(map(tuple, found), key=repr) == expected


def texts(seed: int, n: int, letters: str = "ab") -> list[tuple]:
    """Texts pasted from shared pieces, so that matches of all lengths begin and end anywhere."""
    draw = random.Random(seed)
    shared = ["".join(draw.choices(letters, k=draw.randint(1, 60))) for _ in range(8)]
    return [(i, "".join(draw.choices(shared, k=draw.randint(0, 5))) + "".join(draw.choices(letters, k=draw.randint(0, 9)))) for i in range(n)]


@pytest.mark.parametrize("keep", ["none", "first"])
@pytest.mark.parametrize("seed,least,letters", [(1, 40, "ab"), (2, 24, "abcdé"), (3, 61, "a"), (4, 7, "abc"), (5, 2, "abcdefgh")])
def test_matches_brute_force(spark, seed, least, letters, keep):
    rows = texts(seed, 60, letters)
    assert run(spark, rows, least, keep) == plain(rows, least, keep)


@pytest.mark.parametrize("keep", ["none", "first"])
def test_classes_too_large_to_meet(spark, monkeypatch, keep):
    monkeypatch.setattr(operator, "GROUP", 3)
    rows = texts(7, 80, "abc")
    assert run(spark, rows, 30, keep) == plain(rows, 30, keep)


@pytest.mark.parametrize("group,least", [(2, 31), (5, 8), (1, 2), (20, 40)])
def test_every_split_of_a_class_gives_the_same(spark, monkeypatch, group, least):
    monkeypatch.setattr(operator, "GROUP", group)
    rows = texts(10 + group, 50, "ab") + [(100 + i, "ab" * 30 + "x" * i) for i in range(12)]
    for keep in ("none", "first"):
        assert run(spark, rows, least, keep) == plain(rows, least, keep)


def test_parts_of_a_split_fit_a_task(spark, monkeypatch):
    """Contexts of one class that differ on both sides: parts stay small, strings carry the rest."""
    monkeypatch.setattr(operator, "GROUP", 4)
    core = b"0123456789"
    draw = random.Random(3)
    sides = [bytes(draw.choices(b"ab", k=10)) + core + bytes(draw.choices(b"ab", k=10)) for _ in range(60)]
    sides += [b"a" * 10 + core + bytes(draw.choices(b"cd", k=10)) for _ in range(20)]
    rows = [(7, 0, 10, 7, i, i, 0, 10, 10, 10, s, b"") for i, s in enumerate(sides)]
    fitting, whole = operator._split(spark.createDataFrame(rows, operator._CONTEXT), 20)
    assert max(r["count"] for r in fitting.groupBy("part").count().collect()) <= 4
    runs = [(sides[r["context"]], run["from"], run["to"]) for r in whole.collect() for run in r["repeated"]]
    assert runs
    for side, low, high in runs:
        assert sum(s[10 - high : 30 - low] == side[10 - high : 30 - low] for s in sides) > 1


def test_long_texts_go_in_segments(spark, monkeypatch):
    monkeypatch.setattr(operator, "_SEGMENT", 300)
    rows = [(i, t * 9) for i, t in texts(9, 25, "abcdefgh")]
    assert run(spark, rows, 40) == plain(rows, 40)


def test_edge_cases(spark):
    once = "".join(random.Random(1).choices("abcdefghijklmnop", k=2000))
    rows = [(1, None), (2, ""), (3, once), (4, "x" * 30_000), (5, once[500:905]), (6, "\0" * 401 + "é"), (7, once[:399]), (8, "q" + once[1000:1400])]
    assert run(spark, rows, 400) == plain(rows, 400)
    assert run(spark, rows, 400, "first") == plain(rows, 400, "first")


def test_repeated_rows_and_missing_ids(spark):
    once = "".join(random.Random(2).choices("abcdefghij", k=900))
    rows = [(None, once), (5, once[::-1]), (5, once[::-1]), (None, "alone" * 10)]
    assert run(spark, rows, 100) == plain(rows, 100)
    assert all(r[2] == 0 for r in run(spark, rows, 100, "first"))


def test_empty_table(spark):
    assert run(spark, [], 400) == []


def test_previous_factors():
    contexts = [b"xxabcdefgh", b"yxabcdefgh", b"xxabcdzzzz", b"zzabcdefgh"]
    found = {
        d: (sorted(members.tolist()), sorted(members[later].tolist()))
        for d, members, later in factors(np.zeros(4, int), np.array([1, 0, 2, 3]), np.full(4, 2), contexts, 6)
    }
    assert found == {0: ([0, 1, 3], [0, 3]), 1: ([0, 1], [0]), 2: ([0, 2], [2])}


def test_large_classes_take_only_their_own_texts(spark):
    rows = spark.createDataFrame([(i, -i, i, b"x") for i in range(3000)], "owner long, tie long, doc_id long, body binary")
    chosen = rows.filter("owner % 100 = 0").select("owner", "tie")
    passed = operator._owning(rows, chosen)
    assert passed.columns == rows.columns
    assert chosen.exceptAll(passed.select("owner", "tie")).isEmpty()
    assert passed.count() <= 32
    assert operator._owning(rows, chosen.limit(0)).isEmpty()


def test_anchors_of_many_texts_take_bounded_memory():
    """A task's arrays follow its segments, not the rows that one batch brings."""
    draw = np.random.default_rng(4)
    rows = [draw.integers(97, 123, 6000, np.uint8).tobytes() for _ in range(800)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(800)), pa.array(range(800)), pa.array(rows)], names=["owner", "tie", "body"])
    tracemalloc.start()
    cells = sum(b.num_rows for b in operator._cells(iter([batch]), 400))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert cells > 800
    assert peak < 40e6


def test_a_stage_runs_one_python_worker_a_task(spark, monkeypatch):
    """Every stage between two shuffles or scratch tables has one function of Python at most."""
    monkeypatch.setattr(operator, "GROUP", 3)
    counts, write = {}, operator.materialize

    def watched(df, name):
        counts.setdefault(name, []).append(df._jdf.queryExecution().executedPlan().toString().count("MapInArrow"))
        return write(df, name)

    monkeypatch.setattr(operator, "materialize", watched)
    rows = texts(7, 80, "abc")
    assert run(spark, rows, 30) == plain(rows, 30)
    assert len(counts["halves"]) > 1
    assert set(counts["halves"]) == {1}
