"""Spelling variants against comparing words by their shortened forms, in plain Python."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from tabgrad.llm import spelling
from tabgrad.llm.queries import op13_spelling_variants

SF = "/root/testdata/sf0.001"


def plain_words(rows: list[tuple], least_length=7, least_count=2, noise=31) -> dict[str, int]:
    counts = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if noise and h % noise == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= least_length and n >= least_count}


def near(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(words: dict[str, int], ratio=10) -> list[tuple]:
    meet = defaultdict(set)
    for w in words:
        for s in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}:
            meet[s].add(w)
    nears = defaultdict(set)
    for some in meet.values():
        for a in some:
            nears[a] |= {b for b in some if near(a, b)}
    form = {}
    for w, n in words.items():
        best = min(nears[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= ratio * n else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted((w, form[w] or "", root(w), n, len(nears[w]), words[form[w]] if form[w] is not None else 0) for w, n in words.items())


def found(df) -> list[tuple]:
    return sorted((r["word"], r["form"] or "", r["root"], r["n"], r["n_near"], r["form_n"] or 0) for r in df.collect())


def test_query_matches_brute_force(spark, table):
    rows = [(r["doc_id"], r["text"]) for r in table("documents", SF)]
    wanted = plain(plain_words(rows))
    assert found(op13_spelling_variants(spark, SF)) == wanted
    assert any(r[1] for r in wanted)


def misspelt(draw: random.Random, word: str) -> str:
    at, letter = draw.randrange(len(word)), draw.choice("eaàÿ×jz")
    return draw.choice((word[:at] + word[at + 1 :], word[:at] + letter + word[at:], word[:at] + letter + word[at + 1 :]))


@pytest.mark.parametrize("held", [1, 5, 60, 20_000])
def test_blocks_and_depths_lose_no_pair(spark, held):
    draw = random.Random(held)
    words = {"e" * 7: 3, "e" * 8: 40, "e" * 9: 500, "eeeeeee" + "a" * 260: 1, "eeeeeee" + "a" * 261: 2, "abcdefg": 4, "gfedcba": 4}
    for _ in range(40):
        word = "".join(draw.choices("eainrstolu", k=draw.randint(2, 9)))
        words[word] = draw.randint(1, 2000)
        for _ in range(4):
            words[misspelt(draw, word)] = draw.randint(1, 300)
    words.pop("", None)
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    assert found(spelling.spelling_variants(df, held=held)) == plain(words)


def test_chains_of_forms(spark):
    word, words, n = "abcdefghij", {}, 10**18
    for i in range(18):
        words[word] = n
        word, n = word + "klmnopqrstuvwxyzab"[i], n // 10
    result = found(spelling.spelling_variants(spark.createDataFrame(list(words.items()), "word string, n long")))
    assert result == plain(words)
    assert {r[2] for r in result} == {"abcdefghij"}


def test_edge_cases_of_texts(spark):
    long = "Bücherregal Bucherregal " * 40_000
    texts = [None, "", " ", "Hello1HELLO", "straße×straße", "ÀÿÀÿÀÿÀÿ ÀÿÀÿÀÿÀÿ", long, "a" * 50_000 + " " + "a" * 50_001, "under_score under-score underscore"]
    rows = [(k, t) for k, t in enumerate(texts)] * 2 + [(None, "missing missing"), (None, "missing missing")]
    df = spark.createDataFrame([(k, t, "x", 1) for k, t in rows], "doc_id long, text string, word string, n int")
    words = spelling.count_words(df, noise=3)
    assert {r["word"]: r["n"] for r in words.collect()} == plain_words(rows, noise=3)
    assert found(spelling.spelling_variants(words)) == plain(plain_words(rows, noise=3))


def test_counts_are_handed_on_in_parts(spark, monkeypatch):
    monkeypatch.setattr(spelling, "_COUNTED", 3)
    rows = [(k, "several different words together again and again") for k in range(20)]
    words = spelling.count_words(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r["word"]: r["n"] for r in words.collect()} == plain_words(rows, noise=None)


def test_empty_table(spark):
    words = spelling.count_words(spark.createDataFrame([], "doc_id long, text string"))
    assert spelling.spelling_variants(words).collect() == []
