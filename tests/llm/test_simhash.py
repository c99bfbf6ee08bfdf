"""Fingerprints and components against brute force over all pairs."""

from __future__ import annotations

import random
import re

import xxhash

from tabgrad.llm.queries import op4_simhash_near_dedup
from tabgrad.llm.simhash import fingerprint, keep_one, links, near_duplicates

SF = "/root/testdata/sf0.01"


def plain_fingerprint(text: str) -> int:
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words = re.findall("[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints: dict[int, int]) -> dict[int, int]:
    parent = {p: p for p in prints.values()}

    def root(p):
        while parent[p] != p:
            p = parent[p]
        return p

    distinct = sorted(parent)
    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if (a ^ b).bit_count() <= 3:
                parent[root(a)] = root(b)
    least = {}
    for key in sorted(prints):
        least.setdefault(root(prints[key]), key)
    return {key: least[root(p)] for key, p in prints.items()}


def check(found: dict[int, dict], texts: dict[int, str]) -> None:
    prints = {k: plain_fingerprint(t or "") for k, t in texts.items()}
    expected = plain_components(prints)
    assert {k: r["fingerprint"] for k, r in found.items()} == {k: f"{p:016x}" for k, p in prints.items()}
    assert {k: r["component_id"] for k, r in found.items()} == expected


def test_query_matches_brute_force(spark, table, by):
    texts = {r["doc_id"]: r["text"] for r in table("documents", SF)}
    check(by(op4_simhash_near_dedup(spark, SF), "doc_id"), texts)


def test_links_connect_every_pair_within_three_bits(spark):
    draw = random.Random(5)
    prints = set()
    for _ in range(12):
        centre = draw.getrandbits(64)
        for _ in range(12):
            prints.add(centre ^ sum(1 << b for b in draw.sample(range(64), draw.randint(0, 4))))
    signed = [p - (1 << 64) if p >> 63 else p for p in sorted(prints)]
    linked = {(r.a, r.b) for r in links(spark.createDataFrame([(p,) for p in signed], "fp long")).collect()}
    assert all(((a ^ b) & ((1 << 64) - 1)).bit_count() <= 3 for a, b in linked)
    found = plain_components(dict(enumerate(sorted(prints))))
    parent = {p: p for p in signed}

    def root(p):
        while parent[p] != p:
            p = parent[p]
        return p

    for a, b in linked:
        parent[root(a)] = root(b)
    groups = {}
    for i, p in enumerate(sorted(prints)):
        groups.setdefault(root(p - (1 << 64) if p >> 63 else p), set()).add(found[i])
    assert all(len(g) == 1 for g in groups.values())
    assert len(groups) == len(set(found.values()))


def test_edge_cases(spark, by):
    texts = {1: None, 2: "", 3: " \t\n", 4: "One", 5: "one", 6: "a b", 7: "A  B", 8: "x y z " * 70_000, 9: "x y z", 10: "é È"}
    rows = [(k, t, "clash", 1) for k, t in texts.items()]
    found = by(near_duplicates(spark.createDataFrame(rows, "doc_id long, text string, fp string, component_id int")), "doc_id")
    check(found, texts)
    assert found[3]["component_id"] == 1 and found[7]["component_id"] == 6


def test_repeated_rows_and_missing_ids(spark):
    df = spark.createDataFrame([(7, "same words here"), (7, "same words here"), (None, "same words here"), (None, "alone")], "doc_id long, text string")
    rows = sorted(((r.doc_id, r.component_id) for r in near_duplicates(df).collect()), key=repr)
    assert rows == sorted([(7, 7), (7, 7), (None, 7), (None, None)], key=repr)


def test_empty_table(spark):
    assert near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_long_text_goes_in_chunks():
    text = " ".join(str(i) for i in range(40_000))
    assert fingerprint(text.encode()) == plain_fingerprint(text)


def test_keep_one_leaves_the_least_of_each_component(spark, table):
    rows = table("documents", "/root/testdata/sf0.001")
    df = spark.createDataFrame([tuple(r.values()) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = keep_one(df)
    assert kept.columns == df.columns
    components = plain_components({r["doc_id"]: plain_fingerprint(r["text"] or "") for r in rows})
    wanted = [r for r in rows if components[r["doc_id"]] == r["doc_id"]]
    assert 0 < len(wanted) < len(rows)
    assert sorted(map(tuple, kept.collect())) == sorted(tuple(r.values()) for r in wanted)
