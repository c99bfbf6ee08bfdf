"""Held-out accuracy, what the model may see, and edge cases."""

from __future__ import annotations

import hashlib
import math
import zlib

import numpy as np
import pytest

from tabgrad.llm import quality
from tabgrad.llm.queries import op7_quality_classifier

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark, table, by):
    found = by(op7_quality_classifier(spark, SF), "doc_id")
    assert len(found) == len(table("documents", SF))
    assert all(r["held_out"] == (zlib.crc32(str(k).encode()) % 4 == 2) for k, r in found.items())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in found.values())
    held = [(found[r["doc_id"]]["predicted"], r["quality"]) for r in table("labels", SF) if found[r["doc_id"]]["held_out"]]
    assert np.mean([p == q for p, q in held]) > 0.98


def frames(spark, texts, labels):
    return (
        spark.createDataFrame([(k, t, "clash") for k, t in texts.items()], "doc_id long, text string, score string"),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
    )


def test_held_out_labels_are_not_seen(spark):
    texts = {k: f"word{k % 5} and more" for k in range(40)}
    labels = [(k, k % 2, 0) for k in texts]
    documents, known = frames(spark, texts, labels)
    turned = spark.createDataFrame([(k, 1 - q if zlib.crc32(str(k).encode()) % 4 == 2 else q, 1) for k, q, _ in labels], known.schema)
    assert np.array_equal(quality.fit(documents, known, "quality"), quality.fit(documents, turned, "quality"))


def test_edge_cases(spark, by):
    texts = {1: None, 2: "", 3: " \n", 4: "good words here", 5: "bad!! bad!! " * 50_000, 6: "ungesehen"}
    documents, known = frames(spark, texts, [(1, 1, 0), (4, 1, 0), (4, None, 0), (5, 0, 0), (None, 1, 0), (77, 1, 0), (5, 0, 0)])
    weights = quality.fit(documents, known, "quality")
    found = by(quality.score(documents, weights), "doc_id")
    assert found.keys() == texts.keys()
    assert {k: r["text"] for k, r in found.items()} == texts
    assert found[1]["score"] == found[2]["score"] == found[3]["score"]
    assert all(0 < r["score"] < 1 for r in found.values())


def test_repeated_rows_stay(spark):
    documents, known = frames(spark, {1: "a", 3: "b"}, [(1, 1, 0), (3, 0, 0)])
    weights = quality.fit(documents, known, "quality")
    assert quality.score(documents.union(documents), weights).count() == 4


def plain_scores(texts: dict, labels: list[tuple], max_rows: int, settings=quality.Ftrl()) -> dict:
    """FTRL-proximal over dictionaries, one number at a time."""
    lowest = {}
    for key, label, _ in labels:
        if None not in (key, label) and zlib.crc32(str(key).encode()) % 4 != 2:
            lowest[key] = min(label, lowest.get(key, label))
    order = sorted(lowest, key=lambda k: hashlib.md5(f"42:{k}".encode()).hexdigest())[:max_rows]
    features = {}
    for key, text in texts.items():
        (_, _, _, places, values), = quality.featurize([(text or "").encode()])
        features[key] = dict(zip(places.tolist(), values.tolist()))
    bias, z, n, w = 1 << quality.BITS, {}, {}, {}
    for _ in range(settings.epochs):
        for key in order:
            if key not in texts:
                continue
            row = {p: float(np.float32(v)) for p, v in features[key].items()} | {bias: 1.0}
            error = 1 / (1 + math.exp(-sum(w.get(p, 0.0) * v for p, v in row.items()))) - lowest[key]
            for p, v in row.items():
                g, before = error * v, n.get(p, 0.0)
                n[p] = before + g * g
                z[p] = z.get(p, 0.0) + g - (math.sqrt(n[p]) - math.sqrt(before)) / settings.alpha * w.get(p, 0.0)
                if abs(z[p]) <= settings.l1:
                    w[p] = 0.0
                else:
                    w[p] = (math.copysign(settings.l1, z[p]) - z[p]) / ((settings.beta + math.sqrt(n[p])) / settings.alpha + settings.l2)
    dots = {k: sum(float(np.float32(w.get(p, 0.0))) * v for p, v in row.items()) for k, row in features.items()}
    return {k: 1 / (1 + math.exp(-d - float(np.float32(w.get(bias, 0.0))))) for k, d in dots.items()}


@pytest.mark.parametrize("max_rows", [60, 4096])
def test_scores_match_plain_updates(spark, table, by, max_rows):
    small = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in table("documents", small)}
    labels = [tuple(r.values()) for r in table("labels", small)]
    documents = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    weights = quality.fit(documents, known, "quality", max_rows=max_rows)
    found = by(quality.score(documents, weights), "doc_id")
    wanted = plain_scores(texts, labels, max_rows)
    assert max(abs(found[k]["score"] - s) for k, s in wanted.items()) < 1e-6


def test_repeated_ids_do_not_add_to_the_sample(spark):
    documents, known = frames(spark, {k: f"words {k} here" for k in range(40)}, [(k, k % 2, 0) for k in range(40)])
    once, many = quality.fit(documents, known, "quality"), documents
    for _ in range(3):
        many = many.union(documents)
    assert np.array_equal(once, quality.fit(many, known, "quality"))


def test_without_labels_nothing_is_rejected(spark):
    documents, none = frames(spark, {1: "a", 2: None}, [])
    assert quality.fit(documents, none, "quality") is None
    assert [r.score for r in quality.score(documents, None).collect()] == [1.0, 1.0]


def test_empty_documents(spark):
    documents, known = frames(spark, {1: "a"}, [(1, 1, 0)])
    weights = quality.fit(documents, known, "quality")
    assert quality.score(documents.limit(0), weights).collect() == []
