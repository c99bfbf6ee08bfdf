"""The pipeline's stages against plain versions, and the columns that pass through it."""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tabgrad.llm import decontaminate, quality
from tabgrad.llm.common import read_table
from tabgrad.llm.tokens import tokenizer_path
from tests.llm.test_decontaminate import plain as plain_contamination
from tests.llm.test_mixing import plain as plain_mixture
from tests.llm.test_simhash import plain_components, plain_fingerprint

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def results(spark):
    """The documents, and what each stage leaves, written and read again."""
    docs, out = read_table(spark, SF, "documents"), []
    out.append(docs.collect())
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialize(stage(spark, docs, SF), name)
        out.append(docs.collect())
    return out


def ids(rows):
    return sorted(r["doc_id"] for r in rows)


def test_order_of_stages():
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_classifier", "simhash_near_dedup", "benchmark_decontamination", "source_mixing", "token_output"]


def test_every_stage_drops_something_and_keeps_whole_rows(results):
    given = {r["doc_id"]: r for r in results[0]}
    for before, after in zip(results[:4], results[1:5]):
        assert 0.5 * len(before) < len(after) < len(before)
        assert all(tuple(r) == tuple(given[r["doc_id"]]) for r in after)


def test_quality_stage_is_right_on_held_out_labels(results, table):
    kept = set(ids(results[1]))
    held = [(r["doc_id"] in kept, r["quality"]) for r in table("labels", SF) if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    assert np.mean([k == (q == 1) for k, q in held]) > 0.95


def test_near_dedup_stage_keeps_one_of_each_group(results):
    """Of each component of fingerprints within 3 bits, by brute force, the least document."""
    groups = plain_components({r["doc_id"]: plain_fingerprint(r["text"] or "") for r in results[1]})
    assert ids(results[2]) == sorted(set(groups.values()))


def test_decontamination_stage(results, table):
    found = plain_contamination({r["doc_id"]: r["text"] for r in results[2]}, [(r["item_id"], r["text"]) for r in table("benchmark", SF)])
    assert ids(results[3]) == sorted(k for k, r in found.items() if not r["n_hit"])


def test_mixing_stage(results):
    wanted = plain_mixture([r.asDict() for r in results[3]], corpus_pipeline.PIPELINE_MIXTURE)
    assert ids(results[4]) == sorted(r[0] for r in wanted)


def test_token_stage(results):
    library = Tokenizer.from_file(tokenizer_path())
    start, wanted = 0, []
    for r in sorted(results[4], key=lambda r: r["doc_id"]):
        encoded = [*library.encode(r["text"], add_special_tokens=False).ids, 2]
        wanted.append((r["doc_id"], start, len(encoded), zlib.crc32(np.array(encoded, "<u4").tobytes())))
        start += len(encoded)
    assert sorted(map(tuple, results[5])) == wanted


def test_run_gives_the_last_stage(spark, results):
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == sorted(map(tuple, results[5]))


def test_clashing_columns_nulls_and_repeated_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, score string, hits int, n_hit string, domain string, epoch string, fp int, component int"
    rest = ("clash", 1, "clash", "clash", "clash", 2, 3)
    texts = {1: "plain words go here", 2: None, 3: "", 4: "plain words go here", None: "no id", 5: "other words " * 60_000}
    rows = [(k, t, None if k == 2 else "en", "src1", 7, *rest) for k, t in texts.items()] * 2
    docs = spark.createDataFrame(rows, schema)
    counts = defaultdict(int)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        assert {tuple(r) for r in out.collect()} <= set(rows)
        counts[name] = out.count()
    assert counts["simhash_near_dedup"] == 4
    assert counts["benchmark_decontamination"] == len(rows)
    assert corpus_pipeline.token_output(spark, docs, SF).count() == len(rows)


def test_empty_documents(spark):
    docs = read_table(spark, SF, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).collect() == []


def test_thresholds_are_those_of_the_operators():
    assert corpus_pipeline.QUALITY_THRESHOLD == 0.7 and decontaminate.SPAN == 10 and quality.MAX_ROWS == 4096
