"""The corpus pipeline: five stages from ``documents`` to framed token files.

Each stage is a function of ``(spark, docs, sf_dir)``. Its result is written as Parquet and read
again as the next one's documents. All but the last return the columns of ``documents``, whatever
they are; ``doc_id``, ``text``, ``lang`` and ``source`` are used.

Defined results: a null text is empty; it is scored, linked to other empty texts and written as one
end id. Ids may be null or repeated: rows are scored one by one, and of linked rows one stays, the
least by id (one without only if none has one) and then by a hash of the row. An empty table gives no rows. Whole rows go
through the stages in one column, so extra columns may have any name.

ORACLE_SQL is None: neither a fitted model nor the tokenizer can be expressed in SQL. The tests
compare the stages with brute-force versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabgrad.llm import decontaminate, mixing, quality, simhash, tokens
from tabgrad.llm.common import read_table
from tabgrad.llm.queries import MIXTURE, QUALITY_THRESHOLD
from tabgrad.sources.store import discard, materialize, scratch_path, scratch_scope

ORACLE_SQL = None

# No document comes twice, and a tenth of the tokens is left out where the weights give least.
PIPELINE_MIXTURE = mixing.Mixture(
    domains=MIXTURE.domains,
    domain_weights=MIXTURE.domain_weights,
    lang_weights=MIXTURE.lang_weights,
    budget_percent=90,
    max_epochs=1,
)


def _packed(docs: DataFrame, *used: str) -> DataFrame:
    """Whole rows in one column, so that no column of theirs can clash with a result."""
    return docs.select(F.struct(*docs.columns).alias("_doc"), *used)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the classifier rejects."""
    weights = quality.fit(docs, read_table(spark, sf_dir, "labels"), "quality")
    scored = quality.score(_packed(docs, "text"), weights, keep_text=False)
    return scored.filter(F.col("score") >= QUALITY_THRESHOLD).select("_doc.*")


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-duplicates."""
    return simhash.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a window of the benchmark."""
    benchmark = read_table(spark, sf_dir, "benchmark")
    marked = decontaminate.mark_contamination(_packed(docs, "text"), benchmark, keep_text=False)
    return marked.filter("n_hit = 0").select("_doc.*")


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Choose documents to the target weights."""
    rows = _packed(docs, "doc_id", "text", "lang", "source")
    return mixing.mix(rows, PIPELINE_MIXTURE, keep_text=False).select("_doc.*")


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Write the token files and read them back."""
    return tokens.read_tokens(spark, tokens.write_tokens(docs))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mixing", source_mixing),
    ("token_output", token_output),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; returns the rows of the last one.

    A stage's own tables are deleted when its result is written, and a result when the next one is.
    """
    docs, path = read_table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        kept = scratch_path(spark, name)
        with scratch_scope(spark):
            after = materialize(stage(spark, docs, sf_dir), path=kept)
        if path:
            discard(spark, path)
        docs, path = after, kept
    return STAGES[-1][1](spark, docs, sf_dir)
