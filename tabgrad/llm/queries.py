"""The registered queries: each applies one operator to its whole table, with fixed parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabgrad.llm import (
    chat,
    decontaminate,
    exact,
    mixing,
    negatives,
    quality,
    secrets,
    sharding,
    simhash,
    spelling,
    suffixes,
    tokens,
    topk,
)
from tabgrad.llm.common import read_table, text_of

PROBE = "<|im_end|><|im_start|>assistant ok"
N_SHARDS = 24


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Format every conversation and a probe, and digest what is read back."""
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", text_of().alias("text"))
    probe = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(PROBE).alias("text"),
    )
    parts = turns.unionByName(probe).withColumn("parts", chat.as_parts(F.col("text")))
    read = chat.read_chats(chat.format_chats(parts))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss_text").cast("bigint").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


def op2_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scan every document with a new ledger and digest its findings."""
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.BlobLedger(spark).scan(documents, ["doc_id"])
    base = [r.kind for r in secrets.BASE]
    kinds = F.array(*[F.lit(r.kind) for r in secrets.RULES])

    def spans(findings):
        ordered = F.array_sort(
            F.transform(findings, lambda f: F.struct(f.start.alias("start"), F.array_position(kinds, f.kind).alias("place"), f.kind.alias("kind"), f.end.alias("end")))
        )
        return F.array_join(F.transform(ordered, lambda f: F.concat_ws(":", f.kind, f.start, f.end)), ",")

    def count(kind):
        return F.size(F.filter("findings", lambda f: f.kind == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[count(kind) for kind in base],
        F.sha2(spans(F.filter("findings", lambda f: f.kind.isin(*base))), 256).alias("base_sha256"),
        spans(F.col("findings")).alias("spans"),
    )


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deal every document to a shard, mixture by source, counts at most one apart."""
    documents = read_table(spark, sf_dir, "documents").select(
        "doc_id",
        "source",
        (F.octet_length(text_of()) + 8).cast("bigint").alias("size"),
        F.crc32(text_of().cast("binary")).alias("text_crc32"),
    )
    return sharding.shard_rows(documents, "doc_id", "source", N_SHARDS).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint every document and name its component of fingerprints within 3 bits."""
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest rows of every hundredth embedding, by integer inner product."""
    vectors = read_table(spark, sf_dir, "embeddings").select(
        "vec_id", topk.whole_numbers(F.col("embedding"), 1024).alias("vector")
    )
    return topk.top_k(vectors.filter("vec_id % 100 = 0"), vectors, k=10)


def op6_token_id_binary_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the token ids of every document as framed records and digest what is read back."""
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return tokens.read_tokens(spark, tokens.write_tokens(documents))


QUALITY_THRESHOLD = 0.7


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score every document with a model of ``labels.quality``."""
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    weights = quality.fit(documents, read_table(spark, sf_dir, "labels"), "quality")
    return quality.score(documents, weights, keep_text=False).select(
        "doc_id",
        (~quality.in_training(F.col("doc_id"))).alias("held_out"),
        "score",
        (F.col("score") >= QUALITY_THRESHOLD).cast("int").alias("predicted"),
    )


def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Remove every byte that a string of 400 bytes covers which also starts elsewhere."""
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    removed = suffixes.remove_repeats(documents, least=400, keep="none")
    return removed.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("bigint").alias("n_spans"), "kept_sha256")


MIXTURE = mixing.Mixture(
    domains={f"src{n}": ("web", "books", "code", "forum")[n % 4] for n in range(20)},
    domain_weights={"web": 4, "books": 3, "code": 2, "forum": 1},
    lang_weights={"en": 5, "de": 2, "fr": 2, "es": 1},
    budget_percent=60,
    max_epochs=2,
)


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Choose documents to target weights of domains, languages and sources, up to two epochs."""
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return mixing.mix(documents, MIXTURE, keep_text=False)


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mark the words of every document that lie in a window of the benchmark."""
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = decontaminate.mark_contamination(documents, read_table(spark, sf_dir, "benchmark"), keep_text=False)
    named = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    return marked.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(named, ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op11_hard_negative_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten hard negatives for each of five positives of every hundredth embedding."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = read_table(spark, sf_dir, "embeddings").select(
        "vec_id", label.alias("label"), topk.whole_numbers(F.col("embedding"), 256).alias("vector")
    )
    return negatives.hard_negatives(rows, "vec_id % 100 = 0", n_positives=5, n_negatives=10, low=30, high=90)


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Name the row that stays for every document, with the digest of its text."""
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text", F.sha2(text_of(), 256).alias("text_sha256"))
    return exact.mark_duplicates(documents).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group the words of all documents, with every 31st run misspelt, by their near words."""
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    words = spelling.count_words(documents, least_length=7, least_count=2, noise=31)
    return spelling.spelling_variants(words, ratio=10)


QUERIES = {
    "op1_chat_formatting": op1_chat_formatting,
    "op2_secret_scans": op2_secret_scans,
    "op3_sharding": op3_sharding,
    "op4_simhash_near_dedup": op4_simhash_near_dedup,
    "op5_exact_top_k": op5_exact_top_k,
    "op6_token_id_binary_output": op6_token_id_binary_output,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_suffix_array_dedup": op8_suffix_array_dedup,
    "op9_source_mixing": op9_source_mixing,
    "op10_benchmark_decontamination": op10_benchmark_decontamination,
    "op11_hard_negative_mining": op11_hard_negative_mining,
    "op12_exact_dedup": op12_exact_dedup,
    "op13_spelling_variants": op13_spelling_variants,
}
