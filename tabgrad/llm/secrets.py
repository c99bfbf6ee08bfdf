"""Secret scans with an incremental blob ledger.

Every version of every path is content-addressed by the SHA-256 of its text. The ledger records
which rules, in which version, have seen which blob. A scan takes one representative of each blob
that some rule has not seen yet, runs only those rules, appends what it did to the ledger, and then
joins the ledger's findings back to all paths and versions that hold the blob.

The ledger is a Parquet folder that is only ever appended to, and Spark commits an append whole, so
a scan that fails leaves it as it was. Texts are shuffled once, towards their blob's pending rules;
copies and findings move as digests.

Rules give spans in code points, end exclusive, leftmost and without overlap within a rule; a match
that is too short is dropped after matching. Defined results: a null text is the empty blob.
Repeated rows each get their findings. An empty table gives no row and scans nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabgrad.sources.store import materialize, scratch_path


@dataclass(frozen=True)
class Rule:
    """A pattern, the group whose length counts, that length, and strings one of which must be there.

    ``hints`` are lower-case ASCII and are looked for in the lower-cased text.
    """

    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 1
    hints: tuple[str, ...] = ()

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


# The first three patterns are given.
BASE = (
    Rule(
        "assign",
        1,
        r"""(?ai:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))""",
        group=2,
        least=12,
        hints=("password", "passwd", "secret", "token", "apikey", "api_key"),
    ),
    Rule("access", 1, r"AKIA[A-Z0-9]+", least=18, hints=("akia",)),
    # Shorter runs cannot hold a match, and leaving them out here is quicker.
    Rule("hex", 1, r"[0-9a-f]{16,}", least=16),
)
MORE = (
    Rule("pem", 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----", hints=("private key-----",)),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", least=30, hints=("eyj",)),
)
RULES = BASE + MORE

_FINDING = "struct<kind:string,version:int,start:bigint,end:bigint>"
_SCAN = f"blob binary, rules array<string>, findings array<{_FINDING}>"


def find(text: str, rules: tuple[Rule, ...]) -> list[tuple[str, int, int, int]]:
    """``(kind, version, start, end)`` of the spans that ``rules`` find."""
    lowered = text.lower() if any(r.hints for r in rules) else ""
    out = []
    for rule in rules:
        if rule.hints and not any(h in lowered for h in rule.hints):
            continue
        for match in re.finditer(rule.pattern, text):
            if match.end(rule.group) - match.start(rule.group) >= rule.least:
                out.append((rule.kind, rule.version, *match.span()))
    return out


def _scan(batches: Iterator[pa.RecordBatch], rules: tuple[Rule, ...]) -> Iterator[pa.RecordBatch]:
    finding = pa.struct([("kind", pa.string()), ("version", pa.int32()), ("start", pa.int64()), ("end", pa.int64())])
    names = ("kind", "version", "start", "end")
    for batch in batches:
        found = []
        for pending, text in zip(batch.column("rules"), batch.column("text")):
            wanted = set(pending.as_py())
            some = find(text.as_py(), tuple(r for r in rules if r.name in wanted))
            found.append([dict(zip(names, f)) for f in some])
        yield pa.RecordBatch.from_arrays(
            [batch.column("blob"), batch.column("rules"), pa.array(found, pa.list_(finding))],
            names=["blob", "rules", "findings"],
        )


def blob_id(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


class BlobLedger:
    """What has been scanned with which rules, and what was found, by blob."""

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark = spark
        self.path = path or scratch_path(spark, "ledger")
        self.spark.createDataFrame([], _SCAN).write.mode("append").parquet(self.path)

    def rows(self) -> DataFrame:
        """``blob, rules, findings``: one row for each scan of a blob."""
        return self.spark.read.schema(_SCAN).parquet(self.path)

    def pending(self, versions: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
        """``blob, pick, rules``: what the ledger has not seen; ``versions`` has ``blob`` and ``pick``."""
        seen = self.rows().select("blob", F.explode("rules").alias("rule")).distinct()
        seen = seen.groupBy("blob").agg(F.collect_list("rule").alias("seen"))
        wanted = F.array(*[F.lit(r.name) for r in rules])
        blobs = versions.groupBy("blob").agg(F.min("pick").alias("pick")).join(seen, "blob", "left")
        rest = F.array_except(wanted, F.coalesce("seen", F.array().cast("array<string>")))
        return blobs.select("blob", "pick", rest.alias("rules")).filter(F.size("rules") > 0)

    def scan(
        self, versions: DataFrame, keys: list[str], text: str = "text", rules: tuple[Rule, ...] = RULES
    ) -> DataFrame:
        """Scan what is new and return ``keys`` and ``findings`` of every row of ``versions``.

        ``keys`` name a version, such as path and commit.
        """
        pick = F.xxhash64(*keys).alias("pick")
        addressed = versions.select(*keys, pick, blob_id(F.col(text)).alias("blob"))
        texts = versions.select(pick, blob_id(F.col(text)).alias("blob"), F.coalesce(text, F.lit("")).alias("text"))
        chosen = texts.join(self.pending(addressed, rules), ["blob", "pick"]).select("blob", "rules", "text")
        # Rows that are equal throughout are all chosen.
        scanned = chosen.mapInArrow(partial(_scan, rules=rules), _SCAN).dropDuplicates(["blob"])
        scanned.write.mode("append").parquet(self.path)

        current = F.filter("findings", lambda f: F.concat(f.kind, F.lit("@"), f.version.cast("string")).isin(*[r.name for r in rules]))
        hits = self.rows().select("blob", current.alias("findings")).filter(F.size("findings") > 0)
        by_blob = hits.groupBy("blob").agg(F.flatten(F.collect_list("findings")).alias("findings"))
        # Written, so that adaptive execution can split the join at a blob with many paths.
        found = materialize(by_blob, "findings")
        nothing = F.array().cast(f"array<{_FINDING}>")
        return addressed.join(found, "blob", "left").select(*keys, F.coalesce("findings", nothing).alias("findings"))
