"""Mixing sources to target weights by hierarchical budgeting.

A budget of tokens runs down a tree of domains, languages and sources. At each node the children
share it by their weights; a child that has less than its share leaves the rest to its siblings, by
their weights, and only what all of them together cannot use goes back to the ancestors. Since a
node's supply is what all its leaves can give, this is one water-filling per node, from the top
down. Leaves may be read several times: an epoch is a new seeded order of the leaf, and a leaf gives
the longest prefix of its epochs, one after the other, that fits its budget.

Amounts are whole numbers, so no result depends on the order of a sum. The tree has a row per leaf.
Epochs that fit whole are taken as they are. Of the one that is cut, rows are never ranked in one
window per leaf: draws are hashes, and running sums go within ``(leaf, bucket of draws)``, after the
sums of the buckets before.

Defined results: a null text has no tokens; null counts as the empty language or source. What has no
weight has weight 1, and a weight of 0 takes nothing. Equal draws go by a hash of the row; rows that
are equal throughout are interchangeable. An empty table gives no row. Columns of the documents
named like a result are replaced; all others are passed on.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabgrad.llm.common import before, bucket_of, draw, text_of
from tabgrad.sources.store import materialize

LEAF = ("domain", "lang", "source")
RESULTS = ("domain", "tokens", "epoch")
_AMOUNT = "decimal(19,0)"


@dataclass(frozen=True)
class Mixture:
    """Whole weights by name for each level, the share of all tokens to take, and the most epochs.

    ``domains`` gives the domain of a source; sources that it does not name are in ``other``.
    """

    domains: dict[str, str] = field(default_factory=dict)
    domain_weights: dict[str, int] = field(default_factory=dict)
    lang_weights: dict[str, int] = field(default_factory=dict)
    source_weights: dict[str, int] = field(default_factory=dict)
    budget_percent: int = 60
    max_epochs: int = 2
    seed: int = 42


def token_count(text: str = "text") -> Column:
    """Words at ASCII white space: a measure of tokens that needs no tokenizer."""
    return F.regexp_count(text_of(text), F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint")


def _named(column: Column, values: dict, otherwise) -> Column:
    if not values:
        return F.lit(otherwise)
    table = F.create_map(*[F.lit(x) for pair in values.items() for x in pair])
    return F.coalesce(F.element_at(table, column), F.lit(otherwise))


def budgets(leaves: DataFrame, mixture: Mixture) -> DataFrame:
    """Add ``budget`` to the leaves ``(domain, lang, source, tokens)``, and whether they may give at all."""
    named = (mixture.domain_weights, mixture.lang_weights, mixture.source_weights)
    weights = {level: _named(F.col(level), values, 1).cast("bigint") for level, values in zip(LEAF, named)}
    total = leaves.agg(F.sum("tokens")).first()[0] or 0
    nothing = (weights["domain"] == 0) | (weights["lang"] == 0) | (weights["source"] == 0)
    supply = F.when(nothing, 0).otherwise(F.col("tokens") * mixture.max_epochs).cast("bigint")
    given = F.lit(total * mixture.budget_percent // 100).cast("bigint")
    rows = leaves.select("*", (~nothing).alias("open"), supply.alias("_supply"), given.alias("budget"))
    for depth, level in enumerate(LEAF):
        rows = _share(rows, LEAF[:depth], level, weights[level])
    return rows.drop("_supply")


def _share(rows: DataFrame, parents: tuple[str, ...], level: str, weight: Column) -> DataFrame:
    """Turn ``budget`` from that of the parent to that of the child named by ``level``.

    Children go by supply per weight. Each is used up as long as its supply is no more than its
    share of what those before leave; from the first that is not, all share by weight.
    """
    children = rows.groupBy(*parents, level).agg(F.sum("_supply").alias("_own"), F.max("budget").alias("_given"))
    children = children.withColumn("_weight", weight)
    node = Window.partitionBy(*parents)
    ratio = F.try_divide(F.col("_own").cast("double"), F.col("_weight").cast("double"))
    order = node.orderBy(ratio.asc_nulls_first(), level)
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    placed = children.select(
        "*",
        (F.col("_given") - F.coalesce(F.sum("_own").over(earlier), F.lit(0))).alias("_left"),
        F.sum("_weight").over(onward).alias("_weights"),
        F.row_number().over(order).alias("_place"),
    )
    full = F.col("_own").cast(_AMOUNT) * F.col("_weights").cast(_AMOUNT) <= F.col("_weight").cast(_AMOUNT) * F.col("_left").cast(_AMOUNT)
    first = F.min(F.when(~full, F.struct("_place", "_left", "_weights"))).over(node)
    placed = placed.withColumn("_first", first)
    part = F.expr(f"cast(_weight as {_AMOUNT}) * cast(_first._left as {_AMOUNT}) div _first._weights")
    got = F.when(F.col("_first").isNull() | (F.col("_place") < F.col("_first._place")), F.col("_own")).otherwise(part)
    return rows.drop("budget").join(placed.select(*parents, level, got.cast("bigint").alias("budget")), [*parents, level])


def mix(documents: DataFrame, mixture: Mixture, key: str = "doc_id", text: str = "text", keep_text: bool = True) -> DataFrame:
    """The chosen documents, once per epoch in which they are chosen, with ``domain, tokens, epoch``."""
    columns = [c for c in documents.columns if c not in RESULTS and (keep_text or c != text)]
    lang, source = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("lang", "source"))
    rows = documents.select(
        F.struct(*columns).alias("_row"),
        F.col(key).alias("_key"),
        _named(source, mixture.domains, "other").alias("domain"),
        lang.alias("lang"),
        source.alias("source"),
        token_count(text).alias("tokens"),
        F.xxhash64(*documents.columns).alias("_tie"),
    )
    leaves = materialize(rows.groupBy(*LEAF).agg(F.sum("tokens").alias("tokens")), "leaves")
    shares = materialize(budgets(leaves, mixture).withColumnRenamed("tokens", "_of"), "budgets")

    # Epochs that fit, and the one after them of which a prefix fits.
    fit = F.expr("case when not open then 0L when _of = 0 then 1L else budget div _of end")
    last = F.least(fit, F.lit(mixture.max_epochs - 1)).cast("int")
    epochs = (
        rows.join(shares, list(LEAF))
        .withColumn("_whole", F.least(fit, F.lit(mixture.max_epochs)).cast("int"))
        .withColumn("epoch", F.explode(F.sequence(F.lit(0), last)))
        .withColumn("_rest", F.col("budget") - F.col("epoch") * F.col("_of"))
    )
    results = ["_row", "domain", "tokens", "epoch"]
    whole = epochs.filter("epoch < _whole").select(*results)
    cut = epochs.filter("epoch >= _whole and _rest > 0").withColumn(
        "_draw", draw(F.concat(F.col("epoch").cast("string"), F.lit(":"), F.coalesce(F.col("_key").cast("string"), F.lit("null"))), mixture.seed)
    )
    cut = cut.withColumn("_bucket", bucket_of(F.col("_draw")))
    sums = cut.groupBy(*LEAF, "_bucket").agg(F.sum("tokens").alias("_sum"))
    sums = materialize(sums.select(*LEAF, "_bucket", before("_sum", *LEAF, order="_bucket").alias("_before")), "buckets")
    so_far = F.sum("tokens").over(
        Window.partitionBy(*LEAF, "_bucket").orderBy("_draw", "_tie").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    prefix = (
        cut.join(sums, [*LEAF, "_bucket"])
        .withColumn("_so_far", F.col("_before") + so_far)
        .filter("_so_far <= _rest")
        .select(*results)
    )
    return whole.union(prefix).select("_row.*", "domain", "tokens", "epoch")
