"""Forward operators on ``(sample_id, idx, value)`` rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabgrad.functions.arrays import densify, relu_column
from tabgrad.plans.joins import BROADCAST_BYTES, join_spread

PACK_WIDTH = 128  # widest layer computed as one aggregate column per output
_CONSTANT = -2  # position of the input whose weight is the bias


def pack(df: DataFrame, by: str, idx: str, value: str, width: int) -> DataFrame:
    """``(by, ws)`` with ``ws[k]`` the sum of ``value`` where ``idx = k``, NULL where there is none.

    Conditional sums combine map-side, so no group of rows is gathered, however often a key repeats.
    """
    slots = ", ".join(f"sum(if({idx} = {k}, {value}, null))" for k in range(width))
    return df.groupBy(by).agg(F.expr(f"array({slots})").alias("ws"))


def pack_params(params: DataFrame, by: str, idx: str, width: int) -> DataFrame:
    """Weight rows to ``(by, ws)``; a unit has at most ``width`` weights, so they can be gathered."""
    entries = F.collect_list(F.struct(F.col(idx).alias("idx"), F.col("w").alias("value")))
    gathered = params.groupBy(by).agg(entries.alias("_entries"))
    return gathered.select(by, densify(F.col("_entries"), width, fill=None).alias("ws"))


def pack_by_input(params: DataFrame, width: int) -> DataFrame:
    """``(output_idx, input_idx, w)`` to ``(input_idx, ws)``.

    The layout for wide input layers: a row holds ``width`` outputs however many inputs there are.
    """
    return pack_params(params, "input_idx", "output_idx", width)


def weighted_sums(
    rows: DataFrame,
    units: DataFrame,
    key: str,
    by: str,
    width: int,
    unit_rows: int | None = None,
    bounded: bool = False,
    how: str = "inner",
) -> DataFrame:
    """``(by, sums)`` with ``sums[k] = SUM(value * ws[k])`` over ``rows`` joined to ``units`` on ``key``.

    A sum without a product is NULL. With ``how="left"`` rows that meet no unit keep their ``by``.

    Each joined row feeds ``width`` running sums that are combined map-side, instead of ``width``
    rows that are hashed one by one. One shuffle, on ``by``. ``unit_rows`` is the known size of
    ``units``, broadcast when small enough; ``bounded`` says that no key has very many rows.
    """
    if unit_rows is not None and unit_rows * (8 * width + 16) <= BROADCAST_BYTES:
        joined = rows.join(F.broadcast(units), key, how)
    elif bounded:
        joined = rows.join(units, key, how)
    else:
        joined = join_spread(rows, units, key, how, 8 * width + 16)
    sums = ", ".join(f"sum(value * ws[{k}])" for k in range(width))
    return joined.groupBy(by).agg(F.expr(f"array({sums})").alias("sums"))


def linear_packed(
    x: DataFrame,
    units: DataFrame,
    bias: DataFrame,
    width: int,
    n_inputs: int | None = None,
) -> DataFrame:
    """``(sample_id, z array)`` from feature rows and weights packed by input.

    Absent weights and biases and NULL values count as 0.0, and every sample has all ``width``
    neurons. ``n_inputs`` bounds the weight table; without it the join never broadcasts.
    """
    rows = _input_rows(x)
    sums = weighted_sums(rows, units, "input_idx", "sample_id", width, n_inputs, how="left")
    return add_bias(sums, bias, width)


def _input_rows(x: DataFrame) -> DataFrame:
    value = F.coalesce("value", F.lit(0.0)).alias("value")
    return x.select("sample_id", F.col("idx").alias("input_idx"), value)


def add_bias(sums: DataFrame, bias: DataFrame, width: int) -> DataFrame:
    """``(sample_id, sums)`` to ``(sample_id, z)``; the bias vector is one scalar subquery."""
    offsets = bias.agg(
        densify(
            F.collect_list(F.struct(F.col("output_idx").alias("idx"), F.col("b").alias("value"))),
            width,
        ).alias("bs")
    )
    shifted = F.zip_with("sums", "bs", lambda s, b: F.coalesce(s, F.lit(0.0)) + b)
    return sums.withColumn("bs", offsets.scalar()).select("sample_id", shifted.alias("z"))


def linear(
    x: DataFrame,
    params: DataFrame,
    bias: DataFrame,
    width: int | None = None,
    n_inputs: int | None = None,
) -> DataFrame:
    """``z[s, o] = SUM_i x[s, i] * w[o, i] + b[o]`` as ``(sample_id, idx, z)``.

    Absent weights and biases and NULL values count as 0.0. Every sample has a row for every neuron:
    all of ``width``, or those that have a weight or a bias.

    Up to PACK_WIDTH outputs use packed weights. Wider layers, or unknown widths, join one row per
    weight, the bias being the weight of an input that is 1.0 in every sample; the product rows are
    summed map-side before the shuffle.
    """
    if width is not None and width <= PACK_WIDTH:
        packed = linear_packed(x, pack_by_input(params, width), bias, width, n_inputs)
        return packed.select("sample_id", F.posexplode("z").alias("idx", "z"))
    offsets = bias.groupBy("output_idx").agg(F.sum("b").alias("b"))
    if width is None:
        neurons = params.select("output_idx").union(bias.select("output_idx")).distinct()
    else:
        neurons = params.sparkSession.range(width).select(F.col("id").alias("output_idx"))
    constant = F.lit(_CONSTANT).cast("bigint").alias("input_idx")
    biased = neurons.join(offsets, "output_idx", "left").select(
        F.col("output_idx").cast("int").alias("output_idx"), constant, F.coalesce("b", F.lit(0.0)).alias("w")
    )
    weights = params.select("output_idx", "input_idx", "w").unionByName(biased)
    ones = x.select("sample_id").distinct().select("sample_id", constant, F.lit(1.0).alias("value"))
    rows = _input_rows(x).unionByName(ones)
    if width is not None and n_inputs is not None and 24 * width * (n_inputs + 1) <= BROADCAST_BYTES:
        joined = rows.join(F.broadcast(weights), "input_idx")
    else:
        joined = join_spread(rows, weights, "input_idx", "inner", None if width is None else 24 * width)
    sums = joined.groupBy("sample_id", F.col("output_idx").alias("idx"))
    return sums.agg(F.sum(F.col("value") * F.col("w")).alias("z"))


def relu(pre: DataFrame, keep_z: bool = True) -> DataFrame:
    """``(sample_id, idx, value[, z])`` with ``value = max(0, z)``."""
    kept = ["z"] if keep_z else []
    return pre.select("sample_id", "idx", relu_column(F.col("z")).alias("value"), *kept)


def linear_relu(
    x: DataFrame,
    params: DataFrame,
    bias: DataFrame,
    width: int | None = None,
    n_inputs: int | None = None,
    apply_relu: bool = True,
) -> DataFrame:
    """One layer, activation only."""
    pre = linear(x, params, bias, width, n_inputs)
    if apply_relu:
        return relu(pre, keep_z=False)
    return pre.select("sample_id", "idx", F.col("z").alias("value"))


def softmax(logits: DataFrame, method: str = "window") -> DataFrame:
    """``(sample_id, class_idx, probability)``.

    ``window`` shuffles once and suits a bounded class count. ``join`` aggregates per sample before
    joining back, so a sample with very many classes is not gathered in one task. ``naive`` leaves
    out the shift by the largest logit and turns large logits into NaN.
    """
    if method == "window":
        per_sample = Window.partitionBy("sample_id")
        top = logits.withColumn("_top", F.max("logit").over(per_sample))
        exps = top.withColumn("_exp", F.exp(F.col("logit") - F.col("_top")))
        share = F.col("_exp") / F.sum("_exp").over(per_sample)
        return exps.select("sample_id", "class_idx", share.alias("probability"))
    if method == "join":
        tops = logits.groupBy("sample_id").agg(F.max("logit").alias("_top"))
        exps = logits.join(tops, "sample_id").withColumn(
            "_exp", F.exp(F.col("logit") - F.col("_top"))
        )
    elif method == "naive":
        exps = logits.withColumn("_exp", F.exp("logit"))
    else:
        raise ValueError(f"unknown softmax method {method!r}")
    totals = exps.groupBy("sample_id").agg(F.sum("_exp").alias("_total"))
    return exps.join(totals, "sample_id").select(
        "sample_id", "class_idx", (F.col("_exp") / F.col("_total")).alias("probability")
    )


def argmax(scores: DataFrame, score: str, out: str = "score") -> DataFrame:
    """``(sample_id, prediction, score)``: the top class, the lowest class when scores tie."""
    best = F.max(F.struct(F.col(score), (-F.col("class_idx")).alias("_neg"))).alias("_best")
    return scores.groupBy("sample_id").agg(best).select(
        "sample_id",
        (-F.col("_best._neg")).cast("int").alias("prediction"),
        F.col(f"_best.{score}").alias(out),
    )


def predictions(logits: DataFrame) -> DataFrame:
    """``(sample_id, prediction, logit, probability)`` in one shuffle.

    The top logit has shifted value 0, so its probability is 1 / SUM(exp(logit - top)). One array of
    all class logits is built per sample, hence the class count must be bounded.
    """
    best = F.max(F.struct("logit", (-F.col("class_idx")).alias("_neg"))).alias("_best")
    grouped = logits.groupBy("sample_id").agg(best, F.collect_list("logit").alias("_logits"))
    total = F.aggregate(
        F.sort_array("_logits"), F.lit(0.0), lambda acc, z: acc + F.exp(z - F.col("_best.logit"))
    )
    return grouped.select(
        "sample_id",
        (-F.col("_best._neg")).cast("int").alias("prediction"),
        F.col("_best.logit").alias("logit"),
        (F.lit(1.0) / total).alias("probability"),
    )


def lookup_sample(scores: DataFrame, sample_id: int) -> DataFrame:
    """Rows of one sample by class. On a stored table the filter reaches the scan."""
    return scores.filter(F.col("sample_id") == sample_id).orderBy("class_idx")
