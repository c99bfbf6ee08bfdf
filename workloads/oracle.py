"""The same results in plain SQL, written for DuckDB from the definitions rather than from our plans."""

from __future__ import annotations

from tabgrad.functions.seeded import round_keys
from workloads import tables as t

ORACLE: dict[str, str] = {}

PRIME = 2147483647
SEED = 42
LOOKUP_ID = 7


def r6(*columns: str) -> str:
    return ", ".join(f"round({c}, 6) as {c}" for c in columns)


def with_(*ctes: str, select: str) -> str:
    return "with " + ",\n".join(ctes) + "\n" + select


# Base tables

VECTORS = """vectors as (
  select vec_id as sample_id, cast(pos - 1 as int) as idx, cast(embedding[pos] as double) as raw
  from (select vec_id, embedding, unnest(generate_series(1, len(embedding))) as pos from embeddings))"""
X = VECTORS + """,
x as (select sample_id, idx, floor(raw * 1024 + 0.5) / 1024 as value from vectors)"""
TRUTH = "truth as (select vec_id as sample_id, label as true_label from embeddings)"

STATUS = "cast(case o_orderstatus when 'F' then 0 when 'O' then 1 when 'P' then 2 end as int)"
FLAG = "cast(case l_returnflag when 'A' then 0 when 'N' then 1 when 'R' then 2 end as int)"
ORDER_TRUTH = f"truth as (select o_orderkey as sample_id, {STATUS} as true_label from orders)"
ORDER_X = """lines as (
  select l_orderkey as sample_id, sum(l_quantity) as quantity, count(*) as n_lines,
         sum(floor(l_discount * 100 + 0.5)) as discount
  from lineitem group by l_orderkey),
x as (
  select sample_id, 0 as idx, quantity / 1024 as value from lines
  union all select o_orderkey, 1, floor(o_totalprice + 0.5) / 1048576 from orders semi join lines on o_orderkey = sample_id
  union all select sample_id, 2, n_lines / 8.0::double from lines
  union all select sample_id, 3, discount / 128 from lines)"""
LINE_X = f"""numbered as (select row_number() over () as sample_id, * from lineitem),
truth as (select sample_id, {FLAG} as true_label from numbered),
x as (
  select sample_id, 0 as idx, l_quantity / 64 as value from numbered
  union all select sample_id, 1, floor(l_extendedprice + 0.5) / 131072 from numbered
  union all select sample_id, 2, floor(l_discount * 100 + 0.5) / 128 from numbered
  union all select sample_id, 3, floor(l_tax * 100 + 0.5) / 128 from numbered)"""
DOCUMENT_X = """docs as (
  select d.doc_id as sample_id, d.text, d.n_chars, l.quality from documents d join labels l on d.doc_id = l.doc_id),
truth as (select sample_id, quality as true_label from docs),
x as (
  select sample_id, 0 as idx, n_chars / 1024.0::double as value from docs
  union all select sample_id, 1, (length(text) - length(replace(text, ' ', ''))) / 1024.0::double from docs
  union all select sample_id, 2, (length(text) - length(replace(text, chr(10), ''))) / 64.0::double from docs)"""
BASKET_X = """x as (
  select l_orderkey as sample_id, l_partkey as idx, sum(l_quantity) / 64 as value
  from lineitem group by l_orderkey, l_partkey)"""

PROTOTYPES = X + "," + TRUTH + """,
proto_params as (
  select 1 as layer, sample_id as output_idx, cast(idx as bigint) as input_idx, value as w from x
  union all select 2, cast(true_label as bigint), sample_id, 1.0::double from truth),
proto_biases as (
  select 1 as layer, sample_id as output_idx, sum(value * value) / -2 as b from x group by sample_id
  union all select distinct 2, cast(true_label as bigint), 0.0::double from truth)"""


def params(layers, scale: int = 128, tag: str = "") -> str:
    weights, offsets = [], []
    for k, (fan_in, fan_out) in enumerate(zip(layers, layers[1:]), start=1):
        base = f"cast(({k} * 1000003 + o.range * 7919 + i.range * 104729) % 257 - 128 as double) / 128"
        weights.append(
            f"select {k} as layer, cast(o.range as int) as output_idx, cast(i.range as int) as input_idx, "
            f"floor({base} * {scale} + 0.5) / {scale} as w from range({fan_out}) o, range({fan_in}) i"
        )
        offsets.append(
            f"select {k} as layer, cast(range as int) as output_idx, "
            f"cast(({k} * 31 + range * 17) % 33 - 16 as double) / 64 as b from range({fan_out})"
        )
    return (
        f"params{tag} as ({' union all '.join(weights)}),\n"
        f"biases{tag} as ({' union all '.join(offsets)})"
    )


def forward(n_layers: int, x: str = "x", tag: str = "", model: str | None = None) -> str:
    """CTEs z1, a1, ..., logits for rows of ``x``; ``tag`` is appended to their names."""
    model = tag if model is None else model
    ctes, source = [], x
    for k in range(1, n_layers + 1):
        ctes.append(
            f"z{k}{tag} as (select s.sample_id, w.output_idx as idx, sum(s.value * w.w) + b.b as z "
            f"from {source} s join params{model} w on w.layer = {k} and w.input_idx = s.idx "
            f"join biases{model} b on b.layer = {k} and b.output_idx = w.output_idx "
            f"group by s.sample_id, w.output_idx, b.b)"
        )
        ctes.append(
            f"a{k}{tag} as (select sample_id, idx, greatest(z, 0.0) as value, z from z{k}{tag})"
        )
        source = f"a{k}{tag}"
    ctes.append(
        f"logits{tag} as (select sample_id, idx as class_idx, z as logit from z{n_layers}{tag})"
    )
    return ",\n".join(ctes)


def softmax(tag: str = "") -> str:
    return f"""tops{tag} as (select sample_id, max(logit) as top from logits{tag} group by sample_id),
exps{tag} as (select l.sample_id, class_idx, exp(logit - top) as e from logits{tag} l join tops{tag} t on l.sample_id = t.sample_id),
probs{tag} as (select sample_id, class_idx, e / sum(e) over (partition by sample_id) as probability from exps{tag})"""


def best(tag: str = "") -> str:
    return f"""best{tag} as (
  select sample_id, class_idx as prediction, logit as score from (
    select *, row_number() over (partition by sample_id order by logit desc, class_idx) as place from logits{tag})
  where place = 1)"""


def forward_gaps(layers) -> str:
    """``forward`` where what is absent counts as 0.0 and every sample has every neuron."""
    ctes, source = [], "x"
    for k, width in enumerate(layers[1:], start=1):
        ctes.append(
            f"s{k} as (select s.sample_id, w.output_idx, sum(s.value * w.w) as total from {source} s "
            f"join params w on w.layer = {k} and w.input_idx = s.idx group by s.sample_id, w.output_idx)"
        )
        ctes.append(
            f"z{k} as (select i.sample_id, cast(n.range as int) as idx, coalesce(total, 0) + coalesce(b, 0) as z "
            f"from ids i cross join range({width}) n "
            f"left join s{k} s on s.sample_id = i.sample_id and s.output_idx = n.range "
            f"left join biases b on b.layer = {k} and b.output_idx = n.range)"
        )
        ctes.append(f"a{k} as (select sample_id, idx, greatest(z, 0.0) as value, z from z{k})")
        source = f"a{k}"
    ctes.append(f"logits as (select sample_id, idx as class_idx, z as logit from z{len(layers) - 1})")
    return ",\n".join(ctes)


GAPS = f"""{VECTORS},
given as (
  select sample_id, case when (sample_id + idx) % 11 = 0 or sample_id % 50 = 3 then idx + 64 else idx end as idx,
         case when (sample_id + idx) % 13 <> 0 then floor(raw * 1024 + 0.5) / 1024 else 0 end as value
  from vectors where (sample_id * 7 + idx) % 5 <> 0),
x as (select * from given where idx < 64),
ids as (select distinct sample_id from x),
{params(t.VECTOR_LAYERS, tag="_whole")},
params as (select * from params_whole where (output_idx * 3 + input_idx) % 4 <> 0),
biases as (select * from biases_whole where output_idx % 5 <> 1)"""
ORACLE["forward_pass_gaps"] = with_(GAPS, forward_gaps(t.VECTOR_LAYERS), select="select * from logits")

VECTOR_FORWARD = X + ",\n" + params(t.VECTOR_LAYERS) + ",\n" + forward(3)
SMALL_FORWARD = X + ",\n" + params(t.SMALL_LAYERS) + ",\n" + forward(2)
ORDER_FORWARD = ORDER_X + ",\n" + params(t.ORDER_LAYERS) + ",\n" + forward(3)
ORDER_SCORED = ",\n".join(
    [
        ORDER_TRUTH,
        ORDER_FORWARD,
        best(),
        """scored as (
  select t.sample_id, true_label, prediction, score as logit,
         case when prediction = true_label then 1 else 0 end as correct
  from truth t left join best b on t.sample_id = b.sample_id)""",
    ]
)
ORDER_PARITY = ",\n".join(
    [
        ORDER_SCORED,
        params(t.ORDER_LAYERS, 16, "_c"),
        forward(3, tag="_c"),
        best("_c"),
        """parity as (
  select t.sample_id, t.true_label, a.prediction as ours_prediction, a.score as ours_logit,
         b.prediction as theirs_prediction, b.score as theirs_logit,
         case when a.prediction = b.prediction then 1 else 0 end as predictions_match,
         abs(a.score - b.score) as logit_diff,
         case when a.prediction = t.true_label then 1 else 0 end as ours_correct,
         case when b.prediction = t.true_label then 1 else 0 end as theirs_correct
  from truth t left join best a on t.sample_id = a.sample_id left join best_c b on t.sample_id = b.sample_id)""",
    ]
)


def scramble(n: str) -> str:
    mixed = f"(({n}) % {PRIME}) * 48271 % {PRIME}"
    return f"(({mixed}) * ({mixed}) % {PRIME} * 31337 + ({mixed}) * 17 + 11) % {PRIME}"


def order_key(sample_id: str, seed: int, epoch: int = 0) -> str:
    offset = (seed * 40692 + epoch * 69621) % PRIME
    n = f"cast({sample_id} as bigint)"
    return scramble(f"{n} % {PRIME} + ({n} // {PRIME}) % {PRIME} * 16807 + {offset}")


def permuted(n: str, size: str, seed: int, epoch: int = 0) -> str:
    partner = f"((k % {size} - x) % {size} + {size}) % {size}"
    mixed = scramble(f"greatest(x, {partner}) % {PRIME} + k % {PRIME}")
    swap = f"case when ({mixed}) % 8192 >= 4096 then {partner} else x end"
    return f"list_reduce(list_prepend(cast({n} as bigint), {round_keys(seed, epoch)}), lambda x, k: {swap})"


# Scans, encodings, preparation, sinks

ORACLE["scan_features"] = with_(X, select="select sample_id, idx, value from x")
ORACLE["scan_labels"] = "select doc_id as sample_id, cast(quality as int) as true_label from labels"
ORACLE["scan_params"] = with_(
    PROTOTYPES,
    select="select layer, output_idx, input_idx, w as value from proto_params "
    "union all select layer, output_idx, null, b from proto_biases",
)
ORACLE["decode_vector"] = with_(X, select="select sample_id, idx, value from x")
ORACLE["encode_vector"] = with_(
    X,
    select="select sample_id, '[' || string_agg(cast(value * 1024 as varchar), ',' order by idx) || ']' as vector "
    "from x group by sample_id",
)
WHOLE = "string_agg(cast(cast({0} * 1024 as bigint) as varchar), ',' order by {1})"
ORACLE["pixels_to_array"] = with_(
    X, select=f"select sample_id, {WHOLE.format('value', 'idx')} as x from x group by sample_id"
)
ORACLE["explode_weights"] = with_(
    X, select="select 1 as layer, sample_id as output_idx, idx as input_idx, value as w from x"
)
_RUNS = f"""runs as (
  select layer, output_idx, input_idx // 256 as chunk, string_agg(cast(input_idx as varchar), ',' order by input_idx) as inputs,
         {WHOLE.format('w', 'input_idx')} as weights
  from proto_params group by layer, output_idx, input_idx // 256)"""
ORACLE["collect_weights"] = with_(PROTOTYPES, _RUNS, select="select * from runs")
ORACLE["normalize_flatten"] = with_(
    VECTORS,
    select="select sample_id, idx, (raw - cast(0.1307 as double)) / cast(0.3081 as double) as value from vectors",
)
ORACLE["fit_normalizer"] = with_(
    X, select="select round(avg(value), 6) as mean, round(stddev_pop(value), 6) as std from x"
)
ORACLE["extract_labels"] = "select vec_id as sample_id, label as true_label from embeddings"
_RANKED = f"""ids as (select o_orderkey as sample_id, {STATUS} as true_label, {order_key('o_orderkey', SEED)} as k from orders),
total as (select count(*) as n from orders)"""
ORACLE["sample_random"] = with_(
    _RANKED,
    "drawn as (select sample_id, row_number() over (order by k, sample_id) - 1 as place from ids)",
    select="""select sample_id, case when place < n * 5 // 8 then 'train' else 'val' end as split,
  cast(case when place < n * 5 // 8 then place else place - n * 5 // 8 end as bigint) as new_id
from drawn, total where place < n * 5 // 8 + n // 8""",
)
ORACLE["sample_stratified"] = with_(
    _RANKED,
    """drawn as (
  select sample_id, true_label, row_number() over (partition by true_label order by k, sample_id) - 1 as place from ids),
picked as (
  select sample_id, true_label, place, case when place < n // 10 then 'train' else 'val' end as split
  from drawn, total where place < n // 10 + n // 50)""",
    select="select sample_id, split, cast(row_number() over (partition by split order by true_label, place) - 1 as bigint) as new_id from picked",
)
ORACLE["label_distribution"] = (
    "select cast(range as int) as true_label, count(label) as n from range(10) left join embeddings on label = range group by range"
)


def _xavier(layer: int, fan_in: str, fan_out: str) -> str:
    u = scramble(f"o.range * 4099 + i.range * 65537 + {layer * 131} + {SEED * 7}")
    return (
        f"select {layer} as layer, cast(o.range as int) as output_idx, cast(i.range as int) as input_idx, "
        f"round((({u}) / cast({PRIME} as double) * 2 - 1) * sqrt(cast(6 as double) / ({fan_in} + {fan_out})), 6) as w "
        f"from range({fan_out}) o, range({fan_in}) i"
    )


_N_PARTS = "(select count(*) from part)"
ORACLE["xavier_init"] = " union all ".join(
    [_xavier(1, _N_PARTS, "16"), _xavier(2, "16", "8"), _xavier(3, "8", "3")]
)
ORACLE["zero_init"] = (
    "select 1 as layer, cast(range as int) as output_idx, 0.0::double as b from range((select count(*) from embeddings)) "
    "union all select 2, cast(range as int), 0.0::double from range(10)"
)
ORACLE["model_summary"] = with_(
    PROTOTYPES,
    """counted as (
  select layer, 1 as weights, 0 as biases from proto_params
  union all select layer, 0, 1 from proto_biases)""",
    select="""select layer, cast(sum(weights) as bigint) as weights, cast(sum(biases) as bigint) as biases,
  count(*) as parameters from counted group by rollup (layer)""",
)
ORACLE["export_params"] = with_(
    PROTOTYPES,
    _RUNS,
    select="select r.*, b from runs r join proto_biases q on r.layer = q.layer and r.output_idx = q.output_idx",
)
ORACLE["materialize"] = with_(ORDER_FORWARD, select="select * from logits")
ORACLE["replace_params"] = with_(
    PROTOTYPES, select="select layer, output_idx, input_idx, w * 0.75::double * 0.75::double as w, cast(null as double) as b from proto_params "
    "union all select layer, output_idx, null, null, b from proto_biases"
)
_OVERALL = """select count(*) as total_samples, cast(sum(correct) as bigint) as correct_predictions,
  round(avg(correct) * 100, 2) as accuracy_percentage from scored"""
_ORDER_ONLY = ORDER_SCORED.replace("truth as", "order_truth as", 1).replace(
    "from truth t", "from order_truth t"
).replace("\nx as (", "\nox as (").replace("from x s", "from ox s")
ORACLE["tagged_union"] = with_(
    PROTOTYPES,
    _ORDER_ONLY,
    f"overall as ({_OVERALL})",
    select="""select 'weights' as kind, layer, output_idx, input_idx, w, cast(null as double) as b,
  cast(null as bigint) as total_samples, cast(null as bigint) as correct_predictions, cast(null as double) as accuracy_percentage
from proto_params
union all select 'biases', layer, output_idx, null, null, b, null, null, null from proto_biases
union all select 'metrics', null, null, null, null, null, total_samples, correct_predictions, accuracy_percentage from overall""",
)
ORACLE["demux_tagged"] = with_(PROTOTYPES, select="select layer, output_idx, b from proto_biases")
ORACLE["inline_values"] = (
    f"select l_returnflag, {FLAG} as true_label, count(*) as n from lineitem group by l_returnflag"
)
ORACLE["history_sink"] = with_(
    ORDER_PARITY, select="select parity.*, cast(range + 1 as int) as run from parity, range(2)"
)
ORACLE["lookup_sample"] = with_(
    VECTOR_FORWARD, select=f"select * from logits where sample_id = {LOOKUP_ID} order by class_idx"
)

# Forward

ORACLE["dot_product"] = with_(
    X,
    select="select a.sample_id, sum(a.value * b.value) as dot from x a join x b on a.sample_id = b.sample_id and a.idx = 63 - b.idx group by a.sample_id",
)
ORACLE["linear_layer"] = with_(VECTOR_FORWARD, select="select sample_id, idx, z from z1")
ORACLE["relu"] = with_(VECTOR_FORWARD, select="select sample_id, idx, value, z from a1")
ORACLE["linear_relu"] = with_(VECTOR_FORWARD, select="select sample_id, idx, value from a1")
for _name in ("naive", "stable_join", "stable_window"):
    ORACLE[f"softmax_{_name}"] = with_(
        ORDER_FORWARD, softmax(), select=f"select sample_id, class_idx, {r6('probability')} from probs"
    )
ORACLE["argmax_logit"] = with_(VECTOR_FORWARD, best(), select="select * from best")
ORACLE["argmax_prob"] = with_(
    VECTOR_FORWARD,
    softmax(),
    best(),
    select="""select b.sample_id, b.prediction, round(p.probability, 6) as confidence
from best b join probs p on b.sample_id = p.sample_id and b.prediction = p.class_idx""",
)
for _name in ("forward_pass", "forward_pass_relational", "forward_pass_hybrid", "forward_pass_dense"):
    ORACLE[_name] = with_(VECTOR_FORWARD, select="select * from logits")
ORACLE["forward_pass_small"] = with_(SMALL_FORWARD, select="select * from logits")
ORACLE["forward_pass_sparse"] = with_(
    BASKET_X,
    """units as (
  select p_partkey as input_idx, o.range as output_idx,
         cast((o.range * 7919 + p_partkey * 104729 + 1000003) % 257 - 128 as double) / 128 as w
  from part, range(16) o),
hidden as (
  select s.sample_id, cast(u.output_idx as int) as idx,
         greatest(sum(s.value * u.w) + cast((31 + u.output_idx * 17) % 33 - 16 as double) / 64, 0.0) as value
  from x s join units u on s.idx = u.input_idx group by s.sample_id, u.output_idx)""",
    params(t.BASKET_TAIL),
    forward(2, "hidden"),
    select="select * from logits",
)
ORACLE["forward_pass_validation"] = with_(
    ORDER_FORWARD,
    _RANKED,
    "drawn as (select sample_id, row_number() over (order by k, sample_id) - 1 as place from ids)",
    select="select l.* from logits l join drawn d on l.sample_id = d.sample_id, total where d.place >= n - n // 5",
)
ORACLE["predictions"] = with_(
    VECTOR_FORWARD,
    softmax(),
    best(),
    select="""select b.sample_id, b.prediction, b.score as logit, round(p.probability, 6) as probability
from best b left join probs p on b.sample_id = p.sample_id and b.prediction = p.class_idx order by b.sample_id""",
)
ORACLE["layer_outputs"] = with_(
    VECTOR_FORWARD,
    select="select sample_id, 1 as layer, idx, value from a1 union all select sample_id, 2, idx, value from a2",
)

# Backward and update

INTEGER_GRADIENT = ",\n".join(
    [
        VECTOR_FORWARD,
        TRUTH,
        best(),
        """g3 as (
  select l.sample_id, l.class_idx as idx,
         cast(case when l.class_idx = b.prediction then 1 else 0 end
            - case when l.class_idx = t.true_label then 1 else 0 end as double) as g
  from logits l join best b on l.sample_id = b.sample_id join truth t on l.sample_id = t.sample_id),
size as (select count(*) as n from truth),
dw3 as (
  select g.idx as output_idx, a.idx as input_idx, sum(g.g * a.value) / n as grad
  from g3 g join a2 a on g.sample_id = a.sample_id, size group by g.idx, a.idx, n),
db3 as (select idx as output_idx, sum(g) / n as grad from g3, size group by idx, n),
da2 as (
  select g.sample_id, w.input_idx as idx, sum(g.g * w.w) as g
  from g3 g join params w on w.layer = 3 and w.output_idx = g.idx group by g.sample_id, w.input_idx)""",
    ]
)
ORACLE["one_hot"] = with_(
    TRUTH,
    select="select sample_id, cast(range as int) as class_idx, case when range = true_label then 1.0::double else 0.0::double end as target from truth, range(10)",
)
ORACLE["output_gradient"] = with_(
    VECTOR_FORWARD,
    softmax(),
    TRUTH,
    select="""select p.sample_id, p.class_idx as idx,
  round(probability - case when class_idx = true_label then 1 else 0 end, 6) as g
from probs p join truth t on p.sample_id = t.sample_id""",
)
ORACLE["weight_gradient"] = with_(INTEGER_GRADIENT, select="select output_idx, input_idx, grad from dw3")
ORACLE["weight_gradient_sparse"] = with_(
    BASKET_X,
    ORDER_TRUTH,
    select="""select cast(o.range as int) as output_idx, x.idx as input_idx,
  sum(cast((true_label + o.range) % 3 - 1 as double) * value) / (select count(*) from truth) as grad
from truth t join x on t.sample_id = x.sample_id, range(16) o group by o.range, x.idx""",
)
ORACLE["bias_gradient"] = with_(INTEGER_GRADIENT, select="select output_idx, grad from db3")
ORACLE["backprop_linear"] = with_(INTEGER_GRADIENT, select="select sample_id, idx, g from da2")
ORACLE["relu_backward"] = with_(
    INTEGER_GRADIENT,
    select="""select d.sample_id, d.idx, case when a.z > 0 then d.g else 0.0::double end as g
from da2 d join a2 a on d.sample_id = a.sample_id and d.idx = a.idx""",
)
ORACLE["batch_count"] = "select count(*) as n from orders"
ORACLE["update_weights"] = with_(
    INTEGER_GRADIENT,
    select="""select p.output_idx, p.input_idx, p.w - coalesce(d.grad, 0) * cast(0.01 as double) as w
from params p left join dw3 d on p.output_idx = d.output_idx and p.input_idx = d.input_idx where p.layer = 3""",
)
ORACLE["update_biases"] = with_(
    INTEGER_GRADIENT,
    select="""select p.output_idx, p.b - coalesce(d.grad, 0) * cast(0.01 as double) as b
from biases p left join db3 d on p.output_idx = d.output_idx where p.layer = 3""",
)
ORACLE["update_momentum"] = with_(
    INTEGER_GRADIENT,
    """moved as (
  select p.output_idx, p.input_idx, p.w, coalesce(d.grad, 0) as g
  from params p left join dw3 d on p.output_idx = d.output_idx and p.input_idx = d.input_idx where p.layer = 3)""",
    select="""select output_idx, input_idx,
  round(w - g * cast(0.001 as double) - (g * cast(0.9 as double) + g) * cast(0.001 as double), 9) as w,
  round(g * cast(0.9 as double) + g, 9) as velocity from moved""",
)


def step(
    n_layers: int, x: str, truth: str, tag: str = "", model: str | None = None, scored: str | None = None
) -> str:
    """CTEs of one training step over ``x`` and ``truth``: gradients dwK, dbK and one metrics row.

    ``scored`` replaces the CTEs of the forward pass.
    """
    model = tag if model is None else model
    n = n_layers
    ctes = [
        scored or forward(n, x, tag, model),
        softmax(tag),
        f"size{tag} as (select count(*) as n from {truth})",
        f"g{n}{tag} as (select p.sample_id, p.class_idx as idx, probability - case when class_idx = true_label then 1 else 0 end as g "
        f"from probs{tag} p join {truth} t on p.sample_id = t.sample_id)",
    ]
    for k in range(n, 0, -1):
        inputs = x if k == 1 else f"a{k - 1}{tag}"
        ctes.append(
            f"dw{k}{tag} as (select g.idx as output_idx, a.idx as input_idx, sum(g.g * a.value) / n as grad "
            f"from g{k}{tag} g join {inputs} a on g.sample_id = a.sample_id, size{tag} group by g.idx, a.idx, n)"
        )
        ctes.append(
            f"db{k}{tag} as (select idx as output_idx, sum(g) / n as grad from g{k}{tag}, size{tag} group by idx, n)"
        )
        if k > 1:
            ctes.append(
                f"g{k - 1}{tag} as (select d.sample_id, d.idx, case when a.z > 0 then d.g else 0 end as g from ("
                f"select g.sample_id, w.input_idx as idx, sum(g.g * w.w) as g from g{k}{tag} g "
                f"join params{model} w on w.layer = {k} and w.output_idx = g.idx group by g.sample_id, w.input_idx) d "
                f"join a{k - 1}{tag} a on d.sample_id = a.sample_id and d.idx = a.idx)"
            )
    ctes.append(evaluate(truth, tag))
    return ",\n".join(ctes)


def evaluate(truth: str, tag: str) -> str:
    """One row (n, loss, accuracy) from logits and probabilities; ties go to the lowest class."""
    return f"""{best(tag)},
metrics{tag} as (
  select count(*) as n, avg(-ln(greatest(p.probability, 1e-10))) as loss,
         avg(case when b.prediction = t.true_label then 1 else 0 end) as accuracy
  from {truth} t join probs{tag} p on t.sample_id = p.sample_id and p.class_idx = t.true_label
  join best{tag} b on t.sample_id = b.sample_id)"""


def gradient_select(n_layers: int) -> str:
    parts = []
    for k in range(1, n_layers + 1):
        parts.append(
            f"select 'grad_w{k}' as kind, output_idx, input_idx, round(grad, 6) as grad, "
            f"cast(null as double) as loss, cast(null as double) as accuracy from dw{k}"
        )
        parts.append(f"select 'grad_b{k}', output_idx, null, round(grad, 6), null, null from db{k}")
    parts.append("select 'metrics', null, null, null, round(loss, 6), round(accuracy, 6) from metrics")
    return "\nunion all ".join(parts)


def updated_select(n_layers: int, lr: float) -> str:
    parts = []
    for k in range(1, n_layers + 1):
        parts.append(
            f"select 'weights_fc{k}' as kind, p.output_idx, p.input_idx, round(p.w - d.grad * {lr}::double, 6) as w, "
            f"cast(null as double) as bias_value, cast(null as double) as loss, cast(null as double) as accuracy "
            f"from params p join dw{k} d on p.layer = {k} and p.output_idx = d.output_idx and p.input_idx = d.input_idx"
        )
        parts.append(
            f"select 'biases_fc{k}', p.output_idx, null, null, round(p.b - d.grad * {lr}::double, 6), null, null "
            f"from biases p join db{k} d on p.layer = {k} and p.output_idx = d.output_idx"
        )
    parts.append("select 'metrics', null, null, null, null, round(loss, 6), round(accuracy, 6) from metrics")
    return "\nunion all ".join(parts)


ORACLE["train_step_gaps"] = with_(
    GAPS,
    "truth as (select vec_id as sample_id, label as true_label from embeddings semi join ids on vec_id = sample_id)",
    step(3, "x", "truth", scored=forward_gaps(t.VECTOR_LAYERS)),
    select=gradient_select(3),
)
ORACLE["train_step_array"] = with_(
    X, params(t.VECTOR_LAYERS), TRUTH, step(3, "x", "truth"), select=updated_select(3, 0.01)
)
for _name in ("train_step_long", "train_step_relational"):
    ORACLE[_name] = with_(
        X, params(t.VECTOR_LAYERS), TRUTH, step(3, "x", "truth"), select=gradient_select(3)
    )
ORACLE["train_step_sparse"] = with_(
    BASKET_X,
    ORDER_TRUTH.replace("from orders", "from orders where o_orderkey in (select l_orderkey from lineitem)"),
    f"tail_{params(t.BASKET_TAIL).replace(chr(10) + 'biases as', chr(10) + 'tail_biases as')}",
    """params as (
  select 1 as layer, cast(o.range as int) as output_idx, p_partkey as input_idx,
         cast((o.range * 7919 + p_partkey * 104729 + 1000003) % 257 - 128 as double) / 128 as w
  from part, range(16) o
  union all select layer + 1, output_idx, input_idx, w from tail_params),
biases as (
  select 1 as layer, cast(range as int) as output_idx, cast((31 + range * 17) % 33 - 16 as double) / 64 as b from range(16)
  union all select layer + 1, output_idx, b from tail_biases)""",
    step(3, "x", "truth"),
    select=gradient_select(3),
)
ORACLE["train_step_small"] = with_(
    X, params(t.SMALL_LAYERS), TRUTH, step(2, "x", "truth"), select=gradient_select(2)
)

# Batches and training

_NUMBERED = "numbered as (select o_orderkey as sample_id, row_number() over (order by o_orderkey) - 1 as place, (count(*) over () + 3) // 4 as quarter from orders)"
ORACLE["assign_batches"] = with_(
    _NUMBERED, select="select sample_id, place // 32 as batch_num from numbered"
)
ORACLE["select_batch"] = with_(
    _NUMBERED, select="select sample_id from numbered where place // quarter = 1"
)
ORACLE["batch_features"] = with_(
    _NUMBERED,
    ORDER_X,
    select="select x.sample_id, x.idx, x.value from x join numbered n on x.sample_id = n.sample_id where place // quarter = 2",
)
ORACLE["batch_plan"] = (
    "select count(distinct o_orderkey) as n_samples, cast(ceil(count(distinct o_orderkey) / 32.0) as bigint) as n_batches, "
    "count(distinct o_orderkey) - (cast(ceil(count(distinct o_orderkey) / 32.0) as bigint) - 1) * 32 as last_batch_size from orders"
)
ORACLE["shuffle_batches"] = (
    f"select {permuted('range', 'n', SEED, 3)} as position, range as batch_num "
    "from (select (count(*) + 31) // 32 as n from orders) sizes, lateral (select unnest(range(n)) as range)"
)
ORACLE["shuffle_samples"] = (
    f"select o_orderkey as sample_id, cast((row_number() over (order by {order_key('o_orderkey', SEED, 3)}, o_orderkey) - 1) // 32 as bigint) as batch_num from orders"
)


def _training(lr: float, momentum: float, epochs: int, n_batches: int) -> str:
    """The loop unrolled: params_s0 are the start, step s turns params_s{s} into params_s{s+1}."""
    ctes = [
        X,
        TRUTH,
        params(t.SMALL_LAYERS, tag="_s0"),
        f"batches as (select sample_id, (row_number() over (order by sample_id) - 1) // ((count(*) over () + {n_batches - 1}) // {n_batches}) as batch_num from truth)",
    ]
    for b in range(n_batches):
        ctes.append(
            f"x_b{b} as (select x.* from x join batches b on x.sample_id = b.sample_id and batch_num = {b})"
        )
        ctes.append(
            f"truth_b{b} as (select t.* from truth t join batches b on t.sample_id = b.sample_id and batch_num = {b})"
        )
    for s in range(epochs * n_batches):
        b = s % n_batches
        tag, new = f"_s{s}", f"_s{s + 1}"
        ctes.append(step(2, f"x_b{b}", f"truth_b{b}", tag))
        for table, grad, value, keys in (
            ("params", "dw", "w", ("output_idx", "input_idx")),
            ("biases", "db", "b", ("output_idx",)),
        ):
            on = " and ".join(f"p.{k} = d.{k}" for k in keys)
            grads = " union all ".join(f"select {k} as layer, * from {grad}{k}{tag}" for k in (1, 2))
            old = "p.v" if s else "0"
            ctes.append(
                f"{table}{new} as (select p.layer, {', '.join('p.' + k for k in keys)}, "
                f"p.{value} - {lr}::double * ({momentum}::double * {old} + coalesce(d.grad, 0)) as {value}, "
                f"{momentum}::double * {old} + coalesce(d.grad, 0) as v "
                f"from {table}{tag} p left join ({grads}) d on p.layer = d.layer and {on})"
            )
    for epoch in range(1, epochs + 1):
        tag = f"_v{epoch}"
        ctes.append(forward(2, "x", tag, f"_s{epoch * n_batches}"))
        ctes.append(softmax(tag))
        ctes.append(evaluate("truth", tag))
    steps = " union all ".join(
        f"select {s // n_batches + 1} as epoch, * from metrics_s{s}" for s in range(epochs * n_batches)
    )
    checks = " union all ".join(
        f"select {e} as epoch, loss as val_loss, accuracy as val_accuracy from metrics_v{e}"
        for e in range(1, epochs + 1)
    )
    ctes.append(f"steps as ({steps})")
    ctes.append(f"checks as ({checks})")
    ctes.append(
        """epochs as (
  select epoch, avg(loss) as train_loss, avg(accuracy) as train_accuracy,
         sum(loss * n) / sum(n) as weighted_loss, sum(accuracy * n) / sum(n) as weighted_accuracy
  from steps group by epoch),
history as (select e.*, val_loss, val_accuracy from epochs e left join checks c on e.epoch = c.epoch)"""
    )
    return ",\n".join(ctes).replace(" as (", " as materialized (")


_TRAINING = _training(0.125, 0.5, epochs=2, n_batches=2)
_MEASURES = ("train_loss", "train_accuracy", "weighted_loss", "weighted_accuracy")
ORACLE["fit_relational"] = ORACLE["fit_sparse"] = ORACLE["fit_long"] = ORACLE["fit"] = with_(_TRAINING, select=f"select epoch, {r6(*_MEASURES, 'val_loss', 'val_accuracy')} from history")
ORACLE["epoch_metrics"] = with_(_TRAINING, select=f"select epoch, {r6(*_MEASURES)} from epochs")
ORACLE["validate_every"] = with_(
    _TRAINING,
    select=f"select epoch, {r6(*_MEASURES)}, case when epoch % 2 = 0 then round(val_loss, 6) end as val_loss, "
    "case when epoch % 2 = 0 then round(val_accuracy, 6) end as val_accuracy from history",
)
ORACLE["best_epoch"] = with_(
    _TRAINING,
    select="""select epoch, round(val_loss, 6) as val_loss,
  case when val_loss < coalesce(min(val_loss) over (order by epoch rows between unbounded preceding and 1 preceding), 'inf'::double)
       then 1 else 0 end as is_best from history""",
)
ORACLE["history_summary"] = with_(
    _TRAINING,
    select="""select count(*) as epochs, round(min(val_loss), 6) as best_val_loss,
  round(arg_max(train_loss, epoch), 6) as final_train_loss, round(arg_max(train_accuracy, epoch), 6) as final_train_accuracy,
  round(sum(epoch * 0.25::double), 6) as total_time, round(avg(epoch * 0.25::double), 6) as mean_time
from history""",
)

ORACLE["early_stopping"] = with_(
    _training(1.5, 0.9, epochs=6, n_batches=1),
    """marked as (
  select epoch, val_loss,
         val_loss >= min(val_loss) over (order by epoch rows between unbounded preceding and 1 preceding) as worse
  from history)""",
    select="""select epoch, round(val_loss, 6) as val_loss from marked
where epoch <= coalesce((select min(epoch) from marked where worse), 6)""",
)

# Metrics and parity

LOSSES = "losses as (select t.sample_id, -ln(greatest(p.probability, 1e-10)) as loss from probs p join truth t on p.sample_id = t.sample_id and p.class_idx = t.true_label)"
ORACLE["cross_entropy"] = with_(
    VECTOR_FORWARD,
    softmax(),
    TRUTH,
    LOSSES,
    select="select round(avg(loss), 6) as loss, count(*) as batch_size from losses",
)
ORACLE["loss_summary"] = with_(
    ORDER_TRUTH,
    ORDER_FORWARD,
    softmax(),
    LOSSES,
    select="""select count(*) as batch_size, round(avg(loss), 6) as average_loss, round(sum(loss), 6) as total_loss,
  round(min(loss), 6) as min_loss, round(max(loss), 6) as max_loss from losses""",
)
ORACLE["accuracy"] = with_(
    DOCUMENT_X,
    params(t.DOCUMENT_LAYERS),
    forward(2),
    best(),
    select="select avg(case when prediction = true_label then 1 else 0 end) as accuracy from truth t join best b on t.sample_id = b.sample_id",
)
ORACLE["validation_accuracy"] = with_(
    VECTOR_FORWARD,
    softmax(),
    TRUTH,
    best(),
    LOSSES,
    select="""select cast(sum(case when prediction = true_label then 1 else 0 end) as bigint) as correct_count, count(*) as total_count,
  round(avg(case when prediction = true_label then 1 else 0 end), 6) as accuracy, round(avg(loss), 6) as loss
from truth t join best b on t.sample_id = b.sample_id join losses l on t.sample_id = l.sample_id""",
)
ORACLE["validate"] = with_(
    LINE_X,
    params(t.ORDER_LAYERS),
    forward(3),
    softmax(),
    evaluate("truth", ""),
    select=f"select {r6('loss', 'accuracy')} from metrics",
)
ORACLE["score_against_truth"] = with_(ORDER_SCORED, select="select * from scored order by sample_id")
ORACLE["prediction_parity"] = with_(ORDER_PARITY, select="select * from parity")
ORACLE["parity_mismatches"] = with_(
    ORDER_PARITY,
    select="select sample_id, true_label, ours_prediction, theirs_prediction, logit_diff from parity where predictions_match = 0",
)
ORACLE["parity_summary"] = with_(
    ORDER_PARITY,
    select="""select *, total_samples - matches as mismatches,
  case when matches = total_samples and max_logit_diff < 0.01 then 'SUCCESS'
       when matches = total_samples then 'PARTIAL SUCCESS' else 'MISMATCH' end as verdict
from (select count(*) as total_samples, cast(sum(predictions_match) as bigint) as matches,
  round(avg(predictions_match) * 100, 6) as match_rate, round(avg(ours_correct) * 100, 6) as ours_accuracy,
  round(avg(theirs_correct) * 100, 6) as theirs_accuracy, round(avg(logit_diff), 6) as avg_logit_diff,
  round(max(logit_diff), 6) as max_logit_diff from parity)""",
)
_TIER = "case when max_diff < 1e-5 then 'EXCELLENT' when max_diff < 1e-3 then 'GOOD' when max_diff < 1e-2 then 'ACCEPTABLE' else 'DIFFERENT' end as tier, case when max_diff < 0.01 then 1 else 0 end as passed"
ORACLE["logit_parity"] = with_(
    ORDER_FORWARD,
    params(t.ORDER_LAYERS, 16, "_c"),
    forward(3, tag="_c"),
    """diffs as (
  select a.sample_id, max(abs(a.logit - b.logit)) as max_diff
  from logits a join logits_c b on a.sample_id = b.sample_id and a.class_idx = b.class_idx group by a.sample_id)""",
    select=f"select sample_id, max_diff, {_TIER} from diffs union all select null, max_diff, {_TIER} from (select max(max_diff) as max_diff from diffs)",
)
ORACLE["agreement_counts"] = with_(
    ORDER_PARITY,
    select="""select count(*) as total_samples,
  count(*) filter (ours_correct = 1 and theirs_correct = 1) as both_correct,
  count(*) filter (ours_correct = 0 and theirs_correct = 0) as both_wrong,
  count(*) filter (ours_correct <> theirs_correct) as disagree,
  count(*) filter (ours_correct = 1) as ours_correct,
  count(*) filter (theirs_correct = 1) as theirs_correct from parity""",
)

# Reports

ORACLE["table_counts"] = (
    " union all ".join(
        f"select count(*) as count, '{name}' as table_name from {name}"
        for name in (
            "region nation customer supplier part orders lineitem events documents embeddings pages "
            "benchmark labels conversations"
        ).split()
    )
    + " order by table_name"
)
ORACLE["weight_preview"] = """with weights as (
  select vec_id as output_idx,
         '[' || array_to_string(list_transform(embedding, lambda v: cast(floor(cast(v as double) * 128 + 0.5) / 128 as varchar)), ',') || ']' as weights
  from embeddings)
select output_idx, cast(length(weights) as int) as weight_string_length, substring(weights, 1, 50) as weight_preview
from weights order by output_idx limit 5"""
ORACLE["bias_report"] = with_(
    PROTOTYPES,
    select="select output_idx, b as bias_value, abs(b) as abs_value from proto_biases where layer = 1 order by output_idx limit 10",
)
ORACLE["feature_stats"] = with_(
    X,
    select="select sample_id, min(value) as min_value, max(value) as max_value, avg(value) as avg_value from x group by sample_id order by sample_id",
)
ORACLE["logit_stats"] = with_(
    VECTOR_FORWARD,
    select="""select sample_id, count(*) as num_classes, round(min(logit), 4) as min_logit, round(max(logit), 4) as max_logit,
  round(avg(logit), 4) as avg_logit from logits group by sample_id order by sample_id""",
)
ORACLE["sample_logits"] = with_(
    VECTOR_FORWARD,
    select=f"select sample_id, class_idx, round(logit, 4) as logit from logits where sample_id = {LOOKUP_ID} order by class_idx",
)
ORACLE["prediction_report"] = with_(
    ORDER_FORWARD,
    softmax(),
    best(),
    select="""select b.sample_id, b.prediction, round(b.score, 4) as logit, round(p.probability, 4) as probability
from best b join probs p on b.sample_id = p.sample_id and b.prediction = p.class_idx order by b.sample_id""",
)
_ROW = "sample_id, true_label, prediction, round(logit, 4) as logit, correct"
ORACLE["truth_report"] = with_(ORDER_SCORED, select=f"select {_ROW} from scored order by sample_id")
ORACLE["overall_accuracy"] = with_(ORDER_SCORED, select=_OVERALL)
ORACLE["correct_breakdown"] = with_(
    ORDER_SCORED,
    select="select case when correct = 1 then 'Correct' else 'Incorrect' end as result, count(*) as count from scored group by correct",
)
ORACLE["confusion_matrix"] = with_(
    ORDER_SCORED,
    select="select true_label, prediction, count(*) as count from scored where correct = 0 group by all order by all",
)
ORACLE["per_class_accuracy"] = with_(
    ORDER_SCORED,
    select="""select true_label, count(*) as total_samples, cast(sum(correct) as bigint) as correct,
  round(avg(correct) * 100, 2) as accuracy_pct from scored group by true_label order by true_label""",
)
ORACLE["hardest_correct"] = with_(
    ORDER_SCORED,
    select=f"select {_ROW} from scored where correct = 1 order by scored.logit nulls last, sample_id limit 5",
)
ORACLE["confident_wrong"] = with_(
    ORDER_SCORED,
    select=f"select {_ROW} from scored where correct = 0 order by scored.logit desc nulls last, sample_id limit 5",
)
ORACLE["confusion_matrix_lines"] = with_(
    LINE_X,
    params(t.ORDER_LAYERS),
    forward(3),
    best(),
    select="select true_label, prediction, count(*) as count from truth t join best b on t.sample_id = b.sample_id group by all order by all",
)
