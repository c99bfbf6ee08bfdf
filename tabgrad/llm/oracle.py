"""DuckDB SQL of the registered queries that SQL can express."""

from __future__ import annotations

from tabgrad.llm.queries import MIXTURE, N_SHARDS, PROBE


def _case(column: str, values: dict, otherwise: str) -> str:
    """A CASE over names; text results come quoted."""
    arms = "".join(f" when '{k}' then {repr(v)}" for k, v in values.items())
    return f"case {column}{arms} else {otherwise} end" if values else otherwise


def _share(n: int, parents: list[str], level: str, weight: str) -> str:
    """Common table expressions that bring the budget of level ``n`` down to the next."""
    node = "partition by " + (", ".join(parents) or "1")
    order = f"{node} order by case when w = 0 then null else cast(own as double) / cast(w as double) end nulls first, {level}"
    keys = ", ".join([*parents, level])
    return f"""
children{n} as (
    select {keys}, sum(supply) as own, max(budget) as given, cast({weight} as hugeint) as w
    from rows{n} group by {keys}
), placed{n} as (
    select *, given - coalesce(sum(own) over ({order} rows between unbounded preceding and 1 preceding), 0) as rest,
        sum(w) over ({order} rows between current row and unbounded following) as ws,
        row_number() over ({order}) as place
    from children{n}
), first{n} as (
    select *, min(case when own * ws > w * rest then place end) over ({node}) as cut from placed{n}
), shares{n} as (
    select {keys}, case when cut is null or place < cut then own else w * max(case when place = cut then rest end) over ({node})
        // max(case when place = cut then ws end) over ({node}) end as got
    from first{n}
), rows{n + 1} as (
    select r.* replace (s.got as budget) from rows{n} r join shares{n} s using ({keys})
)"""


_WEIGHTS = {
    "domain": _case("domain", MIXTURE.domain_weights, "1"),
    "lang": _case("lang", MIXTURE.lang_weights, "1"),
    "source": _case("source", MIXTURE.source_weights, "1"),
}

_MIXING = rf"""
with docs as (
    select doc_id, coalesce(lang, '') as lang, coalesce(source, '') as source,
        {_case("source", MIXTURE.domains, "'other'")} as domain,
        cast(len(regexp_extract_all(coalesce(text, ''), '[^ 	-
]+')) as bigint) as tokens
    from documents
), leaves as (
    select domain, lang, source, cast(sum(tokens) as hugeint) as of_, {" * ".join(f"({w})" for w in _WEIGHTS.values())} <> 0 as open
    from docs group by all
), rows0 as (
    select *, case when open then of_ * {MIXTURE.max_epochs} else 0 end as supply,
        (sum(of_) over () * {MIXTURE.budget_percent}) // 100 as budget
    from leaves
), {", ".join(_share(n, ["domain", "lang"][:n], level, weight).strip() for n, (level, weight) in enumerate(_WEIGHTS.items()))},
ordered as (
    select d.*, e.epoch, r.budget - e.epoch * r.of_ as rest, r.of_, r.open,
        sum(d.tokens) over (partition by d.domain, d.lang, d.source, e.epoch
            order by md5('{MIXTURE.seed}:' || e.epoch || ':' || d.doc_id) rows unbounded preceding) as so_far
    from docs d join rows3 r using (domain, lang, source)
        cross join (select cast(range as int) as epoch from range({MIXTURE.max_epochs})) e
)
select doc_id, domain, lang, source, tokens, epoch from ordered
where open and (of_ > 0 and rest >= of_ or of_ > 0 and rest > 0 and so_far <= rest or of_ = 0 and epoch = 0)
"""

# Case-insensitive for ASCII letters only; the pieces between matches give the places of the matches.
_ASSIGN = (
    r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|"""
    r"""[aA][pP][iI]_?[kK][eE][yY])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
)
_RULES = (
    ("assign", _ASSIGN, 2, 12),
    ("access", "AKIA[A-Z0-9]+", 0, 18),
    ("hex", "[0-9a-f]{16,}", 0, 16),
    ("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1),
    ("jwt", r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 30),
)


def _spans(place: int, kind: str, pattern: str, group: int, least: int) -> str:
    total = "coalesce(list_sum(list_transform({0}, lambda x: length(x))), 0)"
    return f"""
select doc_id, '{kind}' as kind, {place} as place, s, s + length(m[i]) as e
from (select *, {total.format("pieces[1:i]")} + {total.format("m[1:i - 1]")} as s
      from (select *, unnest(range(1, len(m) + 1)) as i
            from (select doc_id, regexp_extract_all(text, '{pattern}') as m, regexp_extract_all(text, '{pattern}', {group}) as g,
                      string_split_regex(text, '{pattern}') as pieces from docs)))
where length(g[i]) >= {least}"""


_SECRETS = f"""
with docs as (select doc_id, coalesce(text, '') as text from documents),
found as materialized ({" union all ".join(_spans(n, *rule) for n, rule in enumerate(_RULES))}),
named as (select *, kind || ':' || cast(s as bigint) || ':' || cast(e as bigint) as span from found)
select d.doc_id, count(*) filter (kind = 'assign') as n_assign, count(*) filter (kind = 'access') as n_access,
    count(*) filter (kind = 'hex') as n_hex,
    sha256(coalesce(string_agg(span, ',' order by s, place) filter (place < 3), '')) as base_sha256,
    coalesce(string_agg(span, ',' order by s, place), '') as spans
from docs d left join named n on n.doc_id = d.doc_id group by d.doc_id
"""

_CRC_TABLE = """crc as (
    select list(c order by i) as t from (
        select i, list_reduce(list_prepend(i, range(8)),
            lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) as c
        from range(256) r(i))
)"""


def _crc(text: str) -> str:
    """Unsigned checksum of a text, where the table ``t`` of ``crc`` is at hand."""
    return f"""xor(list_reduce(list_prepend(cast(4294967295 as bigint),
                list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda h: cast('0x' || h as bigint))),
            lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1])), 4294967295)"""


_SHARDING = f"""
with {_CRC_TABLE}, drawn as (
    select doc_id, coalesce(source, '') as source, octet_length(encode(coalesce(text, ''))) + 8 as size,
        md5('42:' || coalesce(cast(doc_id as varchar), 'null')) as d,
        {_crc("coalesce(text, '')")} as text_crc32
    from documents, crc
), ranked as (
    select *, (row_number() over (partition by source order by d, doc_id) - 0.5::double) / count(*) over (partition by source) as share
    from drawn
), placed as (
    select *, row_number() over (order by share, source, d, doc_id) - 1 as p, count(*) over () as n from ranked
)
select doc_id, cast(size as bigint) as size, cast(text_crc32 as bigint) as text_crc32, 'rows' as law,
    cast(p * {N_SHARDS} // n as int) as shard,
    cast(p - ((p * {N_SHARDS} // n) * n + {N_SHARDS - 1}) // {N_SHARDS} as bigint) as slot, cast(null as int) as grown_shard
from placed
"""

_REPEATS = """
with docs as materialized (
    select doc_id, hex(encode(coalesce(text, ''))) as h, octet_length(encode(coalesce(text, ''))) as n from documents
), starts as materialized (
    select doc_id, s, md5_number(substr(h, 2 * s + 1, 800)) as g
    from (select doc_id, h, unnest(range(0, n - 399)) as s from docs where n >= 400)
), repeated as (
    select g from starts group by g having count(*) > 1
), marked as (
    select doc_id, s, lag(s) over (partition by doc_id order by s) as p from starts semi join repeated using (g)
), runs as (
    select doc_id, s, sum(case when p is null or s > p + 400 then 1 else 0 end) over (partition by doc_id order by s) as run from marked
), spans as (
    select doc_id, run, min(s) as b, max(s) + 400 as e from runs group by doc_id, run
), gaps as (
    select doc_id, b, e, coalesce(lag(e) over (partition by doc_id order by b), 0) as k from spans
), kept as (
    select g.doc_id, count(*) as n_spans, sum(e - b) as n_removed, max(e) as last,
        string_agg(substr(h, 2 * k + 1, 2 * (b - k)), '' order by b) as head
    from gaps g join docs d on d.doc_id = g.doc_id group by g.doc_id
)
select d.doc_id, cast(n as bigint) as n_bytes, cast(coalesce(n_removed, 0) as bigint) as n_removed, coalesce(n_spans, 0) as n_spans,
    sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(last, 0) + 1))) as kept_sha256
from docs d left join kept k on k.doc_id = d.doc_id
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_CONTAMINATION = f"""
with words as materialized (
    select 'd' as side, doc_id as id, {_WORDS} as w from documents union all select 'b', item_id, {_WORDS} from benchmark
), item_windows as materialized (
    select distinct id as item_id, n, array_to_string(w[i:i + n - 1], ' ') as window_text
    from (select id, w, least(10, len(w)) as n, unnest(range(1, len(w) - least(10, len(w)) + 2)) as i
          from words where side = 'b' and len(w) > 0)
), lengths as (
    select distinct n from item_windows
), doc_windows as (
    select id as doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') as window_text
    from (select id, w, n, unnest(range(1, len(w) - n + 2)) as i from words join lengths on side = 'd' and len(w) >= n)
), found as materialized (
    select d.doc_id, d.n, d.i, b.item_id from doc_windows d join item_windows b on d.n = b.n and d.window_text = b.window_text
), hit as (
    select doc_id, count(distinct place) as n_hit
    from (select doc_id, unnest(range(i, i + n)) as place from found) group by doc_id
), items as (
    select doc_id, count(*) as n_items, string_agg(name, ',' order by name) as listed
    from (select distinct doc_id, cast(item_id as varchar) as name from found where item_id is not null) group by doc_id
)
select w.id as doc_id, cast(len(w.w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
    sha256(coalesce(listed, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from words w left join hit on hit.doc_id = w.id left join items on items.doc_id = w.id where side = 'd'
"""

_NEGATIVES = """
with rows as (
    select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
        list_transform(embedding, lambda x: floor(256 * cast(x as double))) as v
    from embeddings
    where vec_id is not null and label is not null and embedding is not null
        and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
    select a.vec_id as anchor_id, r.vec_id, a.label = r.label as same, cast(list_inner_product(a.v, r.v) as bigint) as score
    from rows a join rows r on a.vec_id % 100 = 0 and a.vec_id <> r.vec_id
), positives as (
    select anchor_id, vec_id as positive_id, score as positive_score from scored where same
    qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5
)
select anchor_id, positive_id,
    cast(row_number() over (partition by anchor_id, positive_id order by score desc, vec_id) as int) as rank,
    vec_id as negative_id, positive_score, score as negative_score
from positives join scored using (anchor_id)
where not same and 30 * positive_score <= 100 * score and 100 * score <= 90 * positive_score
qualify rank <= 10
"""

_EXACT = """
select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
    doc_id is not distinct from max(doc_id) over same as kept, sha256(coalesce(text, '')) as text_sha256
from documents window same as (partition by coalesce(text, ''))
"""

_SPELLING = f"""
with recursive {_CRC_TABLE}, runs as materialized (
    select doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run, count(*) as n
    from (select doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) as run from documents) group by all
), hashed as materialized (
    select run, n, {_crc("coalesce(cast(doc_id as varchar), '') || ':' || run")} as h from runs, crc where length(run) >= 7
), slips as (
    select case when h % 31 = 0 then substr(run, 1, cast(h % length(run) as int)) || substr(run, cast(h % length(run) as int) + 2) else run end as word,
        n as times
    from hashed
), words as materialized (
    select word, cast(sum(times) as bigint) as n from slips where length(word) >= 7 group by word having sum(times) >= 2
), shorter as materialized (
    select distinct word, i, substr(word, 1, cast(i as int) - 1) || substr(word, cast(i as int) + 1) as s
    from words, unnest(range(1, length(word) + 1)) r(i)
), pairs as materialized (
    select a.word, b.word as near from shorter a join shorter b on a.s = b.s and a.i = b.i and a.word <> b.word
    union select s.word, w.word from shorter s join words w on w.word = s.s
    union select w.word, s.word from shorter s join words w on w.word = s.s
), nearest as (
    select p.word, count(*) as n_near, max(m.n) as most, arg_min(p.near, (-m.n, p.near)) as best
    from pairs p join words m on m.word = p.near group by p.word
), formed as materialized (
    select w.word, w.n, coalesce(n_near, 0) as n_near, case when most >= 10 * w.n then best end as form,
        case when most >= 10 * w.n then most end as form_n
    from words w left join nearest using (word)
), chains as (
    select word, word as root, form as next from formed
    union all select c.word, f.word, f.form from chains c join formed f on f.word = c.next
)
select word, form, root, n, n_near, form_n from formed join (select word, root from chains where next is null) using (word)
"""

ORACLE = {
    "op1_chat_formatting": rf"""
with turns as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all values (-1, 0, 'user', '{PROBE}'), (-1, 1, 'assistant', '{PROBE}')
), said as (
    select *, role = 'assistant' as trained,
        length('<|im_start|>' || role || text || '<|im_end|>') + 2
            + length(text) - length(regexp_replace(text, '<\\*\|', '', 'g'))
            - coalesce(list_sum(list_transform(regexp_extract_all(text, '<\\*\|'), lambda m: length(m) - 1)), 0) as chars
    from turns
)
select conv_id, count(*) as n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
    cast(coalesce(sum(length(text)) filter (trained), 0) as bigint) as loss_chars,
    sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (trained), '')) as loss_sha256,
    cast(sum(chars) as bigint) as formatted_chars
from said group by conv_id
""",
    "op5_exact_top_k": """
with vectors as (
    select vec_id, list_transform(embedding, lambda x: floor(1024 * cast(x as double))) as v
    from embeddings
    where vec_id is not null and embedding is not null
        and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
    select q.vec_id as query_id, c.vec_id, cast(list_inner_product(q.v, c.v) as bigint) as score
    from vectors q join vectors c on q.vec_id % 100 = 0 and q.vec_id <> c.vec_id
), ranked as (
    select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as int) as rank,
        vec_id, score
    from scored
)
select * from ranked where rank <= 10
""",
    "op9_source_mixing": _MIXING,
    "op2_secret_scans": _SECRETS,
    "op3_sharding": _SHARDING,
    "op10_benchmark_decontamination": _CONTAMINATION,
    "op8_suffix_array_dedup": _REPEATS,
    "op11_hard_negative_mining": _NEGATIVES,
    "op12_exact_dedup": _EXACT,
    "op13_spelling_variants": _SPELLING,
}
