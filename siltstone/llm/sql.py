"""SQL twins of the operators' queries, for another engine to run on the same tables."""

from siltstone.llm import decontaminate, quality, secret_scan

#: Fixed values of the contracts, spelt out so that no letter beyond ASCII folds.
_ASSIGN = (
    "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    "[\"'']?\\x20*[:=]\\x20*[\"'']?([A-Za-z0-9+/_.=-]+)"
)
_ACCESS, _HEX, _MIXED = "AKIA[A-Z0-9]{12,}", "[0-9a-f]{32,}", "[A-Za-z0-9+/_-]{24,}"
_WORD = r"[^\x20\x09-\x0D]+"


def _matches(kind: int, pattern: str, group: int, keep: str) -> str:
    """Rows (id, start, kind, stop, value) of one kind."""
    return f"""
  select id, b as start, {kind} as kind, b + length(m) as stop, v as value from (
    select id, found[i] as m, regexp_extract(found[i], '{pattern}', {group}) as v,
      list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(found[1:i - 1], lambda x: length(x))), 0) as b
    from (
      select id, regexp_extract_all(body, '{pattern}') as found, regexp_split_to_array(body, '{pattern}') as gaps,
        unnest(range(1, len(regexp_extract_all(body, '{pattern}')) + 1)) as i
      from docs
    )
  ) where {keep}"""


_CLASSES = " and ".join(f"regexp_matches(v, '{c}')" for c in ("[A-Z]", "[a-z]", "[0-9]"))
_NAMES = "['" + "','".join(secret_scan.KINDS) + "']"

SECRETS = f"""
with docs as (
  select doc_id as id, coalesce(text, '') as body, coalesce(source, '') as owner,
    coalesce(source, '') || '/' || coalesce(lang, '') as repository from documents
), base as ({_matches(0, _ASSIGN, 2, f"length(v) >= {secret_scan.ASSIGN_LEAST}")}
  union all {_matches(1, _ACCESS, 0, "true")}
  union all {_matches(2, _HEX, 0, "true")}
), clear as (
  select * from ({_matches(3, _MIXED, 0, _CLASSES)}) m
  where not exists (select 1 from base b where b.id = m.id and b.start < m.stop and m.start < b.stop)
), spans as (
  select s.*, d.owner, d.repository from (select * from base union all select * from clear) s join docs d using (id)
), spread as (
  select value, count(distinct owner) as owners, count(distinct repository) as repositories from spans group by value
), judged as (
  select *, not (owners >= {secret_scan.COPIED_OWNERS} or owners > 1 and repositories >= {secret_scan.COPIED_REPOSITORIES}) as live from spans join spread using (value)
), stays as (
  select *, {_NAMES}[kind + 1] || ':' || start || ':' || stop as name from judged where kind < {secret_scan.BASE} or live
)
select d.id as doc_id,
  count(*) filter (where kind = 0) as n_assign, count(*) filter (where kind = 1) as n_access,
  count(*) filter (where kind = 2) as n_hex, count(*) filter (where kind = 3) as n_mixed,
  sha256(coalesce(string_agg(name, ',' order by start, kind) filter (where kind < {secret_scan.BASE}), '')) as base_sha256,
  coalesce(string_agg(name, ',' order by start, kind), '') as spans,
  count(*) filter (where live) as n_live
from docs d left join stays s on s.id = d.id group by d.id
"""

_SIZE = decontaminate.SHINGLE_WORDS


def _words(key: str, table: str) -> str:
    return f"select {key}, regexp_extract_all(lower(coalesce(text, '')), '{_WORD}') as w from {table}"


def _shingles(key: str, table: str) -> str:
    return f"""
  select distinct {key}, array_to_string(w[i:i + {_SIZE - 1}], ' ') as shingle from (
    select {key}, w, unnest(range(1, greatest(len(w) - {_SIZE - 2}, 2))) as i from {table} where len(w) > 0
  )"""


CONTAMINATED = f"""
with dw as ({_words("doc_id", "documents")}
), bw as ({_words("item_id", "benchmark")}
), short as (select distinct len(w) as n from bw where len(w) between 1 and {_SIZE - 1}
), d as ({_shingles("doc_id", "dw")}
  union
  select doc_id, array_to_string(w[i:i + n - 1], ' ') from (
    select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i from dw, short where len(w) >= n
  )
), b as ({_shingles("item_id", "bw")}
), sizes as (select item_id, count(*) as n_shingles from b group by item_id)
select doc_id, item_id, any_value(n_shingles) as n_shingles, count(*) as n_shared, count(*) / any_value(n_shingles) as containment
from d join b using (shingle) join sizes using (item_id)
group by doc_id, item_id having count(*) / any_value(n_shingles) >= {decontaminate.LEAST_CONTAINMENT}
"""

_W = quality.REPEAT_WINDOW


def _edge(bucket: str, upper: bool) -> str:
    shift = f"greatest({bucket} // 32 - 1, 0)"
    head = f"({bucket} - {shift} * 32 + {int(upper)})"
    return f"(({head})::bigint << {shift}::int) - {int(upper)}"


def _sql_value(value: str) -> str:
    return value.replace(" div ", " // ")


_SOME = "(" + ", ".join(f"'{m.name}'" for m in quality.MEASURES if m.some) + ")"


def _level(name: str, groups: str) -> str:
    keys = f"{groups}measure"
    return f"""{name} as (
  select {keys}, max(total) as n_rows, max(valued) as n_values,
    min(bucket) filter (where w > 0 and 4 * below >= valued) as q1, min(bucket) filter (where w > 0 and 4 * below >= 3 * valued) as q3
  from (
    select {keys}, bucket, w, sum(w) over (partition by {keys} order by bucket) as below,
      sum(w) over (partition by {keys}) as valued, sum(n) over (partition by {keys}) as total
    from (select {keys}, bucket, sum(n) as n, sum(case when bucket > 0 or measure not in {_SOME} then n else 0 end) as w from sketch group by all)
  ) group by all
)"""


def _fence(m: quality.Measure) -> str:
    low, high = _edge("q1", False), _edge("q3", True)
    reach = f"{quality.REACH_SOME if m.some else quality.REACH} * greatest({high} - {low}, {m.least_spread})"
    fence = f"{high} + {reach}" if m.upper else f"{low} - {reach}"
    rare = f"when n_values > 0 and {quality.RARE} * n_values <= n_rows then greatest(({low}) // 2, {quality.LEAST_RARE})" if m.rare else ""
    return f"case {rare} when n_values >= {quality.LEAST_VALUES} then {fence} end"


_VALUES = ", ".join(f"{{'measure': '{m.name}', 'v': {_sql_value(m.value)}}}" for m in quality.MEASURES)
_FENCE = "case measure " + " ".join(f"when '{m.name}' then {_fence(m)}" for m in quality.MEASURES) + " end"
_FIXED = "case measure " + " ".join(f"when '{m.name}' then {m.fixed}" for m in quality.MEASURES if m.fixed is not None) + " end"
_OUTLIER = "case measure " + " ".join(
    f"when '{m.name}' then v {'>' if m.upper else '<'} fence" for m in quality.MEASURES
) + " end"

_FAILED = f"n_words < {quality.LEAST_WORDS} or 100 * n_repeat_words > {quality.MOST_REPEATED_PERCENT} * n_words"

QUALITY = f"""
with texts as (
  select doc_id, coalesce(lang, '') as lang, coalesce(source, '') as source, coalesce(text, '') as t,
    regexp_extract_all(coalesce(text, ''), '{_WORD}') as w
  from documents
), windows as (
  select doc_id, i, array_to_string(w[i:i + {_W - 1}], ' ') as win
  from (select doc_id, w, unnest(range(1, greatest(len(w) - {_W - 2}, 1))) as i from texts)
), covered as (
  select doc_id, count(distinct i + k) as n_repeat_words
  from (select doc_id, i, count(*) over (partition by doc_id, win) as times from windows), range({_W}) r(k)
  where times > 1 group by doc_id
), lines as (
  select doc_id, count(*) as n_lines, count(*) - count(distinct line) as n_dup_lines
  from (select doc_id, unnest(string_split(t, chr(10))) as line from texts)
  where regexp_matches(line, '{_WORD}') group by doc_id
), counts as (
  select doc_id, lang, source, len(w)::bigint as n_words, length(array_to_string(w, ''))::bigint as word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols, coalesce(n_lines, 0)::bigint as n_lines,
    coalesce(n_dup_lines, 0)::bigint as n_dup_lines, coalesce(n_repeat_words, 0)::bigint as n_repeat_words
  from texts left join lines using (doc_id) left join covered using (doc_id)
), valued as (
  select doc_id, lang, source, u.measure, u.v, greatest(length(bin(u.v)) - 6, 0) as shift
  from (select doc_id, lang, source, unnest([{_VALUES}]) as u from counts)
), sketch as (
  select lang, source, measure, (shift * 32 + (v >> shift::int)) as bucket, count(*) as n from valued
  join counts using (doc_id, lang, source) where not ({_FAILED}) group by all
), {_level("by_source", "lang, source, ")}, {_level("by_lang", "lang, ")}, {_level("overall", "")}, fences as (
  select g.lang, g.source, g.measure, coalesce(s.fence, l.fence, o.fence, {_FIXED.replace("measure", "g.measure")}) as fence
  from (select distinct lang, source, measure from valued) g
  left join (select *, {_FENCE} as fence from by_source where n_rows >= {quality.LEAST_ROWS}) s
    on s.lang = g.lang and s.source = g.source and s.measure = g.measure
  left join (select *, {_FENCE} as fence from by_lang where n_rows >= {quality.LEAST_ROWS}) l on l.lang = g.lang and l.measure = g.measure
  left join (select *, {_FENCE} as fence from overall) o on o.measure = g.measure
), beyond as (
  select doc_id, bool_or(coalesce({_OUTLIER}, false)) as outlier from valued join fences using (lang, source, measure) group by doc_id
), judged as (
  select *, ({_FAILED}) as base_failed
  from counts join beyond using (doc_id)
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, outlier,
  (not base_failed and not outlier) as kept
from judged
"""

FILL_IN_MIDDLE = """
with docs as (
  select doc_id, coalesce(text, '') as t, sha256('1:' || doc_id) as h from documents
), numbered as (
  select doc_id, t, length(t) as n, ('0x' || h[1:8])::bigint as h1, ('0x' || h[9:16])::bigint as h2,
    ('0x' || h[17:24])::bigint as h3, ('0x' || h[25:32])::bigint as h4 from docs
), formed as (
  select doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
    case when n = 0 or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h3 % 100 >= 90 then 'plain'
      when h4 % 100 < 20 then 'spm' else 'psm' end as form from numbered
), cut as (
  select *, substr(t, 1, a) as p, substr(t, a + 1, b - a) as m, substr(t, b + 1) as s from formed
)
select doc_id, n, form, case when form <> 'plain' then a end as prefix_chars, case when form <> 'plain' then b - a end as middle_chars,
  sha256(case form when 'plain' then t when 'spm' then '<S>' || s || '<P>' || p || '<M>' || m
    else '<P>' || p || '<S>' || s || '<M>' || m end) as output_sha256,
  sha256(t) as restored_sha256
from cut
"""

HARD_NEGATIVES = """
with usable as (
  select vec_id as id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: floor(256 * x::double)) as v
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select a.id as anchor_id, b.id, a.label = b.label as same, list_inner_product(a.v, b.v)::bigint as score
  from usable a join usable b on a.id % 100 = 0 and a.id <> b.id
), best as (
  select anchor_id, id as positive_id, score as positive_score from scored where same
  qualify row_number() over (partition by anchor_id order by score desc, id) <= 5
)
select anchor_id, positive_id,
  (row_number() over (partition by anchor_id, positive_id order by s.score desc, s.id))::integer as rank,
  s.id as negative_id, positive_score, s.score as negative_score
from best join scored s using (anchor_id)
where not s.same and 30 * positive_score <= 100 * s.score and 100 * s.score <= 90 * positive_score
qualify rank <= 10
"""

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

NEAR_COPIES = f"""
with recursive cut as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '{_WORD}') as w from documents
), sets as (
  select doc_id, case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
    else list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) end as s from cut
), named as (
  select doc_id, s, len(s) as n, md5(array_to_string(list_sort(s), chr(10))) as d from sets
), nodes as (
  select d, any_value(s) as s, any_value(n) as n, min(doc_id) as least from named where n > 0 group by d
), held as (
  select d, n, unnest(s) as shingle from nodes
), links as (
  select a.d as a, b.d as b from held a join held b on a.shingle = b.shingle and a.d <> b.d
  group by a.d, b.d having 100 * count(*) >= 85 * (any_value(a.n) + any_value(b.n) - count(*))
), reach as (
  select d, d as r from nodes
  union
  select links.b as d, reach.r from reach join links on links.a = reach.d
), rooted as (
  select reach.d, min(nodes.least) as component_id from reach join nodes on nodes.d = reach.r group by reach.d
)
select doc_id, n as n_shingles, coalesce(component_id, doc_id) as component_id, coalesce(component_id, doc_id) = doc_id as kept
from named left join rooted on rooted.d = named.d
"""
