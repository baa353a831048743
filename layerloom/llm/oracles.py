"""SQL of the queries that SQL can express."""


def _crc32(data: str) -> str:
    """CRC-32 of a list of bytes, bit by bit."""
    bits = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, i: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end)"
    return f"xor(list_reduce(list_prepend(4294967295::bigint, {data}), lambda c, b: {bits}), 4294967295)"


# Parts of the audit DP: a state is (cost, audit, repaired rows), with a cost beyond all others where it cannot be reached.


def _edited(state: str, letter: str, cost: str, row: str | None = None, allowed: str = "true") -> str:
    rows = f"list_append({state}.rows, {row})" if row else f"{state}.rows"
    return f"{{'cost': {state}.cost + {cost} + case when {allowed} then 0 else 1000000000 end, 'audit': {state}.audit || '{letter}', 'rows': {rows}}}"


def _least(*states: str) -> str:
    return f"list_min([{', '.join(states)}])"


def _inserted(columns: str, source: str) -> str:
    """States before the next row, after insertions: first user, then assistant."""
    user = _least("u", *(_edited(s, "I", "5", "'user:'") for s in "esa"))
    return f"select *, {_least('a', _edited('u1', 'I', '5', chr(39) + 'assistant:' + chr(39)))} as a1 from (select {columns}, e, s, a, {user} as u1 from {source})"


def _steps() -> str:
    stays, more = "not required", "case when truncated then 5 else 0 end"
    keep = lambda state, initial: _edited(state, "K", more, "role || ':' || text", f"{stays} and left(role, 1) = '{initial}'")
    rerole = lambda state, role: _edited(state, "R", f"1 + {more}", f"'{role}:' || text", stays)
    delete = lambda state: _edited(state, "D", "2")
    user = _least(delete("u1"), *(keep(s, "u") for s in ("e", "s", "a1")), *(rerole(s, "user") for s in ("e", "s", "a1")))
    assistant = _least(delete("a1"), keep("u1", "a"), rerole("u1", "assistant"))
    return f"select g, i, {delete('e')} as e, {_least(delete('s'), keep('e', 's'))} as s, {user} as u, {assistant} as a"


_REPAIR = rf"""
with recursive kinds as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
    coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as k from conversations
), hashed as (
  select *, {_crc32("list_transform(range(1, length(k) + 1), lambda j: ascii(k[j])::bigint)")} % 20 as kind from kinds
), damaged as (
  select conv_id, turn, case when kind = 4 then 'user' else role end as role,
    case when kind = 1 then '' when kind = 2 then translate(text, '.!?', '') else text end as text,
    unnest(range(case when kind = 3 then 2 else 1 end)) as copy from hashed where kind <> 0
), numbered as (
  select *, dense_rank() over (order by conv_id nulls first) as g,
    row_number() over (partition by conv_id order by turn nulls first, role, text, copy) as i,
    row_number() over (partition by conv_id, role, text order by turn nulls first, copy) > 1 as again,
    not regexp_matches(text, '[^\x20\x09-\x0D]') as blank, not regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') as open from damaged
), flagged as (
  select *, blank or again as required, again and not blank as duplicate, open and not again and not blank as truncated,
    lag(left(role, 1)) over (partition by g order by i) as previous from numbered
), steps as (
  select g, 0::bigint as i, {{'cost': 0, 'audit': '', 'rows': []::varchar[]}} as e, {{'cost': 1000000000, 'audit': '', 'rows': []::varchar[]}} as s,
    {{'cost': 1000000000, 'audit': '', 'rows': []::varchar[]}} as u, {{'cost': 1000000000, 'audit': '', 'rows': []::varchar[]}} as a
  from (select distinct g from numbered)
  union all
  {_steps()} from ({_inserted("f.g, f.i, f.role, f.text, f.required, f.truncated", "steps p join flagged f on f.g = p.g and f.i = p.i + 1")})
), ends as (
  select g, {_least("e", "a1")} as best from ({_inserted("p.g", "steps p join (select g, max(i) as n from flagged group by g) l on l.g = p.g and l.n = p.i")})
), facts as (
  select conv_id, g, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (blank) as blank,
    count(*) filter (duplicate) as duplicate, count(*) filter (truncated) as truncated,
    count(*) filter (previous is not null and previous || left(role, 1) not in ('su', 'ua', 'au')) as illegal from flagged group by conv_id, g
), found as (
  select conv_id, gaps, blank, duplicate, truncated, illegal, best.cost as cost, best.audit as audit, sha256(array_to_string(best.rows, chr(10))) as repaired_sha256
  from facts join ends using (g)
)
select c.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate, coalesce(truncated, 0) as truncated,
  coalesce(illegal, 0) as illegal, coalesce(cost, 0)::bigint as cost, coalesce(audit, '') as audit, coalesce(repaired_sha256, sha256('')) as repaired_sha256
from (select distinct conv_id from conversations) c left join found f on c.conv_id is not distinct from f.conv_id
"""

_BYTES = "list_transform(range(length(h) // 2), lambda j: (instr('0123456789ABCDEF', h[2 * j + 1]) - 1) * 16 + instr('0123456789ABCDEF', h[2 * j + 2]) - 1)"
_VARIANTS = rf"""
with recursive runs as (
  select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{{C0}}-\x{{FF}}]+')) as run from documents
), counted as (
  select doc_id, run, count(*) as n, hex(encode(coalesce(doc_id::varchar, '') || ':' || run)) as h from runs group by doc_id, run
), hashed as (
  select run, n, {_crc32(_BYTES)} as crc from counted
), changed as (
  select case when crc % 199 = 0 then substr(run, 1, crc % length(run)) || substr(run, crc % length(run) + 2) else run end as word, n from hashed
), words as (
  select word, cast(sum(n) as bigint) as n from changed where length(word) >= 6 group by word having sum(n) >= 5
), cuts as (
  select word, n, j, substr(word, 1, j - 1) || substr(word, j + 1) as rest from words, unnest(range(1, length(word) + 1)) as t(j)
), pairs as (
  select a.word, a.n, b.word as other, b.n as other_n from cuts a join cuts b on a.j = b.j and a.rest = b.rest and length(a.word) = length(b.word) and a.word <> b.word
  union
  select a.word, a.n, b.word, b.n from words a join cuts b on a.word = b.rest
  union
  select b.word, b.n, a.word, a.n from words a join cuts b on a.word = b.rest
), best as (
  select word, n, count(*) as n_near, min({{'n': -other_n, 'word': other}}) as b from pairs group by word, n
), formed as (
  select w.word, w.n, coalesce(n_near, 0) as n_near, case when -b.n >= 5 * w.n then b.word end as form, case when -b.n >= 5 * w.n then -b.n end as form_n
  from words w left join best using (word)
), chains as (
  select word, word as root, 0 as steps from formed
  union all
  select c.word, f.form, steps + 1 from chains c join formed f on f.word = c.root where f.form is not null
), roots as (
  select word, arg_max(root, steps) as root from chains group by word
)
select word, form, root, n, n_near, cast(form_n as bigint) as form_n from formed join roots using (word)
"""

ORACLES = {
    "op2_top_k": """
with ints as (
  select vec_id, list_transform(embedding, lambda x: floor(cast(x as double) * 1024)) as v from embeddings
), valid as (
  select vec_id, v, row_number() over () as r from ints where vec_id is not null and v is not null and len(list_filter(v, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select q.vec_id as query_id, q.r, c.vec_id, cast(list_inner_product(q.v, c.v) as bigint) as score
  from valid q join valid c on q.r <> c.r where q.vec_id % 100 = 0
)
select query_id, cast(row_number() over (partition by r order by score desc, vec_id) as int) as rank, vec_id, score
from scored qualify rank <= 10
""",
    "op5_mix_sources": r"""
with sizes as (
  select doc_id, source, cast(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as bigint) as size from documents
), sources as (
  select source, cast(sum(size) as bigint) as source_size from sizes group by source
), weighted as (
  select source, source_size, ([5, 2, 1])[(row_number() over (order by source nulls last) - 1) % 3 + 1] as weight from sources
), fulls as (
  select *, source_size * 3.0::double / weight as full_at from weighted
), levels as (
  select *, cast((select sum(source_size) from sources) - 3 * coalesce(sum(source_size) over (order by full_at, source nulls last rows between unbounded preceding and 1 preceding), 0) as double)
    / sum(weight) over (order by full_at, source nulls last rows between current row and unbounded following) as level from fulls
), decided as (
  select source, source_size, weight, full_at, (select level from levels where level <= full_at order by full_at, level limit 1) as lv from fulls
), targets as (
  select source, source_size, case when full_at <= lv then 3.0::double * source_size else lv * weight end as target from decided
), placed as (
  select s.doc_id, s.size, t.source_size, t.target, least(cast(round(t.target) as bigint), 3 * t.source_size) as budget,
    cast(coalesce(sum(s.size) over (partition by s.source order by md5(concat('0:', coalesce(cast(s.doc_id as varchar), ''))), s.doc_id nulls first, s.size
      rows between unbounded preceding and 1 preceding), 0) as bigint) as before_it
  from sizes s join targets t on s.source is not distinct from t.source
)
select doc_id, size, source_size, target,
  case when source_size = 0 then 0 else budget // source_size * size + greatest(0, least(size, budget % source_size - before_it)) end as taken
from placed
""",
    "op10_judge_urls": r"""
with parts as (
  select page_id,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') as path from pages
), ruled as (
  select *, case
    when (host = 'example.net' or suffix(host, '.example.net')) and starts_with(path, '/en/') then 'example.net/en/'
    when (host = 'example.com' or suffix(host, '.example.com')) and starts_with(path, '/de/') then 'example.com/de/'
    when (host = 'org' or suffix(host, '.org')) and starts_with(path, '/fr/') then 'org/fr/'
    when (host = 'net' or suffix(host, '.net')) and starts_with(path, '/') then 'net/' end as rule,
    list_has_any(regexp_split_to_array(host, '[.-]'), ['spam', 'pills', 'casino', 'adult', 'phish', 'malware']) as listed from parts
)
select page_id, host, path, rule, case when rule in ('net/', 'example.com/de/') then 'block' when rule is not null then 'allow' when listed then 'block' else 'allow' end as verdict,
  listed from ruled
""",
    "op11_repair_conversations": _REPAIR,
    "op13_spelling_variants": _VARIANTS,
}
