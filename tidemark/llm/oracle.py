"""DuckDB SQL for the vector operators and for personal data."""

from __future__ import annotations

from tidemark.llm.centroids import CENTROIDS, COMPONENTS, ROUNDS, SEED
from tidemark.llm.pii import DISCLOSURE, KINDS, REACH, STEM, SUPPORT

_USABLE = "embedding is not null and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0"
_WHOLE = "list_transform(embedding, lambda x: floor(256 * x::double)::bigint)"

HARD_NEGATIVES = f"""
    with e as (
        select distinct vec_id as id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, {_WHOLE} as v
        from embeddings where vec_id is not null and label is not null and {_USABLE}),
    s as (
        select a.id as a, a.v as av, a.label as al, x.id, x.label,
               coalesce(list_sum(list_transform(range(1, least(len(a.v), len(x.v)) + 1), lambda i: a.v[i] * x.v[i])), 0)::bigint as score
        from e a join e x on a.id % 100 = 0 and x.id <> a.id),
    p as (
        select *, row_number() over (partition by a, av, al order by score desc, id) as place from s where label = al
        qualify place <= 5),
    n as (
        select p.a, p.place, p.id as positive_id, p.score as ps, s.id, s.score as ns,
               row_number() over (partition by p.a, p.av, p.al, p.place order by s.score desc, s.id) as rank
        from p join s on s.a = p.a and s.av = p.av and s.al = p.al and s.label <> p.al
        where 80 * p.score <= 100 * s.score and s.score <= p.score
        qualify rank <= 5)
    select a as anchor_id, positive_id, rank::int as rank, id as negative_id, ps as positive_score, ns as negative_score from n"""


def _round(t: int) -> str:
    return f"""
    d{t} as materialized (
        select r, c.k, sum((x - y) * (x - y))::bigint as d from x join c{t} c using (i) group by r, c.k),
    a{t} as materialized (select r, min(d * 1000 + k) % 1000 as k, min(d * 1000 + k) // 1000 as d from d{t} group by r)"""


def _move(t: int) -> str:
    return f"""
    c{t + 1} as materialized (
        select c.k, c.i, coalesce((m.s - ((m.s % m.n + m.n) % m.n)) // m.n, c.y) as y
        from c{t} c left join (select k, i, sum(x)::bigint as s, count(*) as n from x join a{t} using (r) group by k, i) m on m.k = c.k and m.i = c.i)"""


CENTROID_CLUSTERS = f"""
    with v as materialized (
        select row_number() over () as r, vec_id, {_WHOLE} as v from embeddings where len(embedding) = {COMPONENTS} and {_USABLE}),
    x as materialized (select r, unnest(range({COMPONENTS})) as i, unnest(v) as x from v),
    c0 as materialized (
        select k, unnest(range({COMPONENTS})) as i, unnest(v) as y
        from (select v, row_number() over (order by sha256('{SEED}:' || coalesce(vec_id::varchar, '')), v) - 1 as k from v)
        where k < {CENTROIDS}),
    {",".join(_round(t) + "," + _move(t) for t in range(ROUNDS))},
    {_round(ROUNDS)},
    h as (select k, sha256(string_agg(y::bigint::varchar, ',' order by i)) as centroid_sha256 from c{ROUNDS} group by k)
    select vec_id, k::int as cluster, d::bigint as distance, (sum(d) over (partition by k))::bigint as cluster_inertia,
           (sum(d) over ())::bigint as inertia, centroid_sha256
    from a{ROUNDS} join v using (r) join h using (k)"""

#: The patterns as the contract states them, groups made non-capturing.
_PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
    "card": r"[0-9](?:[\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _ends(gaps: str, matches: str, i: str) -> str:
    return f"list_sum(list_transform({gaps}[1:{i}], lambda g: length(g))) + list_sum(list_transform({matches}[1:{i}], lambda g: length(g)))"


def _found(kind: str) -> str:
    return f"""select t, {KINDS.index(kind)} as kind, regexp_extract_all(t, '{_PLAIN[kind]}') as m, regexp_split_to_array(t, '{_PLAIN[kind]}') as g from texts"""


_DIGITS = "regexp_replace(value, '[^0-9]', '', 'g')"
_WORDS = r"list_distinct(list_filter(regexp_extract_all(lower({}), '\p{{L}}+'), lambda w: length(w) > 1))"

PERSONAL_DATA = f"""
    with texts as materialized (select coalesce(text, '') as t, count(*) as n from documents group by 1),
    m as materialized ({" union all ".join(_found(k) for k in _PLAIN)}),
    p as (select t, kind, unnest(range(1, len(m) + 1)) as i, m, g from m),
    q as materialized (select t, kind, m[i] as value, ({_ends("g", "m", "i")})::bigint as e from p),
    s as materialized (
        select t, kind, value, e - length(value) as s, e, {_DIGITS} as d from q
        where case kind
            when 1 then list_bool_and(list_transform(string_split(value, '.'), lambda o: length(ltrim(o, '0')) <= 3 and try_cast(right(o, 4) as int) <= 255))
            when 2 then length({_DIGITS}) between 12 and 19 and list_sum(list_transform(range(1, length({_DIGITS}) + 1), lambda i:
                case when i % 2 = 1 then substr(reverse({_DIGITS}), i, 1)::int
                     else substr(reverse({_DIGITS}), i, 1)::int * 2 - case when substr(reverse({_DIGITS}), i, 1)::int > 4 then 9 else 0 end end)) % 10 = 0
            when 3 then length({_DIGITS}) between 9 and 15
            else true end),
    plain as materialized (
        select t, n, case when len(m) = 0 then t else array_to_string(flatten(list_transform(range(1, len(g) + 1), lambda i:
            [g[i], coalesce(repeat(' ', length(m[i])), '')])), '') end as x
        from m join texts using (t) where kind = 0),
    near as materialized (
        select t, n, kind, value,
               case when s > {REACH} then regexp_replace(substr(x, s - {REACH}, {REACH + 1}), '^\\p{{L}}*', '') else substr(x, 1, s) end || ' ' ||
               case when length(x) - e > {REACH} then regexp_replace(substr(x, e + 1, {REACH + 1}), '\\p{{L}}*$', '') else substr(x, e + 1) end as x
        from s join plain using (t)),
    held as (
        select kind, value, sum(n) as n_c from (select distinct t, n, kind, value from near) group by 1, 2 having count(*) >= {SUPPORT}),
    beside as materialized (select distinct t, n, kind, value, n_c, unnest({_WORDS.format("x")}) as term from near join held using (kind, value)),
    both_ as (
        select kind, value, n_c, w, sum(n) as n_tc
        from (select distinct t, n, kind, value, n_c, unnest([term, substr(term, 1, {STEM}) || '*']) as w from beside)
        group by 1, 2, 3, 4 having count(*) >= {SUPPORT}),
    words as (select n, {_WORDS.format("x")} as w from plain),
    counts as (
        select w, sum(n) as n_t
        from (select n, unnest(list_concat(w, list_distinct(list_transform(w, lambda x: substr(x, 1, {STEM}) || '*')))) as w from words) group by w),
    told as materialized (
        select kind, value, w from both_ join counts using (w), (select count(*)::double as total from documents)
        where log2(n_tc * total / (n_t * n_c)) > {DISCLOSURE} * log2(total / n_c)),
    term as materialized (select distinct t, term from beside join told on told.kind = beside.kind and told.value = beside.value and w = term),
    w as (
        select t, regexp_extract_all(x, '\\p{{L}}+') as m, regexp_split_to_array(x, '\\p{{L}}+') as g
        from plain where t in (select t from term)),
    wp as (select t, unnest(range(1, len(m) + 1)) as i, m, g from w),
    spans as materialized (
        select t, kind, s, e from s
        union all
        select t, 4, e - length(v), e from (select t, m[i] as v, ({_ends("g", "m", "i")})::bigint as e from wp) x join term using (t) where lower(v) = term),
    told_spans as (
        select t, string_agg((array[{", ".join(f"'{k}'" for k in KINDS)}])[kind + 1] || ':' || s || ':' || e, ',' order by s, kind, e) as spans,
               string_agg((array[{", ".join(f"'{k}'" for k in KINDS)}])[kind + 1] || ':' || s || ':' || e, ',' order by s, kind, e) filter (kind < 4) as base,
               {", ".join(f"count(*) filter (kind = {KINDS.index(k)}) as n_{k}" for k in _PLAIN)}
        from spans group by t)
    select doc_id, {", ".join(f"coalesce(n_{k}, 0) as n_{k}" for k in _PLAIN)}, sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
    from documents left join told_spans on told_spans.t = coalesce(documents.text, '')"""
