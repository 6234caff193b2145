"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from clusterloom.llm.chat import CONTROL


def _escaped(column: str) -> str:
    """The chat template's escapes as nested replacements."""
    sql = f"replace({column}, '\\', '\\\\')"
    for control in CONTROL:
        sql = f"replace({sql}, '{control}', '{control[0]}\\{control[1:]}')"
    return sql


ORACLES: dict[str, str] = {}

ORACLES["op9_chat_format"] = f"""
with turns as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all
    select -1, unnest([0, 1]), unnest(['user', 'assistant']), '</s>[INST] ok [/INST]'
)
select
    conv_id,
    count(*) as n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
    coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
    sha256(coalesce(string_agg(text, '' order by turn, text) filter (role = 'assistant'), '')) as loss_sha256,
    sum(
        length('<|im_start|>') + length('<|im_end|>') + 2
        + length(replace({_escaped("role")}, chr(10), '\\' || chr(10))) + length({_escaped("text")})
    )::bigint as formatted_chars
from turns
group by conv_id
"""

ORACLES["op2_warc"] = """
with payloads as (
    select page_id, coalesce(html, '') as html, strlen(coalesce(html, ''))::bigint as payload_bytes from pages
),
placed as (
    select *, max(page_id) over (partition by html) as stored from payloads
)
select
    page_id,
    payload_bytes,
    sha1(html) as payload_digest,
    case when payload_bytes >= 1000 and page_id <> stored then 'revisit' else 'response' end as record_type,
    case when payload_bytes >= 1000 and page_id <> stored then stored end as refers_to
from placed
"""

ORACLES["op12_top_k"] = """
with usable as (
    select
        row_number() over () as place,
        vec_id,
        list_transform(embedding, lambda c: cast(floor(cast(c as double) * 64) as bigint)) as v
    from embeddings
    where len(list_filter(embedding, lambda c: c is null or isnan(c) or isinf(c))) = 0
),
scored as (
    select
        q.place,
        q.vec_id as query_id,
        c.vec_id,
        c.place as candidate,
        coalesce(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])), 0)::bigint as score
    from usable q
    join usable c on q.place <> c.place and len(q.v) = len(c.v)
    where q.vec_id % 20 = 0
),
ranked as (
    select
        query_id,
        row_number() over (partition by place order by score desc, vec_id nulls last, candidate)::int as rank,
        vec_id,
        score
    from scored
)
select * from ranked where rank <= 20
"""

ORACLES["op13_collocations"] = """
with pieces as (
    select
        coalesce(lang, 'und') as lang,
        unnest(regexp_split_to_array(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[.,;:!?\x0A-\x0D]'
        )) as piece
    from documents
),
numbered as (
    select row_number() over () as place, lang, piece from pieces
),
words as (
    select
        place, lang, generate_subscripts(w, 1) as i, unnest(w) as word
    from (select place, lang, list_filter(regexp_split_to_array(piece, '[ \x09]+'), lambda w: w <> '') as w from numbered)
),
all_words as (
    select lang, count(*) as n from words group by lang
),
sizes as (
    select unnest([1, 2, 3, 4, 5]) as size
),
following as (
    select
        lang, word, lead(word, 1) over own as w2, lead(word, 2) over own as w3, lead(word, 3) over own as w4,
        lead(word, 4) over own as w5
    from words
    window own as (partition by place order by i)
),
counts as (
    select lang, 1 as size, word as phrase, count(*) as f from following group by all having f >= 100
    union all
    select lang, 2, word || ' ' || w2 as phrase, count(*) as f from following
    where w2 is not null group by all having f >= 100
    union all
    select lang, 3, word || ' ' || w2 || ' ' || w3 as phrase, count(*) as f from following
    where w3 is not null group by all having f >= 100
    union all
    select lang, 4, word || ' ' || w2 || ' ' || w3 || ' ' || w4 as phrase, count(*) as f from following
    where w4 is not null group by all having f >= 100
    union all
    select lang, 5, word || ' ' || w2 || ' ' || w3 || ' ' || w4 || ' ' || w5 as phrase, count(*) as f from following
    where w5 is not null group by all having f >= 100
),
inside as (
    select c.lang, array_to_string(string_split(c.phrase, ' ')[p.i : p.i + s.size - 1], ' ') as phrase, max(c.f) as most
    from counts c
    join sizes s on s.size >= 2 and s.size < c.size
    join (select unnest([1, 2, 3, 4]) as i) p on p.i + s.size - 1 <= c.size
    group by all
),
cuts as (
    select
        c.lang, c.phrase, c.f as a, l.f as l, r.f as r, n.n, k.k,
        (1000::hugeint * c.f * n.n // (l.f::hugeint * r.f))::bigint as score
    from counts c
    join (select unnest([1, 2, 3, 4]) as k) k on k.k < c.size
    join counts l on l.lang = c.lang and l.phrase = array_to_string(string_split(c.phrase, ' ')[1 : k.k], ' ')
    join counts r on r.lang = c.lang and r.phrase = array_to_string(string_split(c.phrase, ' ')[k.k + 1 : c.size], ' ')
    join all_words n on n.lang = c.lang
    left join inside i on i.lang = c.lang and i.phrase = c.phrase
    where c.size >= 2 and coalesce(i.most, 0) < c.f
),
lowest as (
    select * from cuts qualify row_number() over (partition by lang, phrase order by score, k) = 1
),
ranked as (
    select
        lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank,
        phrase, a, l, r, n, score
    from lowest
)
select * from ranked where rank <= 2000
"""
