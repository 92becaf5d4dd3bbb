"""SQL that gives the rows of operators which SQL can express."""

from __future__ import annotations

#: crc32 of a list of bytes, by the usual table of the reversed polynomial 0xEDB88320.
_CRC = """crc_table as materialized (
  select list(v order by i) as t from (
    select i, list_reduce(list_concat([i], range(8)),
      lambda c, b: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) as v
    from (select unnest(range(256)) as i)))"""


def _crc32(data: str) -> str:
    return f"xor(list_reduce(list_concat([4294967295], {data}), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"


def _ascii(text: str) -> str:
    return f"list_transform(string_split({text}, ''), lambda x: unicode(x)::bigint)"


def _merkle(levels: int = 5, fanout: int = 16) -> str:
    """Levels as unrolled steps; each keeps a tree's last node once one is left."""
    field = "coalesce(octet_length(encode({0}))::varchar || ':' || {0}, '-')"
    parts = [field.format(f"{c}::varchar") for c in ("doc_id", "source", "lang", "n_chars")]

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join([*parts, field.format(text)]) + ")"

    def reduce(name: str, base: str) -> list[str]:
        steps = []
        for k in range(1, levels + 1):
            before = base if k == 1 else f"{name}{k - 1}"
            steps.append(f"""{name}{k} as (
  select tree, i // {fanout} as i, case when any_value(n) = 1 then any_value(h) else sha256(string_agg(h, '' order by i)) end as h,
    (any_value(n) + {fanout - 1}) // {fanout} as n, list(h order by i) as run, any_value(n) > 1 as real
  from {before} group by tree, i // {fanout})""")
        return steps

    def climb(name: str, base: str) -> list[str]:
        steps = []
        for k in range(1, levels + 1):
            before = base if k == 1 else f"{name}_up{k - 1}"
            steps.append(f"""{name}_up{k} as (
  select u.key, u.tree, u.i // {fanout} as i,
    case when r.real then u.proof || array_to_string(list_concat(run[1:u.i % {fanout}], run[u.i % {fanout} + 2:]), '') else u.proof end as proof,
    case when r.real then sha256(array_to_string(list_concat(list_concat(run[1:u.i % {fanout}], [u.folded]), run[u.i % {fanout} + 2:]), ''))
      else u.folded end as folded
  from {before} u join {name}{k} r on u.tree is not distinct from r.tree and u.i // {fanout} = r.i)""")
        return steps

    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    steps = [
        _CRC,
        f"""marked as (
  select *, coalesce({_crc32(_ascii('doc_id::varchar'))} % 5 = 0, false) as tamper from documents, crc_table)""",
        f"""leaves as (
  select row_number() over () as key, doc_id, source as tree, {leaf('text')} as h, case when tamper then {leaf(lowered)} else {leaf('text')} end as tampered
  from marked)""",
        """placed as (
  select *, row_number() over (partition by tree order by doc_id nulls first, h) - 1 as i, count(*) over (partition by tree) as n from leaves)""",
        *reduce("s", "placed"),
        f"""sources as (
  select 0 as tree, tree as source, h, row_number() over (order by source nulls first) - 1 as i, count(*) over () as n from s{levels})""",
        *reduce("c", "sources"),
        "low as (select key, tree, i, '' as proof, tampered as folded from placed)",
        *climb("s", "low"),
        f"""high as (
  select u.key, 0 as tree, s.i, u.proof, u.folded from s_up{levels} u join sources s on u.tree is not distinct from s.source)""",
        *climb("c", "high"),
    ]
    return (
        "with "
        + ",\n".join(steps)
        + f"""
select p.doc_id, p.h as leaf, s.h as subroot, c.h as root, sha256(u.proof) as proof_sha256, u.folded as folded_root, u.folded = c.h as verified
from placed p join s{levels} s on p.tree is not distinct from s.tree join c_up{levels} u on u.key = p.key cross join c{levels} c"""
    )


#: Words by deletion patterns: equal with one place masked (replaced), or equal to one with a place left out.
_SPELLING = f"""with recursive {_CRC},
runs as (
  select coalesce(doc_id::varchar, '') as id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) as raw from documents),
lowered as (
  select id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run from runs where length(raw) >= 7),
hashed as (
  select run, {_crc32("flatten(list_transform(string_split(id || ':' || run, ''), lambda x: case when unicode(x) < 128 then [unicode(x)::bigint] else [192 | (unicode(x)::bigint >> 6), 128 | (unicode(x)::bigint & 63)] end))")} as h
  from lowered, crc_table),
words as (
  select word, count(*) as n from (
    select case when h % 31 = 0 then run[1:(h % length(run))] || run[(h % length(run)) + 2:] else run end as word from hashed)
  where length(word) >= 7 group by word having count(*) >= 2),
places as (select word, unnest(range(1, length(word) + 1)) as p from words),
cut as (select word, p, word[1:p - 1] as a, word[p + 1:] as b from places),
near as (
  select x.word, y.word as near from cut x join cut y on x.a = y.a and x.b = y.b and x.p = y.p and x.word <> y.word
  union select c.word, w.word from cut c join words w on w.word = c.a || c.b
  union select w.word, c.word from cut c join words w on w.word = c.a || c.b),
best as (
  select r.word, count(*) as n_near, arg_min(near, (-w.n, hex(encode(near)))) as form, max(w.n) as form_n
  from near r join words w on w.word = r.near group by r.word),
judged as (
  select w.word, w.n, coalesce(n_near, 0) as n_near, case when form_n >= 10 * n then form end as form, case when form_n >= 10 * n then form_n end as form_n
  from words w left join best using (word)),
follow as (
  select word, coalesce(form, word) as root, form is null as done from judged
  union all
  select f.word, coalesce(j.form, j.word), j.form is null from follow f join judged j on j.word = f.root where not f.done)
select j.word, form, f.root, n, n_near, form_n from judged j join (select word, root from follow where done) f using (word)"""

_MAXSCORE = """with vectors as (
  select vec_id, row_number() over () as r, list_transform(embedding, lambda x: floor(64 * x::double)) as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select q.vec_id as query_id, q.r as q, c.vec_id, c.r, list_inner_product(q.v, c.v)::bigint as score
  from vectors q join vectors c on q.r <> c.r where q.vec_id % 20 = 0)
select query_id, rank, vec_id, score from (
  select *, row_number() over (partition by q order by score desc, vec_id, r)::integer as rank from scored) where rank <= 20"""

_WORD = r"[^\x20\x09-\x0D]+"
_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: Figures of the quality rules, and the lines that more than 30 documents and 0.1 % of a host's documents hold.
_QUALITY = f"""with docs as materialized (
  select row_number() over () as r, doc_id, coalesce(source::varchar, '') as host, coalesce(text, '') as text,
    regexp_extract_all(coalesce(text, ''), '{_WORD}') as w from documents),
windows as (
  select r, i, w[i:i + 2] as three from (select r, w, unnest(range(1, len(w) - 1)) as i from docs)),
covered as (
  select r, count(distinct i + k) as n_repeat_words
  from (select r, i, count(*) over (partition by r, three) as n from windows), range(3) t(k) where n > 1 group by r),
lines as materialized (
  select r, host, place, raw, regexp_extract_all({_LOWER.format('raw')}, '{_WORD}') as lw
  from (select r, host, unnest(l) as raw, unnest(range(len(l))) as place from (select r, host, string_split(text, chr(10)) as l from docs))
  where len(regexp_extract_all(raw, '{_WORD}')) > 0),
dup as (select r, sum(n - 1)::bigint as n_dup_lines from (select r, raw, count(*) as n from lines group by r, raw) group by r),
sequences as (
  select d.r, d.host, coalesce(string_agg(array_to_string(lw, ' '), chr(10) order by place), '') as sequence
  from docs d left join lines l on d.r = l.r group by d.r, d.host),
held as (
  select l.r, l.host, array_to_string(lw, ' ') as line, sum(len(lw))::bigint as line_words, any_value(sequence) as sequence
  from lines l join sequences s on l.r = s.r group by l.r, l.host, line),
sizes as (select host, count(distinct sequence) as all_documents from sequences group by host),
common as (
  select host, line from (select host, line, count(distinct sequence) as n from held group by host, line) join sizes using (host)
  where n > 30 and n > 0.001 * all_documents),
removed as (select r, sum(line_words)::bigint as removed_words from held join common using (host, line) group by r),
figures as (
  select doc_id, len(w)::bigint as n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::bigint as word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
    coalesce(n_dup_lines, 0) as n_dup_lines, coalesce(n_repeat_words, 0) as n_repeat_words, coalesce(removed_words, 0) as removed_words
  from docs left join covered using (r) left join dup using (r) left join removed using (r))
select *, base_failed is false and n_words - removed_words >= 10 and n_words - removed_words >= 0.3 * n_words as kept
from (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from figures)"""

#: Documents linked by shared shingles, and the smallest id that links lead to.
_JACCARD = f"""with recursive docs as materialized (
  select doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_WORD}') as w from documents),
shingles as materialized (
  select doc_id, unnest(list_distinct(case when len(w) = 0 then [] when len(w) < 5 then [w]
    else list_transform(range(1, len(w) - 3), lambda i: w[i:i + 4]) end)) as s from docs),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
shared as (
  select a.doc_id as x, b.doc_id as y, count(*) as c from shingles a join shingles b on a.s = b.s and a.doc_id < b.doc_id group by x, y),
pairs as (
  select x, y from shared join sizes a on a.doc_id = x join sizes b on b.doc_id = y where 100 * c >= 75 * (a.n + b.n - c)),
links as materialized (select x, y from pairs union all select y, x from pairs),
reach as (
  select doc_id, doc_id as to_id from docs union select r.doc_id, y from reach r join links on r.to_id = x)
select d.doc_id, coalesce(n, 0) as n_shingles, component_id
from docs d left join sizes using (doc_id) join (select doc_id, min(to_id) as component_id from reach group by doc_id) using (doc_id)"""

ORACLE = {
    "op6_quality_rules": _QUALITY,
    "op7_jaccard_join": _JACCARD,
    "op11_merkle_manifest": _merkle(),
    "op12_spelling_variants": _SPELLING,
    "op13_maxscore_search": _MAXSCORE,
}
