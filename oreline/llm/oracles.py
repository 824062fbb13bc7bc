"""SQL of the queries that SQL can express, over the same tables."""

BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP2 = f"""
with tokens as (
  select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
    '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '') as w from documents
), item_tokens as (
  select item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
    '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '') as w from benchmark
), item_windows as (
  select distinct item_id, array_to_string(w[s : s + 9], ' ') as win, least(len(w), 10) as k
  from (select item_id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) as s from item_tokens where len(w) > 0)
), doc_windows as (
  select doc_id, s, k, array_to_string(w[s : s + k - 1], ' ') as win
  from (select doc_id, w, unnest(range(1, len(w) + 1)) as s from tokens), (select distinct k from item_windows)
  where s + k - 1 <= len(w)
), matches as (
  select d.doc_id, d.s, d.k, i.item_id from doc_windows d join item_windows i on d.win = i.win and d.k = i.k
), hit as (
  select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(s, s + k)) as p from matches) group by doc_id
), found as (
  select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items
  from (select distinct doc_id, item_id::varchar as item from matches) group by doc_id
)
select t.doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
  sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from tokens t left join hit h on t.doc_id = h.doc_id left join found f on t.doc_id = f.doc_id
"""

OP4 = f"""
with lines as (
  select doc_id, u.line, u.n
  from documents, unnest(string_split(coalesce(text, ''), chr(10))) with ordinality as u(line, n)
), keyed as (
  select *, translate(trim(line, {BLANKS}), '{UPPER}', '{LOWER}') as key from lines
), repeats as (
  select key, min(doc_id) as first from keyed where length(key) >= 10 group by key having count(distinct doc_id) > 1
), marked as (
  select k.doc_id, k.line, k.n, (r.key is not null and k.doc_id > r.first) as gone from keyed k left join repeats r using (key)
)
select doc_id, count(*) as n_lines, count(*) filter (where gone) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by n) filter (where not gone), '')) as kept_sha256
from marked group by doc_id
"""

OP5 = """
with digests as (
  select page_id, coalesce(html, '') as html, sha1(coalesce(html, '')) as hex from pages
), ranked as (
  select page_id, octet_length(encode(html)) as payload_bytes, hex, min(page_id) over (partition by html) as first from digests
)
select page_id, payload_bytes::bigint as payload_bytes,
  array_to_string(list_transform(range(32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((
      ('0x' || substr(hex, 1 + 5 * (i // 4)::integer, 5))::bigint >> (15 - 5 * (i % 4))::integer) & 31)::integer, 1)), '') as payload_digest,
  case when page_id = first then 'response' else 'revisit' end as record_type,
  case when page_id <> first then first end as refers_to
from ranked
"""

OP7 = f"""
with recursive split as (
  select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[ \\t\\n\\x0B\\f\\r]+'),
    lambda w: w <> '') as w from documents
), shingles as (
  select distinct doc_id, array_to_string(w[s : s + 4], ' ') as shingle
  from (select doc_id, w, unnest(range(1, greatest(1, len(w) - 4) + 1)) as s from split where len(w) > 0)
), sizes as (
  select doc_id, count(*) as n from shingles group by doc_id
), shared as (
  select x.doc_id as a, y.doc_id as b, count(*) as same
  from shingles x join shingles y on x.shingle = y.shingle and x.doc_id <> y.doc_id group by x.doc_id, y.doc_id
), links as (
  select a, b from shared join sizes p on p.doc_id = a join sizes q on q.doc_id = b where 100 * same >= 75 * (p.n + q.n - same)
), reach as (
  select doc_id, doc_id as other from documents
  union
  select r.doc_id, l.b from reach r join links l on r.other = l.a
), least as (
  select doc_id, min(other) as component_id from reach group by doc_id
)
select d.doc_id, coalesce(n, 0)::bigint as n_shingles, component_id, d.doc_id = component_id as kept
from documents d join least using (doc_id) left join sizes s on s.doc_id = d.doc_id
"""

OP9 = """
with split as (
  select doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[ \\t\\n\\x0B\\f\\r]+'), lambda w: w <> '') as words from documents
), starts as (
  select doc_id, unnest(range(1, len(words) - 11)) as p, words from split where len(words) >= 13
), windows as (
  select doc_id, p, array_to_string(words[p : p + 12], ' ') as w from starts
), judged as (
  select doc_id, p, min(doc_id) over (partition by w) < doc_id as later from windows
), gone as (
  select distinct doc_id, p + i as p from judged, (select unnest(range(13)) as i) where later
), lost as (
  select doc_id, list(p) as ps from gone group by doc_id
)
select s.doc_id, len(words)::bigint as n_words, coalesce(len(ps), 0)::bigint as n_removed,
  sha256(array_to_string(case when ps is null then words
    else list_transform(list_filter(range(1, len(words) + 1), lambda p: not list_contains(ps, p)), lambda p: words[p]) end, ' ')) as kept_sha256
from split s left join lost l on s.doc_id = l.doc_id
"""

#: crc32 by its table of bytes, as integers of the low 32 bits.
CRC_TABLE = """(select list(list_reduce(range(8), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384::bigint) else c >> 1 end, i::bigint) order by i) as t
  from range(256) r(i))"""


def crc32_of(text: str) -> str:
    """crc32 of an ASCII text, given the column t of CRC_TABLE."""
    return f"xor(4294967295::bigint, list_reduce(list_transform(string_split({text}, ''), lambda ch: ascii(ch)::bigint), " \
        f"lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295::bigint))"


def _edge(path: str, cost: str, letter: str) -> str:
    return f"lpad((substr({path}, 1, 9)::bigint + {cost})::varchar, 9, '0') || substr({path}, 10) || '{letter}'"


#: A path is its cost in nine digits and its letters; the least text is the cheapest path with the least letters.
OP13 = f"""
with recursive crc as {CRC_TABLE},
damaged as (
  select conv_id, turn, {crc32_of("coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ')")} % 20 as fault,
    coalesce(role, ' ') as role, coalesce(text, ' ') as text
  from conversations, crc
), changed as (
  select conv_id, turn, case when fault = 4 then 'user' else role end as role,
    case fault when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
    unnest(range(case when fault = 3 then 2 else 1 end)) as copy
  from damaged where fault <> 0
), placed as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, text, copy) as n,
    row_number() over (partition by conv_id, role, text order by turn nulls first, copy) > 1 as again,
    lag(substr(role, 1, 1)) over (partition by conv_id order by turn nulls first, role, text, copy) as before,
    trim(text, {BLANKS}) as said, substr(role, 1, 1) as c
  from changed
), judged as (
  select *, said = '' as blank, said <> '' and again as duplicate, said <> '' and not again and right(said, 1) not in ('.', '!', '?') as cut,
    before is not null and before || c not in ('su', 'ua', 'au') as odd
  from placed
), sizes as (
  select conv_id, max(turn) - min(turn) + 1 - count(distinct turn) as gaps, count(*) filter (where blank) as blank, count(*) filter (where duplicate) as duplicate,
    count(*) filter (where cut) as truncated, count(*) filter (where odd) as illegal, max(n) as rows
  from judged group by conv_id
), paths as (
  select conv_id, 0::bigint as n, '000000000' as p0, null::varchar as p1, '000000003I' as p2, '000000006II' as p3 from sizes
  union all
  select conv_id, n, p0, p1, least(q2, {_edge("p0", "3", "I")}, {_edge("p1", "3", "I")}, {_edge("q3", "3", "I")}) as p2,
    least(q3, {_edge(f"least(q2, {_edge('p0', '3', 'I')}, {_edge('p1', '3', 'I')})", "3", "I")}) as p3
  from (
    select p.conv_id, j.n, {_edge("p0", "4", "D")} as p0, least({_edge("p1", "4", "D")}, case when k and c = 's' then {_edge("p0", "w", "K")} end) as p1,
      least({_edge("p2", "4", "D")}, case when k then least({_edge("least(p0, p1, p3)", "3 + w", "R")}, case when c = 'u' then {_edge("least(p0, p1, p3)", "w", "K")} end) end) as q2,
      least({_edge("p3", "4", "D")}, case when k then least({_edge("p2", "3 + w", "R")}, case when c = 'a' then {_edge("p2", "w", "K")} end) end) as q3
    from paths p join (select conv_id, n, c, not (blank or duplicate) as k, case when cut then 3 else 0 end as w from judged) j
      on p.conv_id is not distinct from j.conv_id and j.n = p.n + 1
  )
), best as (
  select p.conv_id, least(p0, p3) as path from paths p join sizes s on p.conv_id is not distinct from s.conv_id and p.n = s.rows
), letters as (
  select conv_id, u.spot, u.letter, count(*) filter (where u.letter <> 'I') over w as n, count(*) filter (where u.letter <> 'D') over w as place
  from best, unnest(string_split(substr(path, 10), '')) with ordinality as u(letter, spot) where substr(path, 10) <> ''
  window w as (partition by conv_id order by u.spot)
), turns as (
  select l.conv_id, l.spot, l.letter, l.place, case when letter = 'K' then j.role end as role, case when letter = 'I' then '' else j.text end as text
  from letters l join judged j on l.conv_id is not distinct from j.conv_id and j.n = greatest(l.n, 1) where letter <> 'D'
), opened as (
  select conv_id, max(case when place = 1 and letter = 'K' and substr(role, 1, 1) = 's' then 1 else 0 end) as s from turns group by conv_id
), repaired as (
  select t.conv_id, string_agg(coalesce(role, case when (place - s) % 2 = 1 then 'user' else 'assistant' end) || ':' || text, chr(10) order by place) as content
  from turns t join opened o on t.conv_id is not distinct from o.conv_id group by t.conv_id
)
select i.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank, coalesce(duplicate, 0)::bigint as duplicate,
  coalesce(truncated, 0)::bigint as truncated, coalesce(illegal, 0)::bigint as illegal, coalesce(substr(path, 1, 9)::bigint, 0)::bigint as cost,
  coalesce(substr(path, 10), '') as audit, sha256(coalesce(content, '')) as repaired_sha256
from (select distinct conv_id from conversations) i left join sizes s on i.conv_id is not distinct from s.conv_id
  left join best b on i.conv_id is not distinct from b.conv_id left join repaired r on i.conv_id is not distinct from r.conv_id
"""

ORACLES = {"op2_decontamination": OP2, "op4_line_dedup": OP4, "op5_warc_archive": OP5, "op7_near_dedup": OP7, "op9_substring_dedup": OP9, "op13_conversation_repair": OP13}
