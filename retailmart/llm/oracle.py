"""The queries whose results SQL can express, for the checking database; written from the contracts."""

from __future__ import annotations

from retailmart.llm.chat import CHATML
from retailmart.llm.mixing import MOST, WEIGHTS
from retailmart.llm.quality import MAX_DOCUMENTS, MAX_REPEAT_PERCENT, MIN_LEFT, MIN_WORDS

WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
HARD = "<|im_end|><|im_start|>assistant ok"
_CONTROL = "|".join(rf"{c[0]}\\*{c[1:].replace('|', '[|]')}" for c in CHATML.control)

CHAT = rf"""with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all values (-1, 0, 'user', '{HARD}'), (-1, 1, 'assistant', '{HARD}')
)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  cast(coalesce(sum(length(text)) filter (where role = 'assistant'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
  cast(sum({len(CHATML.before) + len(CHATML.after_role) + len(CHATML.after)} + length(role) + length(text)
    + len(regexp_extract_all(text, '{_CONTROL}'))) as bigint) as formatted_chars,
  regexp_full_match(string_agg(role, ' ' order by turn, role, text), '(system )?user assistant( user assistant)*') as valid
from turns group by conv_id"""

QUALITY = rf"""with docs as (
  select doc_id, source, coalesce(text, '') as t, {WORDS.format("coalesce(text, '')")} as w from documents
),
windows as (
  select doc_id, i, count(*) over (partition by doc_id, w[i], w[i + 1], w[i + 2]) as n
  from (select doc_id, w, unnest(range(1, len(w) - 1)) as i from docs)
),
repeated as (
  select doc_id, count(distinct place) as n_repeat_words
  from (select doc_id, i + unnest([0, 1, 2]) as place from windows where n > 1) group by doc_id
),
lines as (
  select doc_id, source, unnest(string_split(t, chr(10))) as line,
    unnest(string_split(regexp_replace(regexp_replace(lower(t), '[1-9]', '0', 'g'), '[\x20\x09\x0B-\x0D]+', ' ', 'g'), chr(10))) as normal
  from docs
),
normal_lines as (select distinct doc_id, source, trim(normal) as normal from lines where trim(normal) <> ''),
documents_of as (select doc_id, md5(string_agg(normal, chr(10) order by normal)) as document from normal_lines group by doc_id),
flagged as (
  select source, normal from normal_lines join documents_of using (doc_id) group by source, normal having count(distinct document) > {MAX_DOCUMENTS}
),
line_counts as (
  select doc_id, cast(count(*) filter (where filled) - count(distinct line) filter (where filled) as bigint) as n_dup_lines,
    cast(coalesce(sum(n) filter (where not away), 0) as bigint) as left_words
  from (
    select doc_id, line, regexp_matches(line, '[^\x20\x09-\x0D]') as filled, len({WORDS.format("line")}) as n,
      exists (select 1 from flagged f where f.source is not distinct from l.source and f.normal = trim(l.normal)) as away
    from lines l
  ) group by doc_id
),
measured as (
  select doc_id, cast(len(w) as bigint) as n_words, cast(length(array_to_string(w, '')) as bigint) as word_chars,
    cast(len(regexp_extract_all(t, '[#*$%&|<>]')) as bigint) as n_symbols, n_dup_lines,
    coalesce(n_repeat_words, 0) as n_repeat_words, left_words
  from docs join line_counts using (doc_id) left join repeated using (doc_id)
),
based as (
  select *, n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words as base_failed from measured
)
select *, not base_failed and left_words >= {MIN_LEFT} * n_words as kept from based"""

WARC = f"""with digests as (select page_id, coalesce(html, '') as html, sha1(coalesce(html, '')) as hex from pages),
named as (
  select page_id, strlen(html) as payload_bytes, min(page_id) over (partition by html) as first,
    array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      cast(1 + ((cast('0x' || substr(hex, cast(1 + 5 * (i // 4) as bigint), 5) as bigint) >> cast(15 - 5 * (i % 4) as integer)) & 31) as bigint), 1)), '') as payload_digest
  from digests
)
select page_id, cast(payload_bytes as bigint) as payload_bytes, payload_digest,
  case when first < page_id then 'revisit' else 'response' end as record_type, case when first < page_id then first end as refers_to
from named"""

_WEIGHT = "case " + " ".join(f"when rank % {len(WEIGHTS)} = {i} then {w}" for i, w in enumerate(WEIGHTS)) + " end"
MIXING = f"""with docs as (select doc_id, source, cast(len({WORDS.format("coalesce(text, '')")}) as bigint) as size from documents),
ranked as (
  select source, source_size, row_number() over (order by source is null, source) - 1 as rank
  from (select source, cast(sum(size) as bigint) as source_size from docs group by source)
),
weighed as (select source, source_size, {_WEIGHT} as weight from ranked),
levels as (
  select source_size, weight, row_number() over before as place, (sum(source_size) over () - coalesce(sum({MOST} * source_size) over before, 0)) / sum(weight) over rest as level
  from weighed
  window before as (order by source_size * 1.0 / weight, source rows between unbounded preceding and 1 preceding),
    rest as (order by source_size * 1.0 / weight, source rows between current row and unbounded following)
),
level as (select coalesce(arg_min(level, place) filter (where {MOST} * source_size >= level * weight), max(level)) as level from levels),
goals as (
  select source, source_size, least(cast({MOST} * source_size as double), cast(level as double) * weight) as target from weighed, level
),
expected as (
  select doc_id, size, source_size, target, d.source,
    cast(case when source_size > 0 then target / source_size else 0 end as decimal(20,12)) as share,
    cast(cast(cast('0x' || substr(md5('mix' || coalesce('=' || d.source, '')), 1, 8) as bigint) as double) / 4294967296.0 as decimal(20,12)) as draw,
    ascii(md5(cast(doc_id as varchar))) % 2 as half
  from docs d join goals g on d.source is not distinct from g.source
),
summed as (
  select *, draw + sum(share) over (
    partition by source order by half, case when half = 0 then size else -size end, doc_id rows unbounded preceding) as upto
  from expected
)
select doc_id, size, source_size, target, cast(floor(upto) - floor(upto - share) as bigint) as copies,
  cast(floor(upto) - floor(upto - share) as bigint) * size as taken
from summed"""

# the checksum bit by bit, as the database has no function for it
_CRC32 = """xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split({}, ''), lambda x: ascii(x)::bigint)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda v, i: case when v & 1 = 1 then xor(v >> 1, 3988292384) else v >> 1 end)), 4294967295)"""
TRIE = f"""with turns as (
  select conv_id, row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) - 1 as place,
    coalesce(role, '') as role, coalesce(text, '') as text
  from conversations where conv_id is not null
),
convs as (select conv_id, conv_id - conv_id % 100 as base, {_CRC32.format("cast(conv_id as varchar)")} % 6 as h from (select distinct conv_id from turns)),
rebuilt as (
  select conv_id, place, role, text from turns join convs using (conv_id) where place >= h
  union all select c.conv_id, t.place, t.role, t.text from convs c join turns t on t.conv_id = c.base and t.place < c.h
),
named as (select conv_id, row_number() over (partition by conv_id order by place) as depth, length(text) as long, sha256(length(role) || ':' || role || text) as name from rebuilt),
paths as (
  select conv_id, depth, long, array_to_string(list(name) over (partition by conv_id order by depth rows unbounded preceding), '/') as path,
    array_to_string(list(name) over (partition by conv_id order by depth rows between unbounded preceding and 1 preceding), '/') as parent
  from named
  union all select conv_id, 0, 0, '', null from convs
),
members as (select *, max(depth) over (partition by conv_id) as n from paths),
nodes as (
  select coalesce(path, '') as path, any_value(case when depth > 0 then coalesce(parent, '') end) as parent, min(conv_id) as conv_id, any_value(depth) as depth, any_value(long) as long,
    count(*) as n_convs, sha256(coalesce(string_agg(cast(conv_id as varchar), ',' order by conv_id) filter (where depth = n), '')) as ends_sha256
  from members group by path
),
children as (select parent as path, count(*) as n_children from nodes where parent is not null group by parent),
below as (
  select m.path, cast(sum((x.n_convs - 1) * x.long) as bigint) as saved_tokens, count(*) filter (where c.path is null) as n_leaves
  from nodes x join members m on m.conv_id = x.conv_id and m.depth <= x.depth left join children c on c.path = x.path
  group by m.path
)
select x.conv_id, cast(x.depth as bigint) as depth, p.conv_id as parent_conv_id, x.n_convs, coalesce(c.n_children, 0) as n_children, b.n_leaves, b.saved_tokens, x.ends_sha256
from nodes x join below b on b.path = x.path left join children c on c.path = x.path left join nodes p on p.path = x.parent"""

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_TERMS = rf"unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_UPPER.lower()}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))"
SEARCH = f"""with words as (select doc_id, {_TERMS} as term from documents),
held as (select doc_id, term, count(*) as tf from words group by doc_id, term),
lengths as (select doc_id, count(*) as n from words group by doc_id),
sizes as (select count(*) as documents, cast(sum(n) as bigint) as total from lengths),
weights as (
  select term, cast(floor(1000 * ln((2 * any_value(documents) + 2) / (2 * count(*) + 1))) as bigint) as w from held, sizes group by term
),
asked as (select item_id, term, count(*) as times from (select item_id, {_TERMS} as term from benchmark) group by item_id, term),
scored as (
  select item_id, doc_id, cast(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * documents) // total)))) as bigint) as score
  from asked join weights using (term) join held using (term) join lengths using (doc_id), sizes group by item_id, doc_id
),
ranked as (select item_id, cast(row_number() over (partition by item_id order by score desc, doc_id) as integer) as rank, doc_id, score from scored where score > 0)
select * from ranked where rank <= 10"""

ORACLE = {"op1_chat": CHAT, "op5_quality": QUALITY, "op9_warc": WARC, "op10_mixing": MIXING, "op12_search": SEARCH, "op13_trie": TRIE}
