"""SQL of the corpus queries that SQL can express, written apart from the operators."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

RANKED_SEARCH = f"""
with terms as (
  select doc_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) as term
  from documents
), counts as (
  select doc_id, term, count(*) as tf from terms group by all
), sizes as (
  select doc_id, cast(sum(tf) as bigint) as n from counts group by doc_id
), corpus as (
  select count(*) as n_docs, cast(sum(n) as bigint) as n_terms from sizes
), weights as (
  select term, cast(floor(1000 * ln((2 * any_value(n_docs) + 2)::double / (2 * count(*) + 1))) as bigint) as w
  from counts, corpus group by term
), lengths as (
  select doc_id, 25 + ((75 * n * n_docs) // n_terms) as m from sizes, corpus
), wanted as (
  select item_id, term, count(*) as times from (
    select item_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'),
      '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) as term
    from benchmark) group by all
), scored as (
  select item_id, doc_id,
    cast(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) as bigint) as score
  from wanted join weights using (term) join counts using (term) join lengths using (doc_id)
  group by all
)
select item_id, cast(rank as integer) as rank, doc_id, score from (
  select *, row_number() over (partition by item_id order by score desc, doc_id) as rank
  from scored where score > 0
) where rank <= 10
"""

MERKLE = f"""
with recursive given as (
  select *, list_reduce(
    list_prepend(4294967295::ubigint, list_transform(string_split(cast(doc_id as varchar), ''), lambda c: cast(ascii(c) as ubigint))),
    lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0]::ubigint[],
      lambda c, z: xor(c >> 1, 3988292384::ubigint * (c & 1)))) as crc
  from documents
), fields as (
  select doc_id, source, xor(crc, 4294967295::ubigint) % 5 = 0 as tampered, text,
    coalesce(strlen(cast(doc_id as varchar)) || ':' || doc_id, '-')
    || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-')
    || coalesce(strlen(cast(n_chars as varchar)) || ':' || n_chars, '-') as head
  from given
), leaves as (
  select doc_id, source,
    sha256(head || coalesce(strlen(text) || ':' || text, '-')) as leaf,
    sha256(head || coalesce(strlen(text) || ':' ||
      case when tampered then translate(text, '{UPPER}', '{LOWER}') else text end, '-')) as found,
    row_number() over (partition by source order by doc_id nulls first) - 1 as place,
    count(*) over (partition by source) as members
  from fields
), nodes(source, level, place, members, digest) as (
  select source, 0, place, members, leaf from leaves
  union all
  select source, level + 1, place // 16, any_value((members + 15) // 16),
    sha256(string_agg(digest, '' order by place))
  from nodes where members > 1 group by source, level, place // 16
), subroots as (
  select source, digest, row_number() over (order by source nulls first) - 1 as place,
    count(*) over () as members
  from nodes where members = 1
), tops(level, place, members, digest) as (
  select 0, place, members, digest from subroots
  union all
  select level + 1, place // 16, any_value((members + 15) // 16),
    sha256(string_agg(digest, '' order by place))
  from tops where members > 1 group by level, place // 16
), steps as (
  select l.doc_id, n.level,
    coalesce(string_agg(n.digest, '' order by n.place) filter (n.place < l.place >> (4 * n.level)), '') as before,
    coalesce(string_agg(n.digest, '' order by n.place) filter (n.place > l.place >> (4 * n.level)), '') as after
  from leaves l join nodes n on n.source is not distinct from l.source and n.members > 1
    and n.place // 16 = l.place >> (4 * n.level + 4)
  group by l.doc_id, n.level
  union all
  select l.doc_id, 1000 + t.level,
    coalesce(string_agg(t.digest, '' order by t.place) filter (t.place < s.place >> (4 * t.level)), ''),
    coalesce(string_agg(t.digest, '' order by t.place) filter (t.place > s.place >> (4 * t.level)), '')
  from leaves l join subroots s on s.source is not distinct from l.source
    join tops t on t.members > 1 and t.place // 16 = s.place >> (4 * t.level + 4)
  group by l.doc_id, t.level
), ordered as (
  select *, row_number() over (partition by doc_id order by level) as nth from steps
), folds(doc_id, nth, digest) as (
  select doc_id, 0, found from leaves
  union all
  select f.doc_id, f.nth + 1, sha256(o.before || f.digest || o.after)
  from folds f join ordered o on o.doc_id = f.doc_id and o.nth = f.nth + 1
), ends as (
  select doc_id, arg_max(digest, nth) as folded_root from folds group by doc_id
), proofs as (
  select doc_id, string_agg(before || after, '' order by nth) as proof from ordered group by doc_id
)
select l.doc_id, leaf, s.digest as subroot, t.digest as root,
  sha256(coalesce(proof, '')) as proof_sha256, folded_root, folded_root = t.digest as verified
from leaves l join subroots s on s.source is not distinct from l.source
  join ends e on e.doc_id = l.doc_id left join proofs p on p.doc_id = l.doc_id
  join tops t on t.members = 1
"""

_CONTROLS = ("<|", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")


def _escaped_sql(column: str) -> str:
    """No control string overlaps another, so one after the other gives the same."""
    out = f"replace({column}, '\\', '\\\\')"
    for control in _CONTROLS:
        out = f"replace({out}, '{control}', '{control[0]}\\{control[1:]}')"
    return out


CHAT_FORMAT = f"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '</s>[INST] ok [/INST]'
  union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), formed as (
  select *, '<|turn|>' || {_escaped_sql("role")} || '<|body|>' || {_escaped_sql("text")} || '<|end|>' as formatted
  from turns
)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, formatted)) as turns_sha256,
  cast(sum(case when role = 'assistant' then length(text) else 0 end) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, formatted) filter (role = 'assistant'), '')) as loss_sha256,
  cast(sum(length(formatted)) as bigint) as formatted_chars
from formed group by conv_id
"""
