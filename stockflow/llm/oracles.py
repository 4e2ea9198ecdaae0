"""DuckDB statements of the operators that SQL can express."""

from __future__ import annotations

# Sets of 3-word shingles, links by counting shared ones, components by closure.
NGRAM_JOIN = r"""
with recursive words as (
  select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from documents),
sets as (
  select doc_id, case when len(w) = 0 then [] when len(w) < 3 then [array_to_string(w, ' ')]
         else list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) end as s from words),
shingles as (select doc_id, len(s) as n, unnest(s) as shingle from sets),
links as (
  select a.doc_id as a, b.doc_id as b from shingles a join shingles b on a.shingle = b.shingle and a.doc_id <> b.doc_id
         and 100 * b.n >= 90 * a.n and 100 * a.n >= 90 * b.n
  group by a.doc_id, b.doc_id, a.n, b.n having 100 * count(*) >= 90 * (a.n + b.n - count(*))),
reach as (select doc_id, doc_id as other from sets union select r.doc_id, l.b from reach r join links l on r.other = l.a)
select s.doc_id, cast(len(s.s) as bigint) as n_shingles, min(r.other) as component_id
from sets s join reach r on s.doc_id = r.doc_id group by s.doc_id, len(s.s)
"""

# Damage and faults; then ``rows`` holds each conversation's rows in order.
_DAMAGED = r"""
with crc as (   -- crc32 bit by bit over the bytes of the (ASCII) key
  select *, xor(list_reduce(list_transform(string_split(coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' '), ''), lambda ch: cast(ascii(ch) as ubigint)),
         lambda acc, b: list_reduce(range(8), lambda k, i: xor(k >> 1, case when k % 2 = 1 then 3988292384 else 0 end)::ubigint, xor(acc, b)), 4294967295::ubigint), 4294967295::ubigint) % 20 as kind
  from conversations),
damaged as (
  select conv_id, turn, case when kind = 4 then 'user' else coalesce(role, ' ') end as role,
         case kind when 1 then '' when 2 then translate(coalesce(text, ' '), '.!?', '') else coalesce(text, ' ') end as text,
         unnest(case when kind = 3 then [1, 2] else [1] end) as copy
  from crc where kind <> 0),
placed as (select *, row_number() over (partition by conv_id order by turn nulls first, role, text, copy) as pos,
                  rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as body from damaged),
seen as (select *, row_number() over (partition by conv_id, role, text order by pos) > 1 as again, left(role, 1) as i,
                lag(left(role, 1)) over (partition by conv_id order by pos) as before from placed),
faulty as (select *, case when body = '' then 'blank' when again then 'duplicate' when right(body, 1) not in ('.', '!', '?') then 'truncated' else '' end as fault from seen),
stats as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (where fault = 'blank') as blank,
         count(*) filter (where fault = 'duplicate') as duplicate, count(*) filter (where fault = 'truncated') as truncated,
         count(*) filter (where before is not null and before || i not in ('su', 'ua', 'au')) as illegal,
         list(struct_pack(r := role, x := text, i := i, f := fault) order by pos) as rows
  from faulty group by conv_id),
"""

# A dearest repair, for states that cannot be reached: (cost, audit, lines).
_NONE = "{'c': 1000000000, 'a': 'Z', 't': ['']}"
_DELETE_ONLY, _CUT = "(x.f in ('blank', 'duplicate'))", "(x.f = 'truncated')::int"


def _step(state: str, cost: object, letter: str, line: str | None = None) -> str:
    lines = f"list_append({state}.t, {line})" if line else f"{state}.t"
    return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 't': {lines}}}"


def _best(candidates: list[str]) -> str:
    return f"list_min([{', '.join(candidates)}])"


def _after(q: str) -> str:
    """The best repair that ends in state ``q`` with row x, from those before it (p)."""
    found = [_step(f"p.{q}", 3, "D")]
    role = {"u": "'user:'", "a": "'assistant:'"}.get(q)
    for before in {"z": "", "s": "z", "u": "zsa", "a": "u"}[q]:
        keep = _step(f"p.{before}", _CUT, "K", "x.r || ':' || x.x")
        found.append(f"case when not {_DELETE_ONLY} and x.i = '{q}' then {keep} else {_NONE} end")
        if role:
            rename = _step(f"p.{before}", f"2 + {_CUT}", "R", f"{role} || x.x")
            found.append(f"case when not {_DELETE_ONLY} then {rename} else {_NONE} end")
    return _best(found)


def repair_sql() -> str:
    """Bellman's recursion over the rows with the four states' best repairs: one
    insert leads to u, one more to a (z: nothing kept yet)."""
    inserted = _best(["v.u", *[_step(f"v.{q}", 2, "I", "'user:'") for q in "zsa"]])
    answered = _best(["v.a", _step("v.u", 2, "I", "'assistant:'")])
    states = ", ".join(f"'{q}': {_after(q)}" for q in "zsua")
    return _DAMAGED + f"""
fold as (
  select *, list_reduce(rows, lambda p, x: list_transform(list_transform([{{{states}}}],
       lambda v: {{'z': v.z, 's': v.s, 'u': {inserted}, 'a': v.a}}),
       lambda v: {{'z': v.z, 's': v.s, 'u': v.u, 'a': {answered}}})[1],
     {{'z': {{'c': 0, 'a': '', 't': []::varchar[]}}, 's': {_NONE}, 'u': {{'c': 2, 'a': 'I', 't': ['user:']}},
      'a': {{'c': 4, 'a': 'II', 't': ['user:', 'assistant:']}}}}) as f
  from stats)
select c.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate, coalesce(truncated, 0) as truncated,
       coalesce(illegal, 0) as illegal, coalesce(cast(list_min([f.z, f.a]).c as bigint), 0) as cost, coalesce(list_min([f.z, f.a]).a, '') as audit,
       sha256(coalesce(array_to_string(list_min([f.z, f.a]).t, chr(10)), '')) as repaired_sha256
from (select distinct conv_id from conversations) c left join fold on c.conv_id is not distinct from fold.conv_id
"""
