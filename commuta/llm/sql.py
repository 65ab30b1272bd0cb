"""The queries of the operators 11 to 13 as SQL, by other means than the operators': joins on deletions, levels, shared shingles."""

from __future__ import annotations

import string

_FOLDED = f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"


def _crc_steps(byte: int) -> int:
    for _ in range(8):
        byte = (byte >> 1) ^ (0xEDB88320 if byte & 1 else 0)
    return byte


#: A table ``crc`` of one row with the list ``t``, and the CRC-32 of a string by it.
CRC_TABLE = f"crc as (select [{', '.join(str(_crc_steps(b)) for b in range(256))}]::bigint[] as t)"


def crc32(text: str) -> str:
    octets = f"list_transform(range(1, strlen({text}) + 1), lambda k: ('0x' || substr(hex({text}), 2 * k - 1, 2))::bigint)"
    return f"xor(list_reduce({octets}, lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295::bigint), 4294967295::bigint)"


VARIANTS = f"""
with recursive {CRC_TABLE},
runs as (select doc_id, unnest(regexp_extract_all({_FOLDED}, '[A-Za-zÀ-ÿ]+')) as run from documents),
counted as (select doc_id, run, count(*) as times from runs where length(run) >= 7 group by all),
hashed as (select run, times, {crc32("(doc_id || ':' || run)")} as h from counted, crc),
slipped as (
  select case when h % 31 = 0 then substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) else run end as word, times from hashed),
words as (select word, cast(sum(times) as bigint) as n from slipped where length(word) >= 7 group by word having sum(times) >= 2),
less as (select word, length(word) as chars, k, substr(word, 1, k - 1) || substr(word, k + 1) as rest
         from (select word, unnest(range(1, length(word) + 1)) as k from words)),
pairs as (
  select a.word as x, b.word as y from less a join less b using (k, rest) where a.word <> b.word
  union select word, rest from less where rest in (select word from words)
  union select rest, word from less where rest in (select word from words)),
ranked as (
  select x, y, n, count(*) over (partition by x) as n_near, row_number() over (partition by x order by n desc, y) as place
  from pairs join words on y = word),
formed as (
  select w.word, w.n, coalesce(n_near, 0) as n_near, case when r.n >= 10 * w.n then y end as form, case when r.n >= 10 * w.n then r.n end as form_n
  from words w left join ranked r on r.x = w.word and place = 1),
chain as (
  select word, word as at from formed
  union all select c.word, f.form from chain c join formed f on f.word = c.at where f.form is not null)
select f.word, f.form, c.at as root, f.n, f.n_near, f.form_n
from formed f join chain c using (word) join formed e on e.word = c.at where e.form is null
"""

#: Levels of a tree in the SQL of the manifest: 16 ** LEVELS leaves at most.
LEVELS = 6


def _trees(leaves: str, prefix: str) -> list[str]:
    """Common tables of the trees over ``leaves`` (tree, idx, h): levels PREFIX0.., the runs of each, and PREFIX_root."""
    made = [f"{prefix}0 as (select tree, idx, h, count(*) over (partition by tree) as size from {leaves})"]
    for k in range(LEVELS):
        made.append(f"{prefix}_runs{k} as (select tree, idx // 16 as run, list(h order by idx) as hs from {prefix}{k} where size > 1 group by all)")
        made.append(
            f"{prefix}{k + 1} as (select tree, run as idx, sha256(array_to_string(hs, '')) as h, count(*) over (partition by tree) as size from {prefix}_runs{k})"
        )
    roots = " union all ".join(f"select tree, h from {prefix}{k} where size = 1" for k in range(LEVELS + 1))
    return [*made, f"{prefix}_root as ({roots})"]


def _ways(start: str, prefix: str) -> list[str]:
    """Common tables that lead ``start`` (keys, tree, idx, f, proof) up the levels of PREFIX, siblings added to proof."""
    made, before = [], start
    for k in range(LEVELS):
        near = "hs[: idx % 16] , hs[idx % 16 + 2 :]"
        left, right = (f"array_to_string({p.strip()}, '')" for p in near.split(" , "))
        made.append(
            f"{prefix}_way{k} as (select doc, row_no, leaf, w.tree, idx // 16 as idx, case when hs is null then f else sha256({left} || f || {right}) end as f, "
            f"proof || case when hs is null then '' else {left} || {right} end as proof "
            f"from {before} w left join {prefix}_runs{k} r on r.tree = w.tree and r.run = w.idx // 16)"
        )
        before = f"{prefix}_way{k}"
    return made


def _field(c: str) -> str:
    return f"case when {c} is null then '-' else strlen(cast({c} as varchar)) || ':' || {c} end"


_LEAF = " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars", "text"))
_TAMPERED = " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars", f"case when text is not null then {_FOLDED} end"))

MANIFEST = f"""
with {CRC_TABLE},
hashed as (
  select doc_id, source, row_number() over () as row_no, sha256({_LEAF}) as h,
         case when doc_id is not null and {crc32("cast(doc_id as varchar)")} % 5 = 0 then sha256({_TAMPERED}) else sha256({_LEAF}) end as changed
  from documents, crc),
sources as (select source, row_number() over (order by source nulls first) - 1 as tree from (select distinct source from hashed)),
leaves as (
  select doc_id, row_no, h, changed, tree, row_number() over (partition by tree order by doc_id nulls first, h) - 1 as idx
  from hashed d join sources s on d.source is not distinct from s.source),
{", ".join(_trees("leaves", "s"))},
tops as (select 0 as tree, tree as idx, h from s_root),
{", ".join(_trees("tops", "t"))},
begun as (select doc_id as doc, row_no, h as leaf, tree, idx, changed as f, '' as proof from leaves),
{", ".join(_ways("begun", "s"))},
between as (select doc, row_no, leaf, 0 as tree, tree as idx, f, proof from s_way{LEVELS - 1}),
{", ".join(_ways("between", "t"))}
select e.doc as doc_id, e.leaf, r.h as subroot, t_root.h as root, sha256(e.proof) as proof_sha256, e.f as folded_root, e.f = t_root.h as verified
from t_way{LEVELS - 1} e join leaves l using (row_no) join s_root r on r.tree = l.tree, t_root
"""

MINHASH = rf"""
with recursive words as (select doc_id, regexp_extract_all({_FOLDED}, '[^\x20\x09-\x0D]+') as w from documents),
sets as (
  select doc_id, list_sort(list_distinct(case when len(w) < 2 then w else list_transform(range(1, len(w)), lambda k: w[k] || ' ' || w[k + 1]) end)) as s
  from words),
nodes as (select s, len(s) as n, min(doc_id) as node from sets where len(s) > 0 group by s),
shingles as (select node, n, unnest(s) as shingle from nodes),
links as (
  select a.node as a, b.node as b from shingles a join shingles b using (shingle)
  where a.node <> b.node and 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  group by a.node, b.node, a.n, b.n having 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reached as (select node, node as r from nodes union select node, b from reached join links on a = r),
classes as (select node, min(r) as component_id from reached group by node)
select doc_id, len(sets.s) as n_shingles, coalesce(component_id, doc_id) as component_id, doc_id = coalesce(component_id, doc_id) as kept
from sets left join nodes on nodes.s = sets.s left join classes using (node)
"""
