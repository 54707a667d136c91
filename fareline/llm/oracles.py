"""DuckDB SQL for the numbered queries that SQL can express."""

ORACLES: dict[str, str] = {}

ORACLES["op4_warc"] = """
with p as (select page_id, encode(coalesce(html, '')) as body from pages),
d as (select page_id, octet_length(body) as payload_bytes, sha256(body) as payload_digest from p),
f as (select payload_digest, min(page_id) as first_id from d where payload_bytes >= 100 group by 1)
select d.page_id, cast(payload_bytes as bigint) as payload_bytes, payload_digest,
       case when payload_bytes >= 100 and d.page_id > first_id then 'revisit' else 'response' end as record_type,
       case when payload_bytes >= 100 and d.page_id > first_id then first_id end as refers_to
from d left join f using (payload_digest)
"""

ORACLES["op5_chat_masks"] = r"""
with c as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '\### Assistant: </turn> ok' union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e as (select *, length(replace(replace(role, '\', '\\'), '<|', '<\|')) + length(replace(replace(text, '\', '\\'), '<|', '<\|')) + 8 + 8 + 7 as chars from c)
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
       cast(coalesce(sum(length(text)) filter (where role = 'assistant'), 0) as bigint) as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn, text) filter (where role = 'assistant'), '')) as loss_sha256,
       cast(sum(chars) as bigint) as formatted_chars
from e group by conv_id
"""

ORACLES["op1_minhash_dedup"] = r"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as ws from documents),
s as (select doc_id, case when len(ws) = 0 then [] when len(ws) = 1 then [ws[1]]
        else list_distinct(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) end as sh from w),
n as (select doc_id, len(sh) as n, list_sort(sh) as sh from s),
u as (select min(doc_id) as node, any_value(n) as n, any_value(sh) as sh from n where n > 0 group by hash(sh), n, sh),
x as (select node, n, unnest(sh) as g from u),
i as (select a.node as a, b.node as b, count(*) as k, any_value(a.n) as na, any_value(b.n) as nb
      from x a join x b on a.g = b.g and a.node < b.node and 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n) group by 1, 2),
l as (select a, b from i where 100 * k >= 80 * (na + nb - k) union all select b, a from i where 100 * k >= 80 * (na + nb - k)),
r as (select node, node as root from u union select l.b, r.root from r join l on l.a = r.node),
c as (select node, min(root) as comp from r group by 1)
select n.doc_id, cast(n.n as bigint) as n_shingles, coalesce(c.comp, n.doc_id) as component_id, n.doc_id = coalesce(c.comp, n.doc_id) as kept
from n left join u on n.n > 0 and u.sh = n.sh left join c on c.node = u.node
"""

_SAINTE_LAGUE = """
{name}_a as (select *, sum({votes}) over (partition by {group}) as vs, count(*) over (partition by {group}) as m from {src}),
{name}_q as (select {keys}, {votes} as v, unnest(range(0, cast(case when vs > 0 then ceil({votes} * {seats} / vs) + m + 1 else 0 end as bigint))) as k, {seats} as seats from {name}_a),
{name}_r as (select *, row_number() over (partition by {group} order by v / (2 * k + 1) desc, {last}, k) as rk from {name}_q where v > 0),
{name} as (select {keys}, count(*) as quota from {name}_r where rk <= seats group by {keys})
"""

ORACLES["op9_mixing"] = (
    r"""
with d as (select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) as size,
             cast('0x' || substr(md5('9|' || coalesce(cast(doc_id as varchar), '') || '|' || coalesce(text, '')), 1, 15) as bigint) as rk from documents),
s0 as (select source, count(*) as n, sum(size) as source_size from d group by 1),
s1 as (select *, row_number() over (order by source nulls last) - 1 as sid from s0),
s2 as (select *, [5.0, 2.0, 1.0][cast(sid % 3 as int) + 1]::double as w, 3 * source_size::double as cap, (sum(source_size) over ())::double as total from s1),
s3 as (select *, total - coalesce(sum(cap) over o, 0) as rest, sum(w) over () - coalesce(sum(w) over o, 0) as ow from s2
       window o as (order by cap / w, sid rows between unbounded preceding and 1 preceding)),
s4 as (select *, w * rest / ow >= cap as cut from s3),
s5 as (select *, case when cut then cap else w * (total - sum(case when cut then cap else 0 end) over ()) / sum(case when cut then 0 else w end) over () end as target from s4),
src as (select sid, target, floor(total / 64 + 0.5) as seats from s5),
"""
    + _SAINTE_LAGUE.format(name="q1", src="src", group="1", votes="target", seats="seats", keys="sid", last="sid")
    + r""",
p as (select d.*, s5.sid, s5.source_size, s5.target, rk % greatest(1, cast(ceil(s5.n / 4096) as bigint)) as cell from d join s5 on d.source is not distinct from s5.source),
cl as (select p.sid, cell, sum(size)::double as words, any_value(coalesce(q1.quota, 0)) as seats from p left join q1 on q1.sid = p.sid group by 1, 2),
"""
    + _SAINTE_LAGUE.format(name="q2", src="cl", group="sid", votes="words", seats="seats", keys="sid, cell", last="cell")
    + r""",
t as (select cl.sid, cl.cell, cl.words, least(coalesce(q2.quota, 0) * 64, 3 * cl.words) as take from cl left join q2 on cl.sid = q2.sid and cl.cell = q2.cell),
f as (select *, case when words > 0 then floor(take / words) else 0 end as passes from t),
z as (select p.*, passes, take - passes * words as rest, sum(size) over (partition by p.sid, p.cell order by rk, size rows between unbounded preceding and current row) as hi
      from p join f on f.sid = p.sid and f.cell = p.cell)
select doc_id, size, cast(source_size as bigint) as source_size, target, cast(passes * size + greatest(0, least(hi, rest) - (hi - size)) as bigint) as taken, source from z
"""
)


def _edit_sql() -> str:
    """The cheapest edits by dynamic programming from the last row, a key of cost and letters each."""
    step = lambda k, cost, letter: f"lpad(cast(cast(substr({k}, 1, 9) as int) + {cost} as varchar), 9, '0') || '{letter}' || substr({k}, 10)"
    nexts, keeps = (2, 2, 3, 2), ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
    rows = []
    for q in range(4):
        keep = " ".join(f"when ini = '{r}' then {step(f'k{to}', 'more', 'K')}" for r, to in keeps[q].items())
        rows.append(f"least({step(f'k{q}', 4, 'D')}, case when gone then null {keep} end, case when not gone then {step(f'k{nexts[q]}', '3 + more', 'R')} end) as n{q}")
    insert = lambda k: step(k, 3, "I")
    v2, v3 = f"least(n2, {insert('n3')})", f"least(n3, {insert('n2')})"
    return f"""
s as (select conv_id, n as i, '000000000' as k0, '000000006II' as k1, '000000003I' as k2, '000000000' as k3 from (select conv_id, count(*) as n from f group by 1)
      union all
      select conv_id, i - 1, least(n0, {insert(v2)}), least(n1, {insert(v2)}), {v2}, {v3}
      from (select s.conv_id, s.i, {", ".join(rows)} from s join f on f.conv_id is not distinct from s.conv_id and f.rn = s.i)),
"""


ORACLES["op12_conversation_repair"] = (
    r"""
with recursive c as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
         coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' ') as k from conversations),
m as (select *, xor(4294967295, list_reduce(list_concat([4294967295::bigint], list_transform(range(1, length(k) + 1), lambda i: ascii(substr(k, i, 1))::bigint)),
        lambda x, b: list_reduce(list_concat([xor(x, b)], [0, 0, 0, 0, 0, 0, 0, 0]::bigint[]), lambda y, z: xor(y >> 1, 3988292384 * (y & 1))))) % 20 as hit from c),
d as (select conv_id, turn, case when hit = 4 then 'user' else role end as role,
             case when hit = 1 then '' when hit = 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text, unnest(range(0, case when hit = 3 then 2 else 1 end)) as copy from m where hit <> 0),
r as (select *, row_number() over (partition by conv_id order by turn nulls first, role, md5(cast(length(role) as varchar) || ':' || role || text)) as rn from d),
g as (select conv_id, turn, role, text, rn, substr(role, 1, 1) as ini, not regexp_matches(text, '[^ 	-
]') as blank,
             row_number() over (partition by conv_id, role, text order by rn) > 1 as again, not regexp_matches(text, '[.!?][ 	-
]*$') as cut,
             lag(substr(role, 1, 1)) over (partition by conv_id order by rn) as before from r),
f as (select *, blank or again as gone, case when cut then 3 else 0 end as more from g),
"""
    + _edit_sql()
    + r"""
a as (select conv_id, cast(substr(k0, 1, 9) as bigint) as cost, substr(k0, 10) as audit from s where i = 0),
l as (select conv_id, j, substr(audit, j, 1) as letter from (select conv_id, audit, unnest(range(1, length(audit) + 1)) as j from a)),
e as (select *, sum(case when letter <> 'I' then 1 else 0 end) over w as rn, sum(case when letter <> 'D' then 1 else 0 end) over w as said from l
      window w as (partition by conv_id order by j)),
x as (select e.conv_id, j, letter, said, case when letter = 'I' then '' else f.text end as text, f.role, letter = 'K' and f.ini = 's' as sys
      from e left join f on f.conv_id is not distinct from e.conv_id and f.rn = e.rn and e.letter <> 'I'),
y as (select *, bool_or(coalesce(sys, false)) over (partition by conv_id) as has_sys from x),
z as (select conv_id, sha256(string_agg(case when letter = 'K' then role when (said - 1 - cast(has_sys as int)) % 2 = 0 then 'user' else 'assistant' end || ':' || text, chr(10) order by j)) as repaired_sha256
      from y where letter <> 'D' group by 1),
n as (select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (where blank) as blank,
             count(*) filter (where again and not blank) as duplicate, count(*) filter (where cut and not gone) as truncated,
             count(*) filter (where before is not null and before || ini not in ('su', 'ua', 'au')) as illegal from f group by 1),
o as (select distinct conv_id from conversations)
select o.conv_id, cast(coalesce(gaps, 0) as bigint) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate, coalesce(truncated, 0) as truncated,
       coalesce(illegal, 0) as illegal, coalesce(cost, 0) as cost, coalesce(audit, '') as audit, coalesce(repaired_sha256, sha256('')) as repaired_sha256
from o left join n on n.conv_id is not distinct from o.conv_id left join a on a.conv_id is not distinct from o.conv_id left join z on z.conv_id is not distinct from o.conv_id
"""
)


def _codebook_sql() -> str:
    """Two rounds of nearest entries and floored means, then the last assignment."""
    nearest = """
a{n} as (select rid, part, min(d * 64 + entry) % 64 as entry, min(d * 64 + entry) // 64 as d from (
       select x.rid, x.part, c.entry, cast(sum((x.v - c.v) * (x.v - c.v)) as hugeint) as d from x join c{n} c on c.part = x.part and c.pos = x.pos group by all) group by all),"""
    means = """
m{n} as (select x.part, a.entry, x.pos, sum(x.v) as s, count(*) as n from x join a{o} a on a.rid = x.rid and a.part = x.part group by all),
c{n} as (select c.part, c.entry, c.pos, case when m.n is null then c.v else cast((m.s - ((m.s % m.n) + m.n) % m.n) // m.n as bigint) end as v
       from c{o} c left join m{n} m on m.part = c.part and m.entry = c.entry and m.pos = c.pos),"""
    return nearest.format(n=0) + means.format(n=1, o=0) + nearest.format(n=1) + means.format(n=2, o=1) + nearest.format(n=2)


ORACLES["op13_vector_codes"] = (
    """
with k as (select row_number() over (order by vec_id nulls last, embedding) as rid, vec_id, label, embedding, len(embedding) // 16 as w from embeddings
           where embedding is not null and len(list_filter(embedding, lambda v: v is null or not isfinite(v))) = 0),
x as (select rid, (p - 1) // w as part, (p - 1) % w as pos, cast(floor(256 * cast(embedding[p] as double)) as bigint) as v from (select *, unnest(range(1, len(embedding) + 1)) as p from k)),
c0 as (select part, rid - 1 as entry, pos, v from x where rid <= 64),
"""
    + _codebook_sql().strip()
    + """
h as (select sha256(string_agg(v, ',' order by part, entry, pos)) as codebooks_sha256 from c2),
r as (select rid, string_agg(printf('%02x', cast(entry as int)), '' order by part) as code, cast(sum(d) as bigint) as error from a2 group by 1)
select k.vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error, codebooks_sha256 from k join r using (rid) cross join h
"""
)
