"""SQL of the operators on distributions, clusters and exact copies, for DuckDB."""

from __future__ import annotations

_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

# Checksums of all distinct runs side by side, a byte a round; ``crc`` is the table of one byte.
OP11 = (
    r"""
with recursive bits as (select i as b, 0 as step, cast(i as ubigint) as c from range(256) r(i)
  union all select b, step + 1, case when c & 1 = 1 then xor(c >> 1, 3988292384::ubigint) else c >> 1 end
  from bits where step < 8),
crc as (select b, c from bits where step = 8),
t as (select 'd' as kind, doc_id as id, text from documents union all select 'b', item_id, text from benchmark),
d as (select kind, id, regexp_extract_all(translate(coalesce(text, ''), {lower}), '[0-9a-z\x{80}-\x{10FFFF}]+') as w from t),
i as (select kind, id, w, k, unnest(range(1, greatest(len(w) - k + 2, 1))) as i from d, range(1, 4) r(k)),
f as (select kind, id, array_to_string(w[i : i + k - 1], ' ') as g, count(*) as n from i group by all),
step(g, h, pos, c) as (select g, hex(encode(g)), 1, 4294967295::ubigint from (select distinct g from f)
  union all select g, h, pos + 2, xor(s.c >> 8, crc.c) from step s
  join crc on crc.b = cast(xor(s.c & 255, cast(('0x' || substr(h, pos, 2)) as ubigint)) as bigint) where pos < length(h)),
bucket as (select g, xor(c, 4294967295::ubigint) % 10000 as b from step where pos > length(h)),
n as (select b, sum(case when kind = 'd' then n else 0 end) as s, sum(case when kind = 'b' then n else 0 end) as t
  from f join bucket using (g) group by b),
total as (select sum(s) as s, sum(t) as t from n),
gain as (select b, floor(1000 * ln(cast(n.t + 1 as double) * cast(total.s + 10000 as double)
  / (cast(n.s + 1 as double) * cast(total.t + 10000 as double)))) as gain from n, total),
x as (select id, sum(n) as n, sum(n * gain) as weight from f join bucket using (g) join gain using (b)
  where kind = 'd' group by id),
y as (select d.id as doc_id, len(w) as n_words, coalesce(x.n, 0) as n_features, coalesce(weight, 0) as weight,
  cast(('0x' || substr(sha256('42:' || d.id), 1, 8)) as ubigint) as h from d left join x on x.id = d.id where kind = 'd'),
z as (select *, weight + floor(-1000 * ln(-ln((cast(h as double) + 0.5) / 4294967296))) as score from y),
r as (select *, row_number() over (partition by n_words >= 20 order by score desc, doc_id) as r,
  count(*) over (partition by n_words >= 20) as able from z)
select doc_id, cast(n_words as bigint) as n_words, cast(n_features as bigint) as n_features, cast(weight as bigint) as weight,
  cast(score as bigint) as score, cast(case when n_words >= 20 and r <= 5 * able // 100 then r end as bigint) as rank from r
""".replace("{lower}", _LOWER)
)


def op12(k: int = 16, rounds: int = 3) -> str:
    """Rounds of assignment and update, one after the other, every vector against every centroid."""
    order = "row_number() over (order by sha256('1:' || vec_id))"
    parts = [
        f"""v as (select vec_id, list_transform(embedding, lambda x: cast(floor(64 * cast(x as double)) as bigint)) as p
  from embeddings where len(embedding) = 64 and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = 64),
c0 as (select {order} - 1 as c, p from v qualify {order} <= {k})"""
    ]
    for turn in range(rounds + 1):
        parts.append(
            f"""a{turn} as (select vec_id, v.p, c, list_sum(list_transform(list_zip(v.p, k.p), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) as d
  from v, c{turn} k qualify row_number() over (partition by vec_id order by d, c) = 1)"""
        )
        if turn < rounds:
            parts.append(
                f"""e{turn} as (select c, i, floor(sum(x) / count(*)) as x from
  (select c, unnest(p) as x, unnest(range(64)) as i from a{turn}) group by c, i),
m{turn} as (select c, list(cast(x as bigint) order by i) as p from e{turn} group by c),
c{turn + 1} as (select k.c, coalesce(m.p, k.p) as p from c{turn} k left join m{turn} m on m.c = k.c)"""
            )
    return f"""with {', '.join(parts)}
select vec_id, cast(a.c as int) as cluster, cast(d as bigint) as distance,
  cast(sum(d) over (partition by a.c) as bigint) as cluster_inertia, cast(sum(d) over () as bigint) as inertia,
  sha256(array_to_string(k.p, ',')) as centroid_sha256
from a{rounds} a join c{rounds} k on k.c = a.c"""


OP13 = f"""
with t as (select doc_id, translate(coalesce(text, ''), {_LOWER}) as t from documents)
select doc_id, max(doc_id) over (partition by t) as keep_id, count(*) over (partition by t) as group_size,
  doc_id = max(doc_id) over (partition by t) as kept, cast(strlen(t) as bigint) as n_bytes, sha256(t) as text_sha256 from t
"""
