"""DuckDB SQL of the operators that SQL can express."""

from __future__ import annotations

TOP_K = """
with v as (
    select row_number() over () as rid, vec_id,
           list_transform(embedding, lambda x: floor(64 * x::double)) as v
    from embeddings
    where embedding is not null
      and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
),
scored as (
    select q.rid, q.vec_id as query_id, c.vec_id,
           cast(list_dot_product(q.v, c.v) as bigint) as score
    from v q join v c on q.rid <> c.rid
    where q.vec_id % 20 = 0
)
select query_id,
       cast(row_number() over (partition by rid order by score desc, vec_id) as int) as rank,
       vec_id, score
from scored
qualify rank <= 20
"""

MIXING = r"""
with sized as (
    select doc_id, source, coalesce(text, '') as t,
           cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) as size
    from documents
),
keyed as (
    select doc_id, source, size,
           -ln((cast('0x' || substr(md5(coalesce(cast(doc_id as varchar), '') || '|' || t), 1, 13)
                as bigint) + 0.5::double) / 4503599627370496.0::double)
           / greatest(0.05::double, coalesce(
                 length(regexp_replace(t, '[^\p{L}\x20\n]', '', 'g'))::double
                 / nullif(length(t), 0), 0.05::double)) as k
    from sized
),
weighted as (
    select source, cast(sum(size) as bigint) as source_size,
           [5, 2, 1][1 + (row_number() over (order by source is null, source) - 1) % 3] as weight
    from keyed group by source
),
ranked as (
    select *, sum(source_size) over () as everything, 3 * source_size as cap,
           sum(source_size) over ()
               - coalesce(sum(3 * source_size) over before, 0) as remaining,
           sum(weight) over () - coalesce(sum(weight) over before, 0) as heavy
    from weighted
    window before as (order by 3 * source_size / weight, source is null, source
                      rows between unbounded preceding and 1 preceding)
),
capped as (select *, weight * remaining > cap * heavy as full_ from ranked),
goal as (
    select source, source_size,
           case when full_ then cap::double
                else (weight * (everything - sum(case when full_ then cap else 0 end) over ()))::double
                     / (sum(case when full_ then 0 else weight end) over ())::double end as target
    from capped
),
placed as (
    select k.*, g.source_size, g.target,
           coalesce(sum(size) over (partition by k.source order by k, doc_id, size
                    rows between unbounded preceding and 1 preceding), 0) as before,
           coalesce(floor(g.target / nullif(g.source_size, 0)), 0) as epochs
    from keyed k join goal g on k.source is not distinct from g.source
)
select doc_id, size, source_size, target,
       cast(epochs * size + least(greatest(floor(target - epochs * source_size) - before, 0), size)
            as bigint) as taken
from placed
"""


FILTER_AUDIT = r"""
with docs as (
    select doc_id, coalesce(lang, '') as part, coalesce(text, '') as t,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w,
           min(doc_id) over (partition by coalesce(text, '')) as least
    from documents
),
failing as (
    select doc_id, part, len(w) < 200 as a, 100 * len(list_distinct(w)) < 50 * len(w) as b,
           100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) as c,
           regexp_matches(t, '[#$%&*|]') as d, coalesce(doc_id > least, false) as e
    from docs
),
marked as (
    select doc_id, max(coalesce(quality = 1, false)) as good, max(coalesce(toxic = 1, false)) as toxic
    from labels group by doc_id
),
masks as (
    select part, concat(case when a then 'A' else '' end, case when b then 'B' else '' end,
                        case when c then 'C' else '' end, case when d then 'D' else '' end,
                        case when e then 'E' else '' end) as fails,
           count(*) as n, count(*) filter (where good) as good, count(*) filter (where toxic) as toxic
    from failing left join marked using (doc_id)
    group by 1, 2
),
letters as (select unnest(['A', 'B', 'C', 'D', 'E']) as x),
orders as (
    select concat(p.x, q.x, r.x, s.x, t.x) as filter_order
    from letters p, letters q, letters r, letters s, letters t
    where len(list_distinct([p.x, q.x, r.x, s.x, t.x])) = 5
),
steps as (
    select filter_order, unnest([1, 2, 3, 4, 5]) as step from orders
),
counted as (
    select part, filter_order, step, filter_order[step] as letter, m.n, m.good, m.toxic, m.fails,
           contains(m.fails, filter_order[step]) as failed,
           not regexp_matches(m.fails, '[' || filter_order[1:step - 1] || '.]') as reached
    from masks m, steps
),
summed as (
    select part, filter_order, step, letter,
           cast(sum(case when reached and not failed then n else 0 end) as bigint) as kept,
           cast(sum(case when reached and failed then n else 0 end) as bigint) as removed,
           cast(sum(case when failed and not reached then n else 0 end) as bigint) as redundant,
           cast(sum(case when fails = letter then n else 0 end) as bigint) as unique_fails,
           cast(sum(case when reached and failed then good else 0 end) as bigint) as good_lost,
           cast(sum(case when reached and failed then toxic else 0 end) as bigint) as toxic_lost
    from counted group by all
)
select part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       cast(sum(removed) over (partition by part, letter) as bigint) as shapley
from summed
"""


def _clustering(k: int = 40, rounds: int = 5) -> str:
    """Assignments and updates of every round, one after the other."""
    text = f"""
with vectors as materialized (
    select row_number() over () as rid, vec_id,
           list_transform(embedding, lambda x: cast(floor(256 * x::double) as bigint)) as v
    from embeddings
    where len(embedding) = 64
      and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
),
c0 as materialized (
    select cast(row_number() over (order by sha256('2:' || coalesce(cast(vec_id as varchar), '')), v)
                as int) - 1 as cluster, v as c
    from vectors
    qualify cluster < {k}
)"""
    for t in range(rounds + 1):
        text += f""",
a{t} as materialized (
    select rid, vec_id, v, cluster,
           list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) as distance
    from vectors, c{t}
    qualify row_number() over (partition by rid order by distance, cluster) = 1
)"""
        if t < rounds:
            text += f""",
m{t} as materialized (
    select cluster, list(x order by i) as c
    from (select cluster, i, cast((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*)
                                  as bigint) as x
          from (select cluster, unnest(v) as x, generate_subscripts(v, 1) as i from a{t})
          group by cluster, i)
    group by cluster
),
c{t + 1} as materialized (
    select cluster, coalesce(m{t}.c, c{t}.c) as c from c{t} left join m{t} using (cluster)
)"""
    return text + f"""
select vec_id, cluster, cast(distance as bigint) as distance,
       cast(sum(distance) over (partition by cluster) as bigint) as cluster_inertia,
       cast(sum(distance) over () as bigint) as inertia,
       sha256(array_to_string(c, ',')) as centroid_sha256
from a{rounds} join c{rounds} using (cluster)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op7_source_mixing": MIXING,
        "op9_top_k": TOP_K,
        "op12_centroid_clustering": _clustering(),
        "op13_filter_audit": FILTER_AUDIT,
    }
