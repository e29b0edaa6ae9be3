"""SQL twin of `clusters.cluster`: rounds as common table expressions."""

from __future__ import annotations

from .clusters import DIMS, K, ROUNDS, SCALE, SEED


def cluster_sql(k: int = K, rounds: int = ROUNDS, dims: int = DIMS, scale: int = SCALE, seed: int = SEED) -> str:
    far = "list_sum(list_transform(list_zip(x.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
    sql = f"""with e as (select row_number() over () rid, vec_id, list_transform(embedding, lambda y: cast(y as double)) v from embeddings where len(embedding) = {dims}),
x as materialized (select rid, vec_id, list_transform(v, lambda y: cast(floor({scale} * y) as bigint)) v from e where len(list_filter(v, lambda y: y is not null and isfinite(y))) = {dims}),
c0 as materialized (select cast(row_number() over (order by sha256('{seed}:' || vec_id) nulls last, v) - 1 as integer) id, v from x qualify id < {k})"""
    for n in range(rounds + 1):
        sql += f""",
a{n} as materialized (select x.rid, x.vec_id, x.v, c.id, {far} d from x, c{n} c qualify row_number() over (partition by x.rid order by d, c.id) = 1)"""
        if n < rounds:
            sql += f""",
s{n} as (select id, i, sum(v[i]) s, count(*) n from a{n}, range(1, {dims + 1}) t(i) group by id, i),
c{n + 1} as materialized (select c.id, coalesce(m.v, c.v) v from c{n} c left join (select id, list(cast((s - ((s % n) + n) % n) // n as bigint) order by i) v from s{n} group by id) m using (id))"""
    return sql + f""",
t as (select id, sum(d) s, sum(sum(d)) over () every from a{rounds} group by id)
select vec_id, a.id cluster, cast(d as bigint) distance, cast(s as bigint) cluster_inertia, cast(every as bigint) inertia, sha256(array_to_string(c.v, ',')) centroid_sha256 from a{rounds} a join t using (id) join c{rounds} c using (id)"""
