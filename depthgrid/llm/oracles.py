"""The queries' results in DuckDB SQL, where SQL can express them on whole tables."""

ORACLES: dict[str, str] = {
    "op5_mix_sources": """
        with sized as (
          select doc_id, source,
                 len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) as size
          from documents),
        totals as (select source, sum(size)::bigint as total from sized group by source),
        ranked as (
          select source, total, 3.0::double * total as cap,
                 [5.0::double, 2.0, 1.0][((row_number() over (order by encode(source) nulls last) - 1) % 3 + 1)::int] as w
          from totals),
        filled as (
          select *, cap / w as ratio,
                 coalesce(sum(cap) over (order by cap / w, source rows between unbounded preceding and 1 preceding), 0) as cap_before,
                 sum(w) over (order by cap / w, source rows between current row and unbounded following) as w_left,
                 sum(total) over () as whole
          from ranked),
        level as (
          select coalesce(arg_min((whole - cap_before) / w_left, ratio), 0) as share from filled
          where (whole - cap_before) / w_left <= ratio),
        targets as (
          select source, total, least(cap, w * (select share from level)) as target from ranked),
        rates as (
          select source, total, target, case when total > 0 then target / total else 0 end as rate
          from targets)
        select doc_id, size::bigint as size, total as source_size, target,
               (size * (floor(rate) + case when
                 ('0x' || substr(md5('mix-1:' || coalesce(doc_id::varchar, '')), 1, 13))::ubigint::double
                 / 4503599627370496.0 < rate - floor(rate) then 1 else 0 end))::bigint as taken
        from sized join rates on sized.source is not distinct from rates.source
    """,
    "op6_suffix_dedup": """
        with worded as (
          select doc_id, regexp_extract_all(translate(coalesce(text, ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\\x20\\x09-\\x0D]+') as w
          from documents where doc_id is not null),
        place as (
          select doc_id, w, unnest(range(0, len(w) - 49)) as i from worded where len(w) >= 50),
        win as (select doc_id, i, md5(array_to_string(w[i + 1:i + 50], ' ')) as h from place),
        again as (select h from win group by h having count(distinct doc_id) > 1),
        hit as (select doc_id, i, lag(i) over (partition by doc_id order by i) as p
                from win where h in (select h from again)),
        span as (select doc_id, i, sum(case when p is null or i > p + 50 then 1 else 0 end)
                   over (partition by doc_id order by i) as g from hit)
        select doc_id, min(i)::int as start_word, (max(i) + 50)::int as end_word,
               (max(i) + 50 - min(i))::int as n_words
        from span group by doc_id, g
    """,
    "op7_minhash_dedup": """
        with recursive worded as (
          select doc_id, regexp_extract_all(translate(coalesce(text, ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\\x20\\x09-\\x0D]+') as w
          from documents),
        shingle as (
          select distinct doc_id, s from (
            select doc_id, unnest(case when len(w) >= 5
                     then [array_to_string(w[i:i + 4], ' ') for i in range(1, len(w) - 3)]
                     when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as s
            from worded)),
        size as (select doc_id, count(*) as n from shingle group by doc_id),
        shared as (
          select a.doc_id as a, b.doc_id as b, count(*) as k
          from shingle a join shingle b on a.s = b.s and a.doc_id < b.doc_id group by all),
        link as (
          select a, b from shared join size x on x.doc_id = a join size y on y.doc_id = b
          where 100 * k >= 75 * (x.n + y.n - k)),
        edge as (select a as u, b as v from link union all select b, a from link),
        reach as (
          select doc_id as root, doc_id as node from documents
          union
          select reach.root, edge.v from reach join edge on edge.u = reach.node
          where edge.v > reach.root)
        select d.doc_id, coalesce(size.n, 0) as n_shingles, min(reach.root) as component_id,
               d.doc_id = min(reach.root) as kept
        from documents d left join size on size.doc_id = d.doc_id
        join reach on reach.node = d.doc_id
        group by d.doc_id, size.n
    """,
    "op8_exact_dedup": """
        with n as (
          select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                   'abcdefghijklmnopqrstuvwxyz') as t
          from documents),
        g as (select t, max(doc_id) as keep_id, count(*) as group_size from n group by t)
        select n.doc_id, g.keep_id, g.group_size, n.doc_id = g.keep_id as kept,
               sha256(n.t) as text_sha256
        from n join g on n.t = g.t
    """,
    "op10_decontaminate": """
        with worded as (
          select true as is_item, item_id as id, regexp_extract_all(translate(coalesce(text, ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\\x20\\x09-\\x0D]+') as w from benchmark
          union all
          select false, doc_id, regexp_extract_all(translate(coalesce(text, ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\\x20\\x09-\\x0D]+') from documents),
        shingle as (
          select distinct is_item, id, s from (
            select is_item, id, unnest(case when len(w) >= 5
                     then [array_to_string(w[i:i + 4], ' ') for i in range(1, len(w) - 3)]
                     when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as s
            from worded)),
        item as (select id, count(*) as n from shingle where is_item group by id),
        shared as (
          select d.id as doc_id, i.id as item_id, count(*) as k
          from shingle d join shingle i on d.s = i.s and i.is_item and not d.is_item group by all)
        select doc_id, item_id, n as n_item, k as n_shared, k / n::double as containment
        from shared join item on item.id = item_id where 100 * k >= 75 * n
    """,
}

def _clusters_sql(dims: int = 64, centroids: int = 40, rounds: int = 5) -> str:
    """Rounds written out one after the other: assign, then the floor of each mean."""
    parts = [
        f"""with kept as (
          select row_number() over () as r, vec_id,
                 list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v
          from embeddings
          where len(embedding) = {dims} and list_bool_and(list_transform(embedding, lambda x: coalesce(isfinite(x), false)))),
        c0 as (
          select row_number() over (order by sha256('2:' || vec_id), v) - 1 as c, v as m from kept
          qualify row_number() over (order by sha256('2:' || vec_id), v) <= {centroids})"""
    ]
    for k in range(rounds + 1):
        parts.append(
            f"""a{k} as materialized (
          select r, min(struct_pack(d := list_sum(list_transform(list_zip(v, m),
                   lambda z: (z[1] - z[2]) * (z[1] - z[2]))), c := c)) as best
          from kept cross join c{k} group by r)"""
        )
        if k < rounds:
            parts.append(
                f"""s{k} as (
          select a.best.c as c, i, sum(v[i])::bigint as s, count(*) as n
          from a{k} a join kept using (r) cross join range(1, {dims + 1}) t(i) group by all),
        c{k + 1} as materialized (
          select o.c, coalesce(moved.m, o.m) as m from c{k} o left join (
            select c, list((s - ((s % n) + n) % n) // n order by i) as m from s{k} group by c) moved
          on moved.c = o.c)"""
            )
    parts.append(
        f"""held as (
          select a.best.c as c, sum(a.best.d)::bigint as cluster_inertia from a{rounds} a group by a.best.c)"""
    )
    return ", ".join(parts) + f"""
        select vec_id, a.best.c::int as cluster, a.best.d::bigint as distance, cluster_inertia,
               (select sum(cluster_inertia)::bigint from held) as inertia,
               sha256(array_to_string(m, ',')) as centroid_sha256
        from a{rounds} a join kept using (r) join held on held.c = a.best.c join c{rounds} on c{rounds}.c = a.best.c
    """


ORACLES["op13_centroids"] = _clusters_sql()
