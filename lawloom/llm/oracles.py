"""DuckDB SQL for the queries that SQL can express whole; the others depend on a tokenizer, a model, a hash or a free layout."""

from __future__ import annotations


def components(nodes: str, links: str) -> str:
    """Tables ``reach`` and ``labels`` (id, label): the least node that ``links`` (a, b, both ways) reach from each of ``nodes`` (id)."""
    return f"""reach as (select id, id as label from {nodes} union select l.b, r.label from reach r join {links} l on l.a = r.id where r.label < l.b), labels as (select id, min(label) as label from reach group by id)"""


def near_vectors(cosine: float) -> str:
    return f"""with recursive v as (select vec_id as id, list_transform(embedding, lambda x: x::double) as e from embeddings),
  n as (select id, e, sqrt(list_inner_product(e, e)) as s from v where id is not null and len(e) > 0 and len(list_filter(e, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(e, lambda x: x <> 0)) > 0),
  l as (select x.id as a, y.id as b from n x join n y on x.id <> y.id and len(x.e) = len(y.e) and list_inner_product(x.e, y.e) / (x.s * y.s) >= {cosine}), {components('v', 'l')}, c as (select a, count(*) as k from l group by a)
  select v.id as vec_id, coalesce(k, 0) as n_links, label as component_id, v.id = label as kept from v join labels on labels.id = v.id left join c on c.a = v.id"""


def near_documents(words: int, percent: int) -> str:
    return f"""with recursive w as (select doc_id as id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') as w from documents),
  s as (select id, case when len(w) = 0 then [] when len(w) < {words} then [array_to_string(w, ' ')] else list_distinct(list_transform(range(1, len(w) - {words - 2}), lambda i: array_to_string(w[i:i + {words - 1}], ' '))) end as s from w),
  u as (select id, len(s) as n, unnest(s) as g from s), p as (select x.id as a, y.id as b from u x join u y on x.g = y.g and x.id < y.id group by x.id, y.id, x.n, y.n having 100 * count(*) >= {percent} * (x.n + y.n - count(*))),
  l as (select a, b from p union all select b, a from p), {components('s', 'l')}
  select s.id as doc_id, len(s) as n_shingles, label as component_id, s.id = label as kept from s join labels on labels.id = s.id"""


def repeated_strings(length: int, passage: int) -> str:
    def covered(name: str, size: int) -> str:
        """Runs (id, a, b) of bytes in windows of this size that begin elsewhere too; texts are in hexadecimal."""
        return f"""{name}w as (select id, i, md5(substr(h, 2 * i + 1, {2 * size})) as m from (select id, h, unnest(range(0, n - {size - 1})) as i from d)), {name}r as (select m from {name}w group by m having count(*) > 1),
  {name}s as (select id, i, case when i > lag(i) over (partition by id order by i) + {size} then 1 else 0 end as fresh from {name}w where m in (select m from {name}r)), {name}g as (select id, i, sum(fresh) over (partition by id order by i) as g from {name}s),
  {name} as (select id, min(i) as a, max(i) + {size} as b from {name}g group by id, g)"""

    return f"""with d as (select doc_id as id, hex(encode(coalesce(text, ''))) as h, octet_length(encode(coalesce(text, ''))) as n from documents), {covered('x', length)}, {covered('y', passage)},
  k as (select x.id, substr(h, 2 * coalesce(lag(b) over (partition by x.id order by a), 0) + 1, 2 * (a - coalesce(lag(b) over (partition by x.id order by a), 0))) as piece, a from x join d on d.id = x.id),
  t as (select x.id, string_agg(piece, '' order by k.a) || substr(any_value(h), 2 * max(b) + 1) as kept, cast(sum(b - x.a) as bigint) as removed, count(*) as spans from x join k on k.id = x.id and k.a = x.a join d on d.id = x.id group by x.id), z as (select id, cast(sum(b - a) as bigint) as bytes from y group by id)
  select d.id as doc_id, n as n_bytes, coalesce(removed, 0) as n_removed, coalesce(spans, 0) as n_spans, sha256(unhex(coalesce(kept, h))) as kept_sha256, coalesce(bytes, 0) as n_passage_bytes from d left join t on t.id = d.id left join z on z.id = d.id"""


def filter_orders(filters: str) -> str:
    """Every order of the filters by its states: the set of filters before a step decides what the step removes."""
    n = len(filters)
    bit = lambda f: f"({1 << filters.index('A')} << (ascii({f}) - ascii('A')))"
    fails = {"A": "len(w) < 200", "B": "100 * len(list_distinct(w)) < 50 * len(w)", "C": "100 * len(regexp_extract_all(t, '[A-Z]')) > 3 * length(t)", "D": "regexp_matches(t, '[#$%&*|]')", "E": "coalesce(doc_id > min(doc_id) over (partition by t), false)"}
    mask = " + ".join(f"case when {fails[f]} then {1 << i} else 0 end" for i, f in enumerate(filters))
    return f"""with recursive d as (select doc_id, coalesce(lang, '') as part, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as w from documents),
  l as (select doc_id, bool_or(quality = 1) as good, bool_or(toxic = 1) as toxic from labels group by doc_id),
  m as (select part, {mask} as m, coalesce(good, false) as good, coalesce(toxic, false) as toxic from d left join l using (doc_id)), g as (select part, m, count(*) as n, count(*) filter (where good) as good, count(*) filter (where toxic) as toxic from m group by part, m),
  o as (select '' as filter_order, 0 as step, '' as filter, 0 as before, 0 as state union all select filter_order || f, step + 1, f, state, state | {bit('f')} from o, (select unnest(string_split('{",".join(filters)}', ',')) as f) where step < {n} and not contains(filter_order, f)),
  full_orders as (select filter_order as whole from o where step = {n}), s as (select whole as filter_order, step, filter, before, state from full_orders, o where step > 0 and starts_with(whole, o.filter_order)),
  e as (select distinct filter, before, state from s), c as (select part, filter, before, cast(coalesce(sum(n) filter (where m & state = 0), 0) as bigint) as kept, cast(coalesce(sum(n) filter (where m & before = 0 and m & {bit('filter')} <> 0), 0) as bigint) as removed, cast(coalesce(sum(n) filter (where m & before <> 0 and m & {bit('filter')} <> 0), 0) as bigint) as redundant,
  cast(coalesce(sum(n) filter (where m = {bit('filter')}), 0) as bigint) as unique_fails, cast(coalesce(sum(good) filter (where m & before = 0 and m & {bit('filter')} <> 0), 0) as bigint) as good_lost, cast(coalesce(sum(toxic) filter (where m & before = 0 and m & {bit('filter')} <> 0), 0) as bigint) as toxic_lost from g, e group by part, filter, before),
  r as (select part, filter_order, step, s.filter, kept, removed, redundant, unique_fails, good_lost, toxic_lost from s join c on c.filter = s.filter and c.before = s.before)
  select *, cast(sum(removed) over (partition by part, filter) as bigint) as shapley from r"""


def hard_negatives(every: int = 100, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100) -> str:
    return f"""with v as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, list_transform(embedding, lambda x: floor(256 * x::double)) as q from embeddings where vec_id is not null and label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
  s as (select a.vec_id as anchor_id, b.vec_id, a.label = b.label as same, cast(list_inner_product(a.q, b.q) as bigint) as score from v a join v b on a.vec_id % {every} = 0 and a.vec_id <> b.vec_id and len(a.q) = len(b.q)),
  p as (select anchor_id, vec_id as positive_id, score as positive_score from (select *, row_number() over (partition by anchor_id order by score desc, vec_id) as k from s where same) where k <= {positives}),
  n as (select p.*, s.vec_id as negative_id, s.score as negative_score, cast(row_number() over (partition by p.anchor_id, positive_id order by s.score desc, s.vec_id) as int) as rank from p join s on s.anchor_id = p.anchor_id and not same and {low} * positive_score <= {high} * s.score and s.score <= positive_score)
  select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from n where rank <= {negatives}"""
