"""Reference SQL of the registered queries."""

MIXING = r"""
with sized as (
  select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) as size,
    substr(md5(coalesce(cast(doc_id as varchar), '')), 1, 12) as h
  from documents),
by_source as (select source, cast(sum(size) as bigint) as source_size from sized group by source),
weighted as (
  select source, source_size, 2 * source_size as cap,
    case (row_number() over (order by source nulls last) - 1) % 3 when 0 then 5 when 1 then 2 else 1 end as weight
  from by_source),
leveled as (
  select *, row_number() over o as n,
    (cast(1.5 as double) * cast(sum(source_size) over () as double)
       - cast(sum(cap) over (o rows between unbounded preceding and current row) - cap as double))
      / cast(sum(weight) over (o rows between current row and unbounded following) as double) as level
  from weighted window o as (order by cast(cap as double) / cast(weight as double), source nulls last)),
water as (select arg_min(level, n) as level from leveled where cast(cap as double) / cast(weight as double) > level),
targets as (
  select l.source, l.source_size, least(cast(cap as double), coalesce(w.level * cast(weight as double), cast(cap as double))) as target
  from leveled l left join water w on true),
rests as (
  select *, case when source_size > 0 then floor(target / source_size) else 0 end as whole from targets),
grouped as (select source, h, sum(size) as words from sized group by source, h),
summed as (
  select *, sum(words) over (partition by source order by h rows between unbounded preceding and current row) as up_to
  from grouped),
copies as (
  select g.source, g.h, cast(r.whole as bigint) + case
      when g.up_to <= r.target - r.whole * r.source_size then 1
      when g.up_to - g.words <= r.target - r.whole * r.source_size
        and g.up_to - (r.target - r.whole * r.source_size) < (r.target - r.whole * r.source_size) - (g.up_to - g.words) then 1
      else 0 end as copies
  from summed g join rests r on g.source is not distinct from r.source)
select s.doc_id, s.size, r.source_size, r.target, cast(s.size * c.copies as bigint) as taken,
  case when s.size = 0 then cast(r.whole as bigint) else cast(c.copies as bigint) end as copies
from sized s join rests r on s.source is not distinct from r.source
join copies c on s.source is not distinct from c.source and s.h = c.h
"""

TOP_K = """
with usable as (
  select vec_id, list_transform(embedding, lambda x: floor(64 * cast(x as double))) as v
  from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select q.vec_id as query_id, c.vec_id, cast(list_inner_product(q.v, c.v) as bigint) as score
  from usable q join usable c on q.vec_id <> c.vec_id and len(q.v) = len(c.v)
  where q.vec_id % 20 = 0),
ranked as (
  select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank from scored)
select query_id, rank, vec_id, score from ranked where rank <= 20
"""

NGRAM_JOIN = r"""
with recursive tokens as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') as words
  from documents),
sets as (
  select doc_id, case when len(words) = 0 then [] when len(words) < 5 then [array_to_string(words, ' ')]
    else list_distinct(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' '))) end as s
  from tokens),
shingles as (select doc_id, len(s) as n, unnest(s) as shingle from sets),
held as (select shingle from shingles group by shingle having count(*) > 1),
rare as (select s.* from shingles s join held using (shingle)),
met as (
  select a.doc_id as x, b.doc_id as y, a.n as n_x, b.n as n_y, count(*) as shared
  from rare a join rare b on a.shingle = b.shingle and a.doc_id <> b.doc_id group by all),
links as (select x, y from met where 100 * shared >= 80 * (n_x + n_y - shared)),
reach as (
  select doc_id, doc_id as other from sets
  union
  select r.doc_id, l.y as other from reach r join links l on r.other = l.x)
select s.doc_id, cast(len(s.s) as bigint) as n_shingles, min(r.other) as component_id
from sets s join reach r on s.doc_id = r.doc_id group by s.doc_id, s.s
"""

VECTOR_DEDUP = """
with recursive usable as (
  select vec_id, label, list_transform(embedding, lambda x: cast(x as double)) as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0),
links as (
  select a.vec_id as x, b.vec_id as y from usable a join usable b
    on a.label = b.label and a.vec_id <> b.vec_id and len(a.v) = len(b.v)
  where list_cosine_similarity(a.v, b.v) >= 0.98),
reach as (
  select vec_id, vec_id as other from embeddings
  union
  select r.vec_id, l.y as other from reach r join links l on r.other = l.x),
found as (select vec_id, min(other) as component_id from reach group by vec_id),
counted as (select x, count(*) as n from links group by x)
select e.vec_id, cast(coalesce(c.n, 0) as bigint) as n_links, f.component_id, e.vec_id = f.component_id as kept
from embeddings e join found f using (vec_id) left join counted c on c.x = e.vec_id
"""


def _cluster_rounds(rounds: int = 5, clusters: int = 40) -> str:
    """One pair of steps per round: assign every vector, then take floors of exact means."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""far{r} as materialized (
  select k.n, c.cluster, cast(list_sum(list_transform(list_zip(k.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) as bigint) as d
  from kept k cross join centres{r} c),
near{r} as materialized (
  select n, arg_min(cluster, (d, cluster)) as cluster, min(d) as d from far{r} group by n)""")
        if r < rounds:
            steps.append(f"""part{r} as (
  select a.cluster, unnest(range(1, 65)) as i, unnest(k.v) as x from near{r} a join kept k using (n)),
mean{r} as (
  select cluster, i, cast((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) as bigint) as x
  from part{r} group by cluster, i),
centres{r + 1} as materialized (
  select c.cluster, coalesce(m.v, c.v) as v from centres{r} c
  left join (select cluster, list(x order by i) as v from mean{r} group by cluster) m using (cluster))""")
    return f"""
with kept as materialized (
  select vec_id, row_number() over () as n, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v
  from embeddings
  where embedding is not null and len(embedding) = 64
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
centres0 as materialized (
  select cast(row_number() over (order by sha256('2:' || cast(vec_id as varchar)) nulls last, v) - 1 as integer) as cluster, v
  from kept qualify cluster < {clusters}),
{", ".join(steps)}
select k.vec_id, a.cluster, a.d as distance, cast(sum(a.d) over (partition by a.cluster) as bigint) as cluster_inertia,
  cast(sum(a.d) over () as bigint) as inertia,
  sha256(array_to_string(list_transform(c.v, lambda x: cast(x as varchar)), ',')) as centroid_sha256
from near{rounds} a join kept k using (n) join centres{rounds} c using (cluster)
"""


CLUSTERS = _cluster_rounds()

PREFIX_TRIE = """
with recursive turns as (
  select conv_id as c, sha256(concat(strlen(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, ''))) as k,
    strlen(coalesce(text, '')) as b, row_number() over (partition by conv_id order by turn nulls first,
      sha256(concat(strlen(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, '')))) as pos
  from conversations where conv_id is not null),
convs as (
  select c, xor(list_reduce(list_concat([4294967295::bigint], list_transform(string_split(cast(c as varchar), ''), lambda x: ord(x)::bigint)),
      lambda acc, byte: list_reduce([xor(acc, byte), 0, 0, 0, 0, 0, 0, 0, 0],
        lambda x, i: xor(x >> 1, 3988292384::bigint * (x & 1)))), 4294967295::bigint) % 9 as h
  from (select distinct c from turns)),
rows as (
  select v.c, 0 as part, t.pos, t.k, t.b from convs v join turns t on t.c = v.c - v.c % 5 and t.pos <= v.h
  union all
  select v.c, 1, t.pos, t.k, t.b from convs v join turns t on t.c = v.c and t.pos > v.h),
paths as materialized (
  select c, cast(0 as bigint) as depth, '' as path, 0 as b from convs
  union all
  select c, row_number() over o as depth, sha256(string_agg(k, ',') over o) as path, b
  from rows window o as (partition by c order by part, pos rows between unbounded preceding and current row)),
lengths as (select c, max(depth) as len from paths group by c),
nodes as materialized (
  select p.depth, p.path, min(p.c) as conv_id, count(*) as n_convs, any_value(p.b) as b,
    sha256(coalesce(string_agg(cast(p.c as varchar), ',' order by p.c) filter (l.len = p.depth), '')) as ends_sha256
  from paths p join lengths l using (c) group by p.depth, p.path),
above as (
  select n.*, p.path as parent from nodes n left join paths p on p.c = n.conv_id and p.depth = n.depth - 1),
kids as (select parent as path, depth - 1 as depth, count(*) as n_children from above where depth > 0 group by all),
grown as (select a.*, coalesce(k.n_children, 0) as n_children from above a left join kids k using (depth, path)),
sums as (
  select p.depth, p.path, count(*) filter (g.n_children = 0) as n_leaves, sum((g.n_convs - 1) * g.b) as saved
  from grown g join paths p on p.c = g.conv_id and p.depth <= g.depth group by p.depth, p.path)
select g.conv_id, g.depth, q.conv_id as parent_conv_id, cast(g.n_convs as bigint) as n_convs,
  cast(g.n_children as bigint) as n_children, cast(s.n_leaves as bigint) as n_leaves,
  cast(s.saved as bigint) as saved_tokens, g.ends_sha256
from grown g join sums s using (depth, path) left join nodes q on q.depth = g.depth - 1 and q.path = g.parent
"""

REPEATS = """
with texts as materialized (
  select row_number() over () as n, doc_id, hex(encode(coalesce(text, ''))) as x, strlen(coalesce(text, '')) as n_bytes from documents),
windows as (
  select n, doc_id, i, sha256(substring(x, cast(2 * i + 1 as bigint), 100)) as s
  from (select n, doc_id, x, unnest(range(0, n_bytes - 49)) as i from texts where n_bytes >= 50 and doc_id is not null)),
held as (select s, min(doc_id) as least from windows group by s having min(doc_id) < max(doc_id)),
gone as (select w.n, w.i from windows w join held h using (s) where w.doc_id > h.least),
marked as (
  select n, i, case when i <= lag(i) over (partition by n order by i) + 50 then 0 else 1 end as begins from gone),
numbered as (select n, i, sum(begins) over (partition by n order by i) as run from marked),
runs as (select n, run, min(i) as a, max(i) + 50 as b from numbered group by n, run),
pieces as (
  select n, a, coalesce(lag(b) over (partition by n order by a), 0) as from_byte, b, b - a as size from runs),
kept as (
  select p.n, sum(p.size) as n_removed, count(*) as n_spans, max(p.b) as up_to,
    string_agg(substring(t.x, cast(2 * p.from_byte + 1 as bigint), cast(2 * (p.a - p.from_byte) as bigint)), '' order by p.a) as before
  from pieces p join texts t using (n) group by p.n)
select t.doc_id, cast(t.n_bytes as bigint) as n_bytes, cast(coalesce(k.n_removed, 0) as bigint) as n_removed,
  cast(coalesce(k.n_spans, 0) as bigint) as n_spans,
  sha256(unhex(concat(coalesce(k.before, ''), substring(t.x, cast(2 * coalesce(k.up_to, 0) + 1 as bigint))))) as kept_sha256
from texts t left join kept k using (n)
"""
