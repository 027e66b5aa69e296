"""Results of registered queries as DuckDB SQL, where SQL can express them."""

OP1 = """
with records as (
  select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes, sha1(coalesce(html, '')) as payload_digest
  from pages),
stored as (
  select payload_digest, max(page_id) as stored_as from records
  where payload_bytes >= 1000 group by payload_digest having count(*) > 1)
select page_id, cast(payload_bytes as bigint) as payload_bytes, r.payload_digest,
  case when stored_as is not null and page_id is distinct from stored_as then 'revisit' else 'response' end as record_type,
  case when page_id is distinct from stored_as then stored_as end as refers_to
from records r left join stored s on r.payload_digest = s.payload_digest
"""

OP8 = r"""
with recursive words as (
  select doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
  from documents),
shingles as (
  select distinct doc_id, unnest(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
    else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end) as s
  from words),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
common as (
  select a.doc_id as a, b.doc_id as b, count(*) as c
  from shingles a join shingles b on a.s = b.s and a.doc_id <> b.doc_id group by 1, 2),
links as (
  select a, b from common join sizes x on x.doc_id = a join sizes y on y.doc_id = b
  where 100 * c >= 80 * (x.n + y.n - c)),
reach as (
  select doc_id, doc_id as other from documents
  union
  select r.doc_id, l.b from reach r join links l on l.a = r.other)
select d.doc_id, coalesce(n, 0) as n_shingles, c.component_id
from documents d left join sizes s on s.doc_id = d.doc_id
join (select doc_id, min(other) as component_id from reach group by doc_id) c on c.doc_id = d.doc_id
"""

OP12 = r"""
with sized as (
  select doc_id, source,
    cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) as size,
    (cast('0x' || substr(md5('mix:' || coalesce(cast(doc_id as varchar), '')), 1, 13) as bigint) + 0.5)
      / 4503599627370496.0 as u
  from documents),
sources as (
  select source, cast(sum(size) as bigint) as words, 1 + (row_number() over (order by source nulls last) - 1) % 3 as weight
  from sized group by source),
-- the level at which the sources before this one, by words per weight, are held at three times their size
levels as (
  select *, cast((select sum(words) from sources) - coalesce(sum(3 * words) over earlier, 0) as double)
      / cast((select sum(weight) from sources) - coalesce(sum(weight) over earlier, 0) as double) as level,
    row_number() over (order by 3 * words / weight, source nulls first) as place
  from sources
  window earlier as (order by 3 * words / weight, source nulls first rows between unbounded preceding and 1 preceding)),
stop as (select min(place) as first_free from levels where level <= 3 * words / weight),
targets as (
  select source, words, case when place < first_free then cast(3 * words as double)
    else weight * (select level from levels, stop where place = first_free) end as target
  from levels, stop),
goals as (
  select *, case when words > 0 then cast(round(target) as bigint) // words else 0 end as copies,
    case when words > 0 then cast(round(target) as bigint) % words else 0 end as rest
  from targets),
counts as (
  select s.source, size, words, rest, count(*) as n from sized s join goals g on s.source is not distinct from g.source
  where size > 0 and rest > 0 group by all),
steps as (
  select *, cast(sum(size * size * n) over upto as double) as squares,
    rest - words + sum(size * n) over upto as ranked, lead(size) over (partition by source order by size) as larger
  from counts window upto as (partition by source order by size)),
certain as (
  select source, squares / cast(ranked as double) as t, ranked from steps
  where ranked > 0 and (larger is null or squares <= cast(ranked as double) * larger)
  qualify row_number() over (partition by source order by size) = 1),
ranks as (
  select s.*, words, target, copies, t, ranked,
    case when size > 0 and size < t then (u * (t - size)) / ((1 - u) * size) end as r
  from sized s join goals g on s.source is not distinct from g.source
  left join certain c on s.source is not distinct from c.source),
summed as (
  select *, case when r is not null then sum(size) over (partition by source, r) end as shared,
    case when r is not null then sum(size) over (partition by source, r is null order by r) end as upto
  from ranks)
select doc_id, size, words as source_size, target,
  cast(copies * size + case
    when size = 0 or t is null then 0
    when size >= t or upto <= ranked then size
    when upto - shared < ranked then least(size, (ranked - upto + shared) * size // shared)
    else 0 end as bigint) as taken
from summed
"""

OP13 = """
with vectors as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda c: cast(floor(256 * cast(c as double)) as bigint)) as x
  from embeddings
  where embedding is not null and list_count(embedding) = len(embedding)
    and len(list_filter(embedding, lambda c: not isfinite(c))) = 0),
scores as (
  select a.vec_id as anchor_id, a.label as anchor_label, b.vec_id, b.label,
    cast(list_sum(list_transform(range(1, len(a.x) + 1), lambda i: a.x[i] * b.x[i])) as bigint) as score
  from vectors a join vectors b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id
  where a.label is not null and b.label is not null),
positives as (
  select anchor_id, vec_id as positive_id, score as positive_score from scores where label = anchor_label
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5)
select p.anchor_id, positive_id,
  cast(row_number() over (partition by p.anchor_id, positive_id order by score desc, vec_id) as integer) as rank,
  vec_id as negative_id, positive_score, score as negative_score
from positives p join scores s on p.anchor_id = s.anchor_id and s.label <> s.anchor_label
  and 100 * score between 80 * positive_score and 100 * positive_score
qualify rank <= 5
"""
