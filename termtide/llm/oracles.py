"""What SQL can say of the operators, for DuckDB, written apart from their code."""

BLANKS = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
LOWERED = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP3 = f"""
with d as (select doc_id, string_split(coalesce(text, ''), chr(10)) as lines from documents),
l as (select doc_id, unnest(range(1, len(lines) + 1)) as place, unnest(lines) as line from d),
k as (select doc_id, place, line, {LOWERED.format(f"trim(line, {BLANKS})")} as key from l),
s as (
  select key, max(doc_id) as keeper from k where length(key) >= 20
  group by key having count(distinct doc_id) >= 3
),
m as (select k.*, s.key is not null and k.doc_id <> s.keeper as gone from k left join s using (key))
select doc_id, count(*) as n_lines, cast(count(*) filter (gone) as bigint) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by place) filter (not gone), '')) as kept_sha256
from m group by doc_id
"""

_STRICT = "adult|betting|casino|escort|malware|phishing|porn|roulette|sex|spam|viagra|warez|xxx"
_SOFT = (
    "ad ads affiliate bet bets bonus cheap click coupon crack deal deals discount download farm free "
    "hot jackpot keygen loan offer pharma pill pills popup prize promo sale slots torrent track "
    "tracker win winner"
).split()


def _found(words: str) -> str:
    return f"cast(regexp_matches(address, '(^|[^a-z0-9])({words})($|[^a-z0-9])') as integer)"


OP8 = f"""
with r(action, rule) as (
  values ('allow', 'org/'), ('block', 'example.org/es/'), ('block', 'example.org/en/1'),
    ('allow', 'com/fr/'), ('block', 'com/de/')
),
u as (
  select page_id, url, case when contains(url, '://')
    then regexp_extract(substr(url, strpos(url, '://') + 3), '^[^?#]*') else '' end as rest
  from pages
),
p as (
  select page_id, {LOWERED.format("regexp_extract(rest, '^[^/]*')")} as host,
    regexp_extract(rest, '/.*$', 0, 's') as path
  from u
),
f as (
  select p.page_id, p.host, p.path, r.action, r.rule,
    row_number() over (partition by p.page_id order by length(r.rule) desc nulls last) as place
  from p left join r on starts_with(p.path, substr(r.rule, strpos(r.rule, '/')))
    and (p.host = split_part(r.rule, '/', 1) or ends_with(p.host, '.' || split_part(r.rule, '/', 1)))
),
a as (select *, host || {LOWERED.format("path")} as address from f where place = 1),
n as (
  select *, {' + '.join(_found(w) for w in _STRICT.split('|'))} as n_strict,
    {' + '.join(_found(w) for w in _SOFT)} as n_soft
  from a
)
select page_id, host, path, rule, n_strict, n_soft,
  coalesce(action, case when n_strict > 0 or n_soft >= 2 then 'block' else 'allow' end) as verdict
from n
"""

OP10 = r"""
with z as (
  select doc_id, source,
    cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) as size,
    cast('0x' || left(md5(cast(doc_id as varchar)), 15) as bigint) as hash
  from documents
),
s as (
  select source, cast(sum(size) as bigint) as source_size,
    cast((row_number() over (order by source nulls last) - 1) % 3 + 1 as double) as weight
  from z group by source
),
c as (
  select *, 3.0::double * source_size as cap, sum(source_size) over () :: double as total,
    sum(weight) over () as weights
  from s
),
o as (
  select *, coalesce(sum(cap) over w, 0) as caps_before, coalesce(sum(weight) over w, 0) as weights_before
  from c
  window w as (order by cap / weight, source nulls last rows between unbounded preceding and 1 preceding)
),
f as (select *, (total - caps_before) * weight >= cap * (weights - weights_before) as full_up from o),
t as (
  select source, source_size, case when full_up then cap else
    first_value(total - caps_before) over v * weight / first_value(weights - weights_before) over v
    end as target
  from f
  window v as (partition by full_up order by cap / weight, source nulls last)
),
b as (
  select *, case when source_size > 0 then cast(floor(target / source_size) as bigint) else 0 end as whole
  from t
),
h as (
  select z.source, z.hash, sum(z.size) as words from z group by z.source, z.hash
),
e as (
  select h.*, b.target - b.whole * b.source_size as rest,
    coalesce(sum(words) over (partition by h.source order by hash
      rows between unbounded preceding and 1 preceding), 0) as before
  from h join b on h.source is not distinct from b.source
),
g as (
  select source, max(hash) as upto from e where before < rest and 2 * (rest - before) >= words
  group by source
)
select z.doc_id, z.size, z.source, b.source_size, b.target,
  cast(least(b.whole + cast(coalesce(z.hash <= g.upto, false) as bigint), 3) as bigint) as copies,
  cast(least(b.whole + cast(coalesce(z.hash <= g.upto, false) as bigint), 3) * z.size as bigint) as taken
from z join b on z.source is not distinct from b.source
left join g on z.source is not distinct from g.source
"""

ORACLES = {"op3_line_dedup": OP3, "op8_url_filter": OP8, "op10_mixing": OP10}
