"""DuckDB SQL with the meaning of the queries that SQL can express.

Line fields, fingerprints (XXH64), tokenisers, language profiles, keyed
surrogates and linked calls have none; tests hold them against plain versions.
"""

from augur.llm.mixing import EPOCHS, SEED, SHARE, WEIGHTS

DECONTAMINATION = r"""
with b as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from benchmark),
win as (
  select distinct item_id, least(len(w), 13) as n, array_to_string(w[s:s + 12], ' ') as k
  from (select item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) as s from b where len(w) > 0)),
d as (
  select row_number() over () as r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from documents),
hit as (
  select r, s, win.n, win.item_id
  from (select r, w, n, unnest(range(1, len(w) - n + 2)) as s from d, (select distinct n from win)) p
  join win on win.n = p.n and win.k = array_to_string(w[s:s + p.n - 1], ' ')),
covered as (select r, count(distinct p) as n_hit from (select r, unnest(range(s, s + n)) as p from hit) group by r),
items as (
  select r, count(*) as n_items, string_agg(i, ',' order by i) as ids
  from (select distinct r, cast(item_id as varchar) as i from hit where item_id is not null) group by r)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 and 20 * n_hit >= len(w) as contaminated
from d left join covered using (r) left join items using (r)
"""

SUBSTRING_DEDUP = r"""
with d as (select row_number() over () as r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
starts as (select r, s, array_to_string(w[s:s + 34], ' ') as k from (select r, w, unnest(range(1, len(w) - 33)) as s from d)),
again as (select k from starts group by k having count(*) > 1),
gone as (select distinct r, unnest(range(s, s + 35)) as p from starts join again using (k)),
kept as (
  select r, count(*) as n, string_agg(word, ' ' order by p) as text
  from (select r, unnest(w) as word, unnest(range(1, len(w) + 1)) as p from d) x anti join gone using (r, p) group by r)
select doc_id, cast(len(w) as bigint) as n_words, cast(len(w) - coalesce(n, 0) as bigint) as n_removed,
       sha256(coalesce(text, '')) as kept_sha256
from d left join kept using (r)
"""


def _case(level: str) -> str:
    named = "".join(f" when '{k}' then {w}" for k, w in WEIGHTS[level].items())
    return f"case {level}{named} else 1 end" if named else "1"


def _share(name: str, level: str, parents: tuple[str, ...], given: str) -> str:
    """CTEs that hand ``given`` (a CTE with the parents' budgets) to a level."""
    keys = ", ".join((*parents, level))
    by = f"partition by {', '.join(parents)}" if parents else ""
    join = f"join {given} using ({', '.join(parents)})" if parents else f", {given}"
    return f"""
{name}_nodes as (select {keys}, sum(room) as room, max({_case(level)}) as weight from leaves group by {keys}),
{name}_levels as (
  select *, (given - coalesce(sum(room) over ({by} order by room / weight, {level} rows between unbounded preceding and 1 preceding), 0))
            / sum(weight) over ({by} order by room / weight, {level} rows between current row and unbounded following) as level
  from {name}_nodes {join}),
{name} as (
  select {keys}, cast(case when room / weight <= level then room
                      else floor(max(level) filter (room / weight > level) over ({by}) * weight) end as bigint) as given
  from {name}_levels)"""


MIXING = f"""
with docs as (
  select *, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as w from documents),
rows_ as (
  select doc_id, coalesce('d' || (cast('0x' || substr(md5(source), 1, 2) as int) % 4), '?') as domain,
         coalesce(lang, '?') as language, coalesce(source, '?') as origin, cast(len(w) as bigint) as n_tokens
  from docs where len(w) > 0),
leaves as (select domain, language, origin, cast(sum(n_tokens) as double) as tokens, cast(sum(n_tokens) as double) * {EPOCHS} as room from rows_ group by all),
root as (select least(floor(sum(tokens) * {SHARE}), sum(room)) as given from leaves),
{_share("domains", "domain", (), "root")},
{_share("languages", "language", ("domain",), "domains")},
{_share("origins", "origin", ("domain", "language"), "languages")},
plan as (
  select domain, language, origin, given // cast(tokens as bigint) as whole, given % cast(tokens as bigint) as rest
  from origins join leaves using (domain, language, origin)),
placed as (
  select r.*, whole, rest,
         sum(n_tokens) over (partition by domain, language, origin order by md5('{SEED}-' || whole || '-' || doc_id), doc_id) as upto
  from rows_ r join plan using (domain, language, origin))
select doc_id, domain, language, origin, n_tokens, cast(whole + (upto <= rest)::int as bigint) as copies
from placed where whole + (upto <= rest)::int > 0
"""

URL_REPUTATION = r"""
with p as (
  select page_id, url,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') as path
  from pages),
o as (
  select p.host, l.bad
  from (select *, try_cast(regexp_extract(path, '^/[^/]*/([0-9]{1,18})(?:[^0-9]|$)', 1) as bigint) as doc_id from p) p
  join (select doc_id, max((quality = 0 or toxic = 1)::int) as bad from labels group by doc_id) l using (doc_id)
  where l.bad is not null),
c as (select host, count(*) as n, sum(bad) as bad from o group by host),
parts as (select host, regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', '') as name from (select distinct host from p)),
h as (
  select host,
         case when two in ('co.uk', 'org.uk', 'com.au', 'co.jp', 'com.br') then two else labels[-1] end as suffix,
         case when two in ('co.uk', 'org.uk', 'com.au', 'co.jp', 'com.br') then array_to_string(labels[-3:], '.') else two end as domain
  from (select host, string_split(name, '.') as labels, array_to_string(string_split(name, '.')[-2:], '.') as two from parts)),
k as (select h.*, coalesce(n, 0)::double as n, coalesce(bad, 0)::double as bad from h left join c using (host)),
overall as (select (sum(bad) + 0.25::double) / (sum(n) + 1) as m from k),
s0 as (select suffix, sum(n) as n, sum(bad) as bad, any_value(m) as m from k, overall group by suffix),
s1 as (select 1 / least(0.5, greatest(0.0001, coalesce(sum((bad - n * m) ** 2 - n * m * (1 - m)) / nullif(sum(n * (n - 1) * m * (1 - m)), 0), 0.0001))) - 1 as s from s0),
s2 as (select suffix, (s * m + bad) / (s + n) as m from s0, s1),
d0 as (select domain, n, bad, m from (select suffix, domain, sum(n) as n, sum(bad) as bad from k group by all) join s2 using (suffix)),
d1 as (select 1 / least(0.5, greatest(0.0001, coalesce(sum((bad - n * m) ** 2 - n * m * (1 - m)) / nullif(sum(n * (n - 1) * m * (1 - m)), 0), 0.0001))) - 1 as s from d0),
d2 as (select domain, (s * m + bad) / (s + n) as m from d0, d1),
h0 as (select host, n, bad, m from k join d2 using (domain)),
h1 as (select 1 / least(0.5, greatest(0.0001, coalesce(sum((bad - n * m) ** 2 - n * m * (1 - m)) / nullif(sum(n * (n - 1) * m * (1 - m)), 0), 0.0001))) - 1 as s from h0),
h2 as (select host, (s * m + bad) / (s + n) as rate, s + n as size from h0, h1),
rules(verdict, rule) as (values ('allow', 'com/'), ('block', 'example.com/en/'), ('allow', 'www.example.com/en/'), ('block', 'net/es/'), ('block', 'net/fr/')),
fit as (
  select host, path, max_by(rule, length(rule)) as rule, max_by(verdict, length(rule)) as verdict
  from (select distinct host, path from p) p
  join rules on (host = split_part(rule, '/', 1) or ends_with(host, '.' || split_part(rule, '/', 1)))
            and starts_with(path, substr(rule, position('/' in rule)))
  group by all)
select page_id, p.host, p.path, fit.rule,
       coalesce(fit.verdict, case when rate - 1.645 * sqrt(rate * (1 - rate) / (size + 1)) > 0.25 then 'block' else 'allow' end) as verdict
from p join h2 on h2.host = p.host left join fit on fit.host = p.host and fit.path = p.path
"""

# Codebooks by plain nearest entries: distance * 64 + entry orders by distance, then by index.
_CODED = """a{k} as (
  select r, p.part, arg_min(entry, list_sum(list_transform(p.v, lambda x, i: (x - c.v[i]) * (x - c.v[i]))) * 64 + entry) as entry,
         min(list_sum(list_transform(p.v, lambda x, i: (x - c.v[i]) * (x - c.v[i])))) as d
  from p join c{k} c on c.part = p.part group by r, p.part),
"""
_MOVED = """m{k} as (
  select part, entry, pos, (s - ((s % n) + n) % n) // n as x
  from (select part, entry, pos, sum(x) as s, count(*) as n
        from (select a.part, a.entry, unnest(p.v) as x, generate_subscripts(p.v, 1) as pos from a{k} a join p using (r, part))
        group by all)),
c{next} as (
  select part, entry, coalesce(moved, c.v) as v from c{k} c
  left join (select part, entry, list(x order by pos) as moved from m{k} group by all) using (part, entry)),
"""
VECTOR_CODES = (
    """
with kept as (
  select row_number() over (order by vec_id nulls last, embedding) - 1 as r, vec_id, label, list_transform(embedding, lambda c: cast(floor(256 * cast(c as double)) as bigint)) as x
  from embeddings where len(list_filter(embedding, lambda c: c is null or not isfinite(c))) = 0),
p as (
  select r, part, x[part * len(x) // 16 + 1:(part + 1) * len(x) // 16] as v from (select r, x, unnest(range(16)) as part from kept)),
c0 as (select part, r as entry, v from p where r < 64),
"""
    + "".join(_CODED.format(k=k) + _MOVED.format(k=k, next=k + 1) for k in range(2))
    + _CODED.format(k=2)
    + """
coded as (select r, string_agg(lower(printf('%02x', entry)), '' order by part) as code, cast(sum(d) as bigint) as error from a2 group by r)
select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error,
       (select sha256(string_agg(array_to_string(v, ','), ',' order by part, entry)) from c2) as codebooks_sha256
from kept join coded using (r)
"""
)

ORACLE_SQL = {
    "op4_benchmark_decontamination": DECONTAMINATION,
    "op8_substring_dedup": SUBSTRING_DEDUP,
    "op9_mixing_sources": MIXING,
    "op10_url_reputation": URL_REPUTATION,
    "op11_vector_codes": VECTOR_CODES,
}
