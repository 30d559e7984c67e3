"""DuckDB SQL of the text operators that SQL can say, plain and by brute force."""

from __future__ import annotations

from renalis.llm.host_reputation import ADDRESSES, DIGITS, RULES, TOLERATED, WEAK, Z, Rule

# Scores of all rows with all anchors, then ranks.
HARD_NEGATIVES = """
with taken as (
  select vec_id as id,
    case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as q
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
),
scored as (
  select a.id as anchor_id, a.label as own, r.id, r.label,
    cast(list_sum(list_transform(list_zip(a.q, r.q), lambda p: p[1] * p[2])) as bigint) as score
  from taken a join taken r on a.id % 100 = 0 and a.id <> r.id
),
positives as (
  select anchor_id, own, id as positive_id, score as positive_score
  from scored where label = own
  qualify row_number() over (partition by anchor_id order by score desc, id) <= 5
)
select p.anchor_id, p.positive_id,
  cast(row_number() over w as int) as rank,
  s.id as negative_id, p.positive_score, s.score as negative_score
from positives p join scored s on s.anchor_id = p.anchor_id and s.label <> p.own
  and 80 * p.positive_score <= 100 * s.score and 100 * s.score <= 100 * p.positive_score
window w as (partition by p.anchor_id, p.positive_id order by s.score desc, s.id)
qualify row_number() over w <= 5
"""


def _leaf(n_chars: str) -> str:
    values = ("doc_id", "source", "lang", n_chars, "text")
    return "sha256(" + " || ".join(
        f"coalesce(strlen(cast({v} as varchar)) || ':' || cast({v} as varchar), '-')" for v in values
    ) + ")"


def _tree(name: str, leaves: str) -> str:
    """Nodes of a binary tree for each group: (grp, level, idx, n, digest), n nodes in the level."""
    return f"""
{name} as (
  select grp, 0 as level, idx, n, digest from {leaves}
  union all
  select grp, level + 1, idx // 2, (n + 1) // 2, sha256(string_agg(digest, '' order by idx))
  from {name} where n > 1 group by grp, level, n, idx // 2
)"""


def _walk(name: str, start: str, nodes: str) -> str:
    """From each start (id, grp, level, idx, node, sides) to the root: hashes and siblings met."""
    return f"""
{name} as (
  select id, grp, 0 as level, idx, n, node, sides from {start}
  union all
  select w.id, w.grp, w.level + 1, w.idx // 2, (w.n + 1) // 2,
    sha256(case when w.idx % 2 = 1 then s.digest || w.node else w.node || coalesce(s.digest, '') end),
    w.sides || coalesce(s.digest, '')
  from {name} w left join {nodes} s on s.grp = w.grp and s.level = w.level and s.idx = xor(w.idx, 1)
  where w.n > 1
)"""


# CRC-32 of a short ASCII text, bit by bit.
_CRC = """xor(4294967295, list_reduce(
  list_transform(range(1, length({0}) + 1), lambda i: cast(ascii(substr({0}, i, 1)) as bigint)),
  lambda c, b: list_reduce(range(8), lambda x, k: case when x & 1 = 1 then xor(x >> 1, 3988292384)
    else x >> 1 end, xor(c, b)), cast(4294967295 as bigint)))"""

MERKLE = f"""
with recursive docs as (
  select doc_id as id, coalesce('=' || lang, '') as grp, {_leaf('n_chars')} as leaf,
    case when {_CRC.format('cast(doc_id as varchar)')} % 7 = 0
      then {_leaf('(n_chars + 1)')} else {_leaf('n_chars')} end as again
  from documents
),
leaves as (
  select id, grp, leaf, again, leaf as digest,
    row_number() over (partition by grp order by id nulls first, leaf) - 1 as idx,
    count(*) over (partition by grp) as n
  from docs
),{_tree('nodes', 'leaves')},
subroots as (
  select '' as grp, grp as of, digest,
    row_number() over (order by encode(grp)) - 1 as idx, count(*) over () as n
  from nodes where n = 1
),{_tree('tops', 'subroots')},
lower_start as (select row(id, digest, idx) as id, grp, idx, n, again as node, '' as sides from leaves),
{_walk('lower_walk', 'lower_start', 'nodes')},
upper_start as (
  select w.id, s.grp, s.of, s.idx, s.n, w.node, w.sides
  from lower_walk w join subroots s on s.of = w.grp where w.n = 1
),
{_walk('upper_walk', 'upper_start', 'tops')}
select l.id as doc_id, l.leaf, s.digest as subroot, r.digest as root, sha256(w.sides) as proof_sha256,
  w.node as folded_root, w.node = r.digest as verified
from leaves l join subroots s on s.of = l.grp
  join upper_start u on u.id = row(l.id, l.digest, l.idx) and u.of = l.grp
  join upper_walk w on w.id = u.id and w.n = 1
  cross join (select digest from tops where n = 1) r
"""


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _fitting(rules: list[Rule]) -> str:
    """A CASE that gives the text and verdict of the longest rule that fits, as a list."""
    longest = sorted(rules, key=lambda r: (-len(r.text), r.text))
    branches = [
        f"when (host = '{r.host}' or ends_with(host, '.{r.host}')) and starts_with(path, '{r.path}') "
        f"then ['{r.text}', '{r.verdict}']"
        for r in longest
    ]
    return f"case {' '.join(branches)} end"


def _siblings_sql(rows: str, key: str) -> str:
    """Strength of the prior of each group of rows, from the intra-class correlation of its members."""
    return f"""
  select {key}, case when p > 0 and p < 1
    then 1 / greatest(least(coalesce(
      (between_ - within) / nullif(between_ + (n0 - 1) * within, 0), 1.0), 0.9), 1e-3) - 1 end as own
  from (
    select *, (gkk - gn * p * p) / (g - 1) as between_, (gk - gkk) / (gn - g) as within,
      (gn - gnn / gn) / (g - 1) as n0
    from (
      select *, gk / gn as p
      from (
        select {key}, cast(sum(n) as double) as gn, cast(sum(k) as double) as gk,
          cast(sum(n * n) as double) as gnn, sum(k * k / n) as gkk, count(*) as g
        from {rows} where n > 0 group by {key}
      ) where g > 2 and gn > g
    )
  )"""


REPUTATION = f"""
with tails as (
  select page_id, case when contains(url, '://')
    then regexp_extract(substr(url, strpos(url, '://') + 3), '^[^?#]*') else '' end as bare
  from pages
),
seen as (
  select page_id, translate(split_part(bare, '/', 1), '{_UPPER}', '{_LOWER}') as host,
    substr(bare, length(split_part(bare, '/', 1)) + 1) as path
  from tails
),
known as (
  select doc_id, max(greatest(toxic, 1 - quality)) as bad from labels group by doc_id
),
counted as (
  select host, count(bad) as n, coalesce(sum(bad), 0) as k
  from seen left join known on doc_id = page_id group by host
),
hosts as (
  select *, case when address then bare else array_to_string(parts[-2:], '.') end as domain,
    case when address then '{ADDRESSES}' else parts[-1] end as suffix
  from (
    select *, string_split(bare, '.') as parts,
      regexp_matches(bare, '^([0-9]+(\\.[0-9]+){{3}}|\\[.*\\])$') as address
    from (
      select *, regexp_replace(regexp_replace(host, '^.*@', ''), '\\.?(:[0-9]*)?$', '') as bare
      from counted
    )
  )
),
domains as (select suffix, domain, sum(n) as n, sum(k) as k from hosts group by suffix, domain),
suffixes as (select 0 as every, suffix, sum(n) as n, sum(k) as k from domains group by suffix),
total as (select (sum(k) + 0.5) / (sum(n) + 1.0) as mean from suffixes),
shared as ({_siblings_sql('suffixes', 'every')}),
by_domain as ({_siblings_sql('domains', 'suffix')}),
by_host as ({_siblings_sql('hosts', 'domain')}),
upper_ as (
  select suffix, (k + t.mean * s) / (n + s) as pm, s as ps
  from suffixes, (select cast(mean as double) as mean from total) t,
    (select coalesce((select nullif(own, 0) from shared), {WEAK}) as s)
),
middle as (
  select domain, (k + pm * s) / (n + s) as pm, s as ps
  from (
    select d.*, u.pm, coalesce(own, ps) as s
    from domains d join upper_ u using (suffix) left join by_domain using (suffix)
  )
),
judged as (
  select host, (k + pm * s) / (n + s) as mean, k + pm * s as a, n - k + (1 - pm) * s as b
  from (
    select h.*, m.pm, coalesce(own, ps) as s
    from hosts h join middle m using (domain) left join by_host using (domain)
  )
),
bounded as (
  select host, mean,
    greatest(a / (a + b) - {Z} * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))), 0.0) as lower_
  from judged
),
ruled as (select *, {_fitting(RULES)} as found from seen)
select page_id, host, path, found[1] as rule,
  coalesce(found[2], case when lower_ > {TOLERATED} then 'block' else 'allow' end) as verdict,
  round(mean, {DIGITS}) as bad_rate, round(lower_, {DIGITS}) as lower_bound
from ruled join bounded using (host)
"""

# 20 bits of the SHA-1 are five hex digits and four letters.
WARC = """
with payloads as (
  select page_id, url, coalesce(html, '') as payload, sha1(coalesce(html, '')) as hex from pages
),
ranked as (
  select *, row_number() over w as nth, first_value(page_id) over w as original
  from payloads window w as (partition by hex order by page_id, url)
)
select page_id, cast(strlen(payload) as bigint) as payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((cast('0x' || substr(hex, 1 + 5 * (i // 4), 5) as bigint) >> (5 * (3 - i % 4))) & 31), 1)),
    '') as payload_digest,
  case when nth = 1 then 'response' else 'revisit' end as record_type,
  case when nth > 1 then original end as refers_to
from ranked
"""

# All pairs of distinct sets by the shingles they share, then everything that links lead to.
NEAR_DUPLICATES = rf"""
with recursive spoken as (
  select doc_id, regexp_extract_all(coalesce(translate(text, '{_UPPER}', '{_LOWER}'), ''),
    '[^\x20\x09-\x0D]+') as w
  from documents
),
listed as (
  select doc_id, case when len(w) < 2 then w else list_sort(list_distinct(list_transform(
    range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) end as s
  from spoken
),
sets as (select doc_id, s, len(s) as n, array_to_string(s, chr(10)) as key from listed),
classes as (
  select key, min(doc_id) as rep, any_value(n) as n, any_value(s) as s
  from sets where n > 0 group by key
),
shingles as (select rep, n, unnest(s) as shingle from classes),
links as (
  select a.rep as a, b.rep as b
  from shingles a join shingles b on a.shingle = b.shingle and a.rep <> b.rep
  group by a.rep, b.rep, a.n, b.n
  having 100 * count(*) >= 80 * (a.n + b.n - count(*))
),
reach as (
  select rep as a, rep as b from classes
  union
  select r.a, l.b from reach r join links l on l.a = r.b
),
smallest as (select a, min(b) as component_id from reach group by a)
select doc_id, sets.n as n_shingles,
  coalesce(component_id, doc_id) as component_id, doc_id = coalesce(component_id, doc_id) as kept
from sets left join classes on classes.key = sets.key left join smallest on a = rep
"""

SQL = {
    "op5_host_reputation": REPUTATION,
    "op7_warc_revisits": WARC,
    "op10_hyperminhash": NEAR_DUPLICATES,
    "op11_kronecker_hard_negatives": HARD_NEGATIVES,
    "op12_pointer_jumping_proofs": MERKLE,
}
