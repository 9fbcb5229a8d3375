"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from . import urlrules as url

# Documents, their shingle sets, links by a self-join, and reachability by recursion.
OP7 = r"""
with recursive words as (
    select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
        lambda x: x <> '') as w
    from documents),
sets as (
    select doc_id, list_sort(case when len(w) = 0 then []::varchar[]
        when len(w) < 5 then [array_to_string(w, ' ')]
        else list_distinct(list_transform(range(1, len(w) - 3),
            lambda i: array_to_string(w[i:i + 4], ' '))) end) as s
    from words),
shingles as (select doc_id, len(s) as n, unnest(s) as g from sets),
links as (
    select a.doc_id as a, b.doc_id as b
    from shingles a join shingles b on a.g = b.g and a.doc_id <> b.doc_id
    group by a.doc_id, b.doc_id, a.n, b.n
    having 100 * count(*) >= 75 * (a.n + b.n - count(*))),
reach as (
    select doc_id, doc_id as other from sets
    union
    select r.doc_id, l.b from reach r join links l on r.other = l.a),
component as (select doc_id, min(other) as component_id from reach group by doc_id)
select s.doc_id, cast(len(s) as bigint) as n_shingles, component_id,
    case when len(s) = 0 then s.doc_id else min(s.doc_id) over (partition by s) end as class_id
from sets s join component c on s.doc_id = c.doc_id
"""

# Twenty bits, four digits: each five hexadecimal digits of the SHA-1.
_FOUR = ("list_aggregate(list_transform([15, 10, 5, 0], lambda b: substr("
         "'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', cast((cast(('0x' || substr(h, k * 5 + 1, 5)) as "
         "bigint) >> b) & 31 as bigint) + 1, 1)), 'string_agg', '')")
OP4 = f"""
with payloads as (
    select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes,
        sha1(coalesce(html, '')) as h
    from pages),
digests as (
    select page_id, payload_bytes, list_aggregate(list_transform(range(0, 8), lambda k: {_FOUR}),
        'string_agg', '') as payload_digest, max(page_id) over (partition by h) as first
    from payloads)
select page_id, cast(payload_bytes as bigint) as payload_bytes, payload_digest,
    case when page_id = first then 'response' else 'revisit' end as record_type,
    case when page_id <> first then first end as refers_to
from digests
"""


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _attribute(pattern: str) -> str:
    return " || ".join(f"regexp_extract(tag, {_text(pattern)}, {k})" for k in (1, 2, 3))


def _host(column: str) -> str:
    return (f"translate(coalesce(regexp_extract({column}, {_text(url.URL)}, 1), ''), "
            "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")


def _path(column: str) -> str:
    return f"coalesce(regexp_extract({column}, {_text(url.URL)}, 2), '')"


def _key(column: str) -> str:
    host, path = _host(column), _path(column)
    return (f"case when {host} <> '' then {host} || case when {path} = '' then '/' else {path} end "
            f"|| coalesce(regexp_extract({column}, {_text(url.URL)}, 3), '') end")


# Blocked urls, and whatever edges reach from them; a rule of the url itself comes first.
OP13 = f"""
with recursive rules(verdict, h, p) as (values {", ".join(
    f"({_text(v)}, {_text(h)}, {_text(p)})" for v, h, p in url.RULES)}),
parsed as (
    select page_id, {_host('url')} as host, {_path('url')} as path, {_key('url')} as node, html
    from pages),
seen as (
    select host, path, node, regexp_replace(html, {_text(url.UNSEEN)}, '', 'g') as html
    from parsed where node is not null and html is not null),
links as (
    select *, unnest(regexp_extract_all(html, {_text(url.LINK)})) as tag from seen),
metas as (
    select *, unnest(regexp_extract_all(html, {_text(url.META)})) as tag from seen),
targets as (
    select host, path, node, {_attribute(url.HREF)} as target
    from links where regexp_matches(tag, {_text(url.CANONICAL)})
    union all
    select host, path, node, regexp_extract({_attribute(url.CONTENT)}, {_text(url.TARGET)}, 1)
    from metas where regexp_matches(tag, {_text(url.REFRESH)})),
plain as (
    select host, path, node, replace(trim(target), '&amp;', '&') as t,
        regexp_replace(path, '[^/]*$', '') as folder
    from targets),
resolved as (
    select node, case when t = '' or starts_with(t, '#') then null
        when regexp_matches(t, {_text(url.ABSOLUTE)}) then t
        when starts_with(t, '//') then 'http:' || t
        when regexp_matches(t, {_text(url.SCHEME)}) then null
        when starts_with(t, '/') then 'http://' || host || t
        when starts_with(t, '?') then 'http://' || host || path || t
        else 'http://' || host || case when folder = '' then '/' else folder end || t end as u
    from plain),
pairs as (select node as a, {_key('u')} as b from resolved),
edges as (
    select a, b from pairs where b is not null union select b, a from pairs where b is not null),
places as (
    select node, host, path from parsed where node is not null
    union
    select a, split_part(split_part(a, '/', 1), '?', 1), {_path("('x://' || a)")} from edges),
decided as (
    select node, host, path, arg_max(verdict, length(h || p)) as verdict,
        max_by(h || p, length(h || p)) as rule
    from places join rules on (host = h or ends_with(host, '.' || h)) and starts_with(path, p)
    group by node, host, path),
reach as (
    select distinct node from decided where verdict = 'block'
    union
    select e.b from reach r join edges e on e.a = r.node),
ruled as (select distinct host, path, rule, verdict from decided)
select page_id, p.host, p.path, d.rule, coalesce(d.verdict,
    case when p.node in (select node from reach) then 'block' else 'allow' end) as verdict
from parsed p left join ruled d on d.host = p.host and d.path = p.path
"""
