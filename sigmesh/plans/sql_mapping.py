"""The same driver-table mapping as ``mapping.py``, as DuckDB SQL snippets
for the oracle, plus SQL forms of the shared rule expressions.  Literal lists
are generated from ``config`` so both sides use one definition."""

from __future__ import annotations

from ..config import (AUTHORITY_DOMAINS, CDN_ASNS, CDN_IP_PREFIXES, CDN_ORG_KEYWORDS,
                      NOISE_AUTHORS, SUSPICIOUS_KEYWORDS, SUSPICIOUS_TLDS, SYNDICATION_MARKERS)
from .mapping import CDN_NATIONS, MAPPED_AS_OF


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def in_list(vals) -> str:
    return "(" + ", ".join(q(v) for v in vals) + ")"


def sql_suspicious(c: str) -> str:
    tld = " or ".join(f"ends_with({c}, {q(t)})" for t in SUSPICIOUS_TLDS)
    kw = " or ".join(f"contains({c}, {q(k)})" for k in SUSPICIOUS_KEYWORDS)
    return f"(({tld}) or ({kw}) or (length({c}) - length(replace({c}, '-', ''))) >= 2)"


def sql_is_cdn(ip: str, asn: str, org: str) -> str:
    pre = " or ".join(f"starts_with(coalesce({ip}, ''), {q(p)})" for p in CDN_IP_PREFIXES)
    kw = " or ".join(f"contains(lower(coalesce({org}, '')), {q(k)})" for k in CDN_ORG_KEYWORDS)
    return f"(coalesce({asn} in {in_list(CDN_ASNS)}, false) or {pre} or {kw})"


def sql_syndicated(text: str, n: int = 400) -> str:
    exc = f"lower(regexp_replace(substr(coalesce({text}, ''), 1, {n}), '^\\s+|\\s+$', '', 'g'))"
    return "(" + " or ".join(f"contains({exc}, {q(m)})" for m in SYNDICATION_MARKERS) + ")"


def sql_authority(c: str) -> str:
    return f"({c} in {in_list(AUTHORITY_DOMAINS)})"


NOISE_AUTHORS_SQL = in_list(NOISE_AUTHORS)
AS_OF_DATE = f"DATE '{MAPPED_AS_OF[:10]}'"

PUBLISH_TIMES = "select 'd' || cast(user_id as varchar) as domain, ts from events"
ANALYSED = "select 'd' || cast(c_custkey as varchar) as domain from customer"
REG_RECORDS = """
select 'd' || cast(c_custkey as varchar) as domain, cast(f.created_ts as date) as created_date,
       c_mktsegment as registrar, coalesce(n_name, '') as registration_country,
       case when f.created_ts is null then 'heuristic' else 'whoisxml' end as source
from customer
left join (select o_custkey, min(o_orderdate) as created_ts from orders group by o_custkey) f
  on c_custkey = f.o_custkey
left join nation on c_nationkey = n_nationkey
"""


def _hosting() -> str:
    band = "cast(floor(c_acctbal / 1000) + 2 as integer)"
    asn = "'AS' || cast(64512 + c_nationkey as varchar)"
    org = "n_name || ' TELECOM'"
    ip = f"'10.' || cast(c_nationkey as varchar) || '.' || cast({band} as varchar) || '.1'"
    for key, (c_asn, c_org, c_pref) in CDN_NATIONS.items():
        asn = f"case when c_nationkey = {key} then {q(c_asn)} else {asn} end"
        org = f"case when c_nationkey = {key} then {q(c_org)} else {org} end"
        ip = f"case when c_nationkey = {key} then {q(c_pref + '.')} || cast({band} as varchar) || '.1' else {ip} end"
    return f"""
select 'd' || cast(c_custkey as varchar) as domain, {ip} as ip_address, {asn} as asn,
       {org} as hosting_org, 'ok' as status
from customer left join nation on c_nationkey = n_nationkey
"""


HOSTING = _hosting()
OUTLINKS = """
select distinct 'd' || cast(l_suppkey as varchar) as src, 'd' || cast(l_partkey as varchar) as dst
from lineitem where l_suppkey <> l_partkey
"""
SNAPSHOTS = """
select 'd' || cast(o_custkey as varchar) as domain, strftime(o_orderdate, '%Y%m%d%H%M%S') as ts from orders
"""
BYLINES = """
select 'd' || cast(l_suppkey as varchar) as domain,
       concat_ws(' ', p_name, p_brand, cast(p_size as varchar)) as author
from lineitem join part on l_partkey = p_partkey
"""
VECTORS = """
select 'd' || cast(vec_id as varchar) as domain, 'site' || cast(label as varchar) as parent,
       embedding, coalesce(d.text, '') as text
from embeddings left join documents d on vec_id = d.doc_id
"""


def sql_parent(c: str) -> str:
    parts = f"string_split({c}, '.')"
    return (f"(case when len({parts}) >= 3 and {parts}[-2] in ('co', 'com', 'org', 'net', 'gov') "
            f"then array_to_string({parts}[-3:], '.') "
            f"when len({parts}) >= 2 then array_to_string({parts}[-2:], '.') else {c} end)")


def sql_strip(c: str) -> str:
    return f"regexp_replace({c}, '^\\s+|\\s+$', '', 'g')"
