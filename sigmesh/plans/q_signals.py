"""Signal queries 3-7 on the mapped driver tables (registration, hosting,
links, archive, authors)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import BULK_REGISTRARS, CDN_ASNS, CLUSTER_EXEMPT_REGISTRARS, CURRENT
from ..operators.archive import archive_features, archive_flags
from ..operators.authors import author_memberships, author_pair_counts, author_signal
from ..operators.hosting import host_memberships, host_pair_counts, hosting_records_from_org, hosting_signal
from ..operators.links import link_signal, mutual_links
from ..operators.registration import registrar_clusters, registration_repair, registration_signal
from ..sources.tables import Tables
from . import mapping as M
from . import sql_mapping as S
from .registry import register

CFG = CURRENT.with_(as_of=M.MAPPED_AS_OF)

# ---------------------------------------------------------------- registration


def _reg(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return registration_signal(M.analysed_domains(t), M.registration_records(t), CFG)


REG_SQL = f"""
select d.domain, r.created_date,
  case when r.source is not null and r.source <> 'heuristic'
       then cast(date_diff('day', r.created_date, {S.AS_OF_DATE}) as integer) end as domain_age_days,
  coalesce(substr(r.registrar, 1, 80), 'unknown') as registrar,
  coalesce(substr(r.registration_country, 1, 50), '') as registration_country,
  coalesce(r.source, 'heuristic') as whois_source,
  cast(case when r.source is not null and r.source <> 'heuristic'
            then coalesce(date_diff('day', r.created_date, {S.AS_OF_DATE}) between 0 and {CFG.young_days}, false)
            else {S.sql_suspicious(S.sql_parent('d.domain'))} end as integer) as whois_flagged
from ({S.ANALYSED}) d left join ({S.REG_RECORDS}) r on {S.sql_parent('d.domain')} = r.domain
"""


@register("registration_signal", sql=REG_SQL, ops=("B4", "B27", "H5", "H11", "C1"))
def q_registration_signal(spark, sf_dir):
    return _reg(spark, sf_dir)


@register("registrar_clusters", ops=("D5", "C1"), sql=f"""
with g as ({REG_SQL}),
c as (select *, count(*) over (partition by registrar) as n from g)
select domain, registrar, domain_age_days, cast(n as bigint) as registrar_domains,
  cast(n >= 3 and coalesce(registrar, '') not in {S.in_list(CLUSTER_EXEMPT_REGISTRARS)} as integer) as registrar_clustered,
  cast(coalesce(domain_age_days between 0 and 364, false)
       or (n >= 3 and coalesce(registrar, '') not in {S.in_list(CLUSTER_EXEMPT_REGISTRARS)}) as integer) as whois_flagged
from c
""")
def q_registrar_clusters(spark, sf_dir):
    reg = _reg(spark, sf_dir).select("domain", "registrar", "domain_age_days")
    return registrar_clusters(reg, CFG)


@register("registration_repair", ops=("B28",), sql=f"""
select domain, registrar, domain_age_days,
  case when domain_age_days is null or domain_age_days = -1 or lower(registrar) = 'unknown' then 0
       when domain_age_days between 0 and 364 then 1
       when {' or '.join(f"contains(lower(registrar), {S.q(b)})" for b in BULK_REGISTRARS)} then 1
       else 0 end as whois_flagged
from ({REG_SQL}) g
""")
def q_registration_repair(spark, sf_dir):
    return registration_repair(_reg(spark, sf_dir).select("domain", "registrar", "domain_age_days"))


# ---------------------------------------------------------------- hosting


def _hosting(spark, sf_dir):
    t = Tables(spark, sf_dir)
    h = hosting_records_from_org(M.hosting_records(t))
    return hosting_signal(M.analysed_domains(t), h, M.registration_records(t))


HOST_LIVE_SQL = f"""
with h as ({S.HOSTING}),
r as (select domain, created_date as created_day, lower(trim(registrar)) as reg_norm from ({S.REG_RECORDS}) x),
live as (
  select h.domain, ip_address, asn, hosting_org, {S.sql_is_cdn('ip_address', 'asn', 'hosting_org')} as is_cdn,
    case when ip_address is not null and ip_address <> '' then ip_address end as k_ip,
    case when asn is not null and asn <> '' and asn not in {S.in_list(CDN_ASNS)} then asn end as k_asn,
    case when ip_address is not null and ip_address <> '' and created_day is not null and reg_norm is not null
              and reg_norm <> '' and reg_norm <> 'unknown'
         then ip_address || '|' || cast(created_day as varchar) || '|' || reg_norm end as k_ip_gate,
    case when asn is not null and asn <> '' and asn not in {S.in_list(CDN_ASNS)} and created_day is not null
              and reg_norm is not null and reg_norm <> '' and reg_norm <> 'unknown'
         then asn || '|' || cast(created_day as varchar) || '|' || reg_norm end as k_asn_gate
  from h left join r on h.domain = r.domain where status = 'ok'),
c as (
  select *,
    case when k_ip is not null then count(*) over (partition by k_ip) end as n_ip,
    case when k_asn is not null then count(*) over (partition by k_asn) end as n_asn,
    case when k_ip_gate is not null then count(*) over (partition by k_ip_gate) end as n_ip_gate,
    case when k_asn_gate is not null then count(*) over (partition by k_asn_gate) end as n_asn_gate
  from live),
s as (
  select d.domain, ip_address, asn, hosting_org, coalesce(is_cdn, false) as is_cdn,
    cast(greatest(coalesce(n_ip, 1) - 1, 0) as integer) as shared_ip_count,
    cast(greatest(coalesce(n_asn, 1) - 1, 0) as integer) as shared_asn_count,
    cast(case when coalesce(is_cdn, false)
              then greatest(coalesce(n_ip_gate, 1) - 1, 0) + greatest(coalesce(n_asn_gate, 1) - 1, 0) > 0
              else greatest(coalesce(n_ip, 1) - 1, 0) + greatest(coalesce(n_asn, 1) - 1, 0) > 0 end as integer)
      as hosting_flagged,
    k_ip, k_asn, k_ip_gate, k_asn_gate
  from ({S.ANALYSED}) d left join c on d.domain = c.domain)
"""

HOSTING_COLS = ["domain", "ip_address", "asn", "hosting_org", "is_cdn", "shared_ip_count",
                "shared_asn_count", "hosting_flagged"]


@register("hosting_signal", ops=("C7", "C8", "C9", "B9", "B35", "H13"),
          sql=HOST_LIVE_SQL + f"select {', '.join(HOSTING_COLS)} from s")
def q_hosting_signal(spark, sf_dir):
    return _hosting(spark, sf_dir).select(*HOSTING_COLS)


@register("host_group_pairs", ops=("C7", "C8", "C10"), sql=HOST_LIVE_SQL + """
, m as (
  select domain, 'SAME_IP' as edge_type, case when is_cdn then k_ip_gate else k_ip end as group_key
  from s where hosting_flagged = 1
  union all
  select domain, 'SAME_ASN', case when is_cdn then k_asn_gate else k_asn end from s where hosting_flagged = 1),
g as (select edge_type, group_key, count(*) as n from m where group_key is not null group by 1, 2),
i as (select a.group_key, b.group_key as ip_key, count(*) as k from m a join m b on a.domain = b.domain
      where a.edge_type = 'SAME_ASN' and b.edge_type = 'SAME_IP' and a.group_key is not null and b.group_key is not null group by 1, 2),
j as (select group_key, sum(cast(k * (k - 1) / 2 as bigint)) as taken from i group by 1)
select edge_type, g.group_key, n, cast(n * (n - 1) / 2 as bigint) - case when edge_type = 'SAME_ASN' then cast(coalesce(taken, 0) as bigint) else 0 end as pairs
from g left join j on g.group_key = j.group_key where n > 1
""")
def q_host_group_pairs(spark, sf_dir):
    return host_pair_counts(host_memberships(_hosting(spark, sf_dir)))


# ---------------------------------------------------------------- links

LINK_SQL = f"""
with l as ({S.OUTLINKS}),
s as (select distinct domain from ({S.ANALYSED}) a),
ps as (select src as domain, count(*) as n_links,
              sum(case when s.domain is not null and l.dst <> l.src then 1 else 0 end) as in_set
       from l left join s on l.dst = s.domain group by src),
ls as (select * from l where src in (select domain from s) and dst in (select domain from s)),
mu as (select a.src as domain_a, a.dst as domain_b from ls a join ls b on a.src = b.dst and a.dst = b.src
       where a.src < a.dst),
mc as (select domain, count(*) as c from (select domain_a as domain from mu union all
                                          select domain_b from mu) x group by domain),
n as (select count(*) as set_size from s)
"""


@register("link_signal", ops=("C11", "C12", "D6", "D7", "G4"), sql=LINK_SQL + f"""
select s.domain, cast(coalesce(n_links, 0) as integer) as n_links,
  cast(coalesce(in_set, 0) as integer) as in_set_links,
  round(case when coalesce(n_links, 0) >= {CFG.min_links_insular}
             then coalesce(in_set, 0) / greatest(coalesce(n_links, 0), 1) else 0.0 end, 4) as insular_score,
  cast(coalesce(c, 0) as integer) as mutual_link_count,
  cast(coalesce(c, 0) > 0 or (
        (case when coalesce(n_links, 0) >= {CFG.min_links_insular}
              then coalesce(in_set, 0) / greatest(coalesce(n_links, 0), 1) else 0.0 end) >= {CFG.insular_threshold}
        and coalesce(n_links, 0) >= {CFG.min_links_insular} and set_size >= {CFG.min_domains_insular})
       as integer) as link_network_flagged
from s left join ps on s.domain = ps.domain left join mc on s.domain = mc.domain, n
""")
def q_link_signal(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return link_signal(M.outlinks(t), M.analysed_domains(t), CFG)


@register("mutual_link_pairs", ops=("C11", "H14"), sql=LINK_SQL + "select domain_a, domain_b from mu")
def q_mutual_link_pairs(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return mutual_links(M.outlinks(t), M.analysed_domains(t))


# ---------------------------------------------------------------- archive

ARCHIVE_SQL = f"""
with sn as ({S.SNAPSHOTS}),
m as (select domain, substr(ts, 1, 6) as month, min(ts) as ts from sn where length(ts) >= 8 group by 1, 2),
k as (select *, row_number() over (partition by domain order by month) as rn from m),
f as (select domain, count(*) as cnt, substr(min(ts), 1, 8) as first_seen,
             sum(case when substr(ts, 1, 8) >= strftime({S.AS_OF_DATE} - interval {CFG.wayback_recent_days} day, '%Y%m%d')
                      then 1 else 0 end) as recent
      from k where rn <= {CFG.wayback_max_rows} group by domain),
j as (select d.domain, f.cnt, f.first_seen, f.recent,
             cast(date_diff('day', cast(strptime(f.first_seen, '%Y%m%d') as date), {S.AS_OF_DATE}) as integer) as age
      from ({S.ANALYSED}) d left join f on d.domain = f.domain)
select domain, cast(coalesce(cnt, 0) as integer) as wayback_snapshot_count,
  coalesce(first_seen, '') as wayback_first_seen,
  cast(coalesce(recent, 0) as integer) as wayback_recent_count,
  age as wayback_age_days,
  cast(coalesce((cnt < {CFG.wayback_min_snapshots})
        or (cnt >= {CFG.wayback_min_snapshots} and recent >= 2 and recent / greatest(cnt, 1) >= {CFG.wayback_spike_ratio}),
        false) as integer) as wayback_flagged,
  case when cnt < {CFG.wayback_min_snapshots} then 'new_site'
       when cnt >= {CFG.wayback_min_snapshots} and recent >= 2 and recent / greatest(cnt, 1) >= {CFG.wayback_spike_ratio}
       then 'recent_spike' else '' end as wayback_flag_reason
from j
"""


@register("archive_signal", ops=("D8", "B26"), sql=ARCHIVE_SQL)
def q_archive_signal(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return archive_flags(M.analysed_domains(t), archive_features(M.snapshots(t), CFG), CFG)


# ---------------------------------------------------------------- authors

AUTHOR_SQL = f"""
with b as ({S.BYLINES}),
v as (select domain, {S.sql_strip('lower(author)')} as author_norm, author from b
      where length({S.sql_strip('lower(author)')}) >= 5
        and {S.sql_strip('lower(author)')} not in {S.NOISE_AUTHORS_SQL}),
g as (select domain, author_norm, min(author) as author from v group by 1, 2),
sz as (select author_norm, count(*) as author_domains from g group by 1),
m as (select g.*, sz.author_domains from g join sz on g.author_norm = sz.author_norm where author_domains > 1)
"""


@register("author_signal", ops=("D9", "C13", "B10", "H21"), sql=AUTHOR_SQL + f"""
, c as (select domain, count(*) as n from m group by 1),
t as (select domain, string_agg(author, '|' order by author_norm) as names
      from (select *, row_number() over (partition by domain order by author_norm) as rk from m) x
      where rk <= 3 group by 1)
select d.domain, cast(coalesce(n, 0) as integer) as shared_author_count,
  coalesce(names, '') as shared_authors, cast(coalesce(n, 0) > 0 as integer) as author_overlap_flagged
from ({S.ANALYSED}) d left join c on d.domain = c.domain left join t on d.domain = t.domain
""")
def q_author_signal(spark, sf_dir):
    t = Tables(spark, sf_dir)
    a = author_signal(M.analysed_domains(t), M.bylines(t))
    return a.withColumn("shared_authors", F.concat_ws("|", "shared_authors"))


@register("author_group_pairs", ops=("C13", "D9"), sql=AUTHOR_SQL + """
select distinct author_norm, cast(author_domains as bigint) as n,
  cast(author_domains * (author_domains - 1) / 2 as bigint) as pairs from m
""")
def q_author_group_pairs(spark, sf_dir):
    return author_pair_counts(author_memberships(M.bylines(Tables(spark, sf_dir))))
