"""Full analysis on the mapped tables: feature table, verdicts, roll-ups (Q1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import SIGNAL_COLUMNS, SIGNAL_NAMES
from ..operators.archive import archive_features, archive_flags
from ..operators.authors import author_signal
from ..operators.cadence import cadence_features, cadence_rule_flag
from ..operators.hosting import hosting_records_from_org, hosting_signal
from ..operators.links import link_signal
from ..operators.registration import registration_signal
from ..operators.similarity import similarity_scores_of
from ..operators.verdict import (SIGNAL_OUT, assemble_features, cluster_summary, domain_view, feature_table,
                                 risk_copy, verdicts)
from ..operators.skew import reuse
from ..sources.tables import Tables
from . import mapping as M
from . import sql_mapping as S
from .q_cadence import CADENCE_SQL_CORE
from .q_signals import ARCHIVE_SQL, AUTHOR_SQL, CFG, HOST_LIVE_SQL, LINK_SQL, REG_SQL
from .q_similarity import SCORES_SQL, SIM_CFG
from .registry import register

FEATURE_COLS = [
    "domain", "avg_similarity", "max_similarity", "similarity_flag", "similar_domain_count",
    "burst_score", "cadence_flagged", "domain_age_days", "whois_flagged", "registrar",
    "registration_country", "whois_source", "ip_address", "asn", "hosting_org", "is_cdn",
    "shared_ip_count", "shared_asn_count", "hosting_flagged", "mutual_link_count", "insular_score",
    "link_network_flagged", "wayback_snapshot_count", "wayback_first_seen", "wayback_recent_count",
    "wayback_age_days", "wayback_flagged", "wayback_flag_reason", "shared_author_count", "shared_authors",
    "author_overlap_flagged", "effective_age_days", "domain_age_source", "signals_triggered",
]


def build_features(spark, sf_dir):
    t = Tables(spark, sf_dir)
    doms = reuse(M.analysed_domains(t))          # the base of seven joins
    regs = reuse(M.registration_records(t))      # registration signal and CDN gate
    vecs = reuse(M.vectors(t))
    sim = similarity_scores_of(vecs, SIM_CFG, t.embeddings.count())
    cad = cadence_rule_flag(cadence_features(M.publish_times(t))).select("domain", "burst_score", "cadence_flagged")
    reg = registration_signal(doms, regs, CFG).drop("created_date")
    host = hosting_signal(doms, hosting_records_from_org(M.hosting_records(t)), regs) \
        .select("domain", "ip_address", "asn", "hosting_org", "is_cdn", "shared_ip_count",
                "shared_asn_count", "hosting_flagged")
    link = link_signal(M.outlinks(t), doms, CFG).select("domain", "mutual_link_count", "insular_score",
                                                         "link_network_flagged")
    arc = archive_flags(doms, archive_features(M.snapshots(t), CFG), CFG)
    auth = author_signal(doms, M.bylines(t))
    return feature_table(assemble_features(doms, sim, cad, reg, host, link, arc, auth)).select(*FEATURE_COLS)


def _flag_sum() -> str:
    return " + ".join(f"coalesce({c}, 0)" for c in SIGNAL_COLUMNS)


FEATURE_SQL = f"""
with base as (
  select d.domain,
    sim.avg_similarity, sim.max_similarity, sim.similarity_flag, sim.similar_domain_count,
    cad.burst_score, cad.cadence_flagged,
    reg.domain_age_days as reg_age, reg.whois_flagged, reg.registrar, reg.registration_country, reg.whois_source,
    host.ip_address, host.asn, host.hosting_org, host.is_cdn, host.shared_ip_count, host.shared_asn_count,
    host.hosting_flagged,
    link.mutual_link_count, link.insular_score, link.link_network_flagged,
    arc.wayback_snapshot_count, arc.wayback_first_seen, arc.wayback_recent_count, arc.wayback_age_days,
    arc.wayback_flagged, arc.wayback_flag_reason,
    auth.shared_author_count, auth.shared_authors, auth.author_overlap_flagged
  from (select distinct domain from ({S.ANALYSED}) a0) d
  left join ({SCORES_SQL}) sim on d.domain = sim.domain
  left join (select domain, burst_score,
                    cast((burst_score >= 0.13 or hour_variance <= 35.0) as integer) as cadence_flagged
             from ({CADENCE_SQL_CORE}) c0) cad on d.domain = cad.domain
  left join ({REG_SQL}) reg on d.domain = reg.domain
  left join ({HOST_LIVE_SQL} select * from s) host on d.domain = host.domain
  left join ({LINK_SQL} select s.domain, cast(coalesce(c, 0) as integer) as mutual_link_count,
               round(case when coalesce(n_links, 0) >= {CFG.min_links_insular}
                          then coalesce(in_set, 0) / greatest(coalesce(n_links, 0), 1) else 0.0 end, 4) as insular_score,
               cast(coalesce(c, 0) > 0 or (
                 (case when coalesce(n_links, 0) >= {CFG.min_links_insular}
                       then coalesce(in_set, 0) / greatest(coalesce(n_links, 0), 1) else 0.0 end) >= {CFG.insular_threshold}
                 and coalesce(n_links, 0) >= {CFG.min_links_insular} and set_size >= {CFG.min_domains_insular})
                 as integer) as link_network_flagged
             from s left join ps on s.domain = ps.domain left join mc on s.domain = mc.domain, n) link
    on d.domain = link.domain
  left join ({ARCHIVE_SQL}) arc on d.domain = arc.domain
  left join ({AUTHOR_SQL}
             , c as (select domain, count(*) as n from m group by 1),
             t as (select domain, list(author order by author_norm) as names
                   from (select *, row_number() over (partition by domain order by author_norm) as rk from m) x
                   where rk <= 3 group by 1)
             select d2.domain, cast(coalesce(n, 0) as integer) as shared_author_count,
                    coalesce(to_json(names), '[]') as shared_authors,
                    cast(coalesce(n, 0) > 0 as integer) as author_overlap_flagged
             from ({S.ANALYSED}) d2 left join c on d2.domain = c.domain left join t on d2.domain = t.domain) auth
    on d.domain = auth.domain
)
select domain,
  coalesce(avg_similarity, 0.0) as avg_similarity, coalesce(max_similarity, 0.0) as max_similarity,
  coalesce(similarity_flag, 0) as similarity_flag, coalesce(similar_domain_count, 0) as similar_domain_count,
  coalesce(burst_score, 0.0) as burst_score, coalesce(cadence_flagged, 0) as cadence_flagged,
  coalesce(reg_age, -1) as domain_age_days, coalesce(whois_flagged, 0) as whois_flagged,
  coalesce(registrar, 'unknown') as registrar, coalesce(registration_country, '') as registration_country,
  coalesce(whois_source, 'heuristic') as whois_source,
  coalesce(ip_address, '') as ip_address, coalesce(asn, '') as asn, coalesce(hosting_org, '') as hosting_org,
  coalesce(is_cdn, false) as is_cdn, coalesce(shared_ip_count, 0) as shared_ip_count,
  coalesce(shared_asn_count, 0) as shared_asn_count, coalesce(hosting_flagged, 0) as hosting_flagged,
  coalesce(mutual_link_count, 0) as mutual_link_count, coalesce(insular_score, 0.0) as insular_score,
  coalesce(link_network_flagged, 0) as link_network_flagged,
  coalesce(wayback_snapshot_count, 0) as wayback_snapshot_count,
  coalesce(wayback_first_seen, '') as wayback_first_seen,
  coalesce(wayback_recent_count, 0) as wayback_recent_count,
  coalesce(wayback_age_days, -1) as wayback_age_days, coalesce(wayback_flagged, 0) as wayback_flagged,
  coalesce(wayback_flag_reason, '') as wayback_flag_reason,
  coalesce(shared_author_count, 0) as shared_author_count, coalesce(shared_authors, '[]') as shared_authors,
  coalesce(author_overlap_flagged, 0) as author_overlap_flagged,
  cast(case when reg_age >= 0 then reg_age when wayback_age_days >= 0 then wayback_age_days else -1 end
       as integer) as effective_age_days,
  case when reg_age >= 0 then 'whois' when wayback_age_days >= 0 then 'wayback_estimate' else 'unknown' end
    as domain_age_source,
  cast({_flag_sum()} as integer) as signals_triggered
from base
"""


@register("feature_table", sql=FEATURE_SQL, ops=("C1", "C2", "B12", "B13", "B32", "B33"))
def q_feature_table(spark, sf_dir):
    return build_features(spark, sf_dir)


def D(v) -> str:
    """Double literal (DuckDB reads bare decimals as DECIMAL)."""
    return f"CAST({v} AS DOUBLE)"


def sql_confidence(n: str, sim: str, burst: str, prob: str = D(0.0)) -> str:
    boosts = f"(least({sim} * {D(0.20)}, {D(0.10)}) + least({burst} * {D(0.15)}, {D(0.06)}) + {prob} * {D(0.05)})"
    x = (f"(case when {n} >= 3 then greatest({D(0.65)}, least({D(0.65)} + least(({n} - 3) / {D(4.0)}, {D(1.0)}) * {D(0.20)} + {boosts}, {D(0.97)}))"
         f" when {n} >= 1 then greatest({D(0.02)}, least({D(0.40)} + ({n} - 1) * {D(0.10)} + {boosts}, {D(0.64)}))"
         f" else greatest({D(0.70)}, least({D(1.0)} - {boosts}, {D(0.97)})) end)")
    return f"(floor({x} * {D(100.0)} + {D(0.5)}) / {D(100.0)})"


def sql_organic_confidence(sim: str, burst: str, prob: str = D(0.0)) -> str:
    boosts = f"(least({sim} * {D(0.20)}, {D(0.20)}) + least({burst} * {D(0.15)}, {D(0.10)}) + {prob} * {D(0.05)})"
    x = f"greatest({D(0.70)}, least({D(1.0)} - {boosts}, {D(0.97)}))"
    return f"(floor({x} * {D(100.0)} + {D(0.5)}) / {D(100.0)})"


def _verdict_sql() -> str:
    n = "signals_triggered"
    conf = sql_confidence(n, "max_similarity", "burst_score")
    org = sql_organic_confidence("max_similarity", "burst_score")
    verdict = f"case when {n} >= 3 then 'SYNTHETIC' when {n} = 2 then 'REVIEW' else 'ORGANIC' end"
    names = ("array_to_string(list_transform(cast(json(shared_authors) as varchar[])[1:3], "
             "lambda x: '\"' || x || '\"'), ', ')")
    reasons = [
        "case when similarity_flag = 1 then 'content is unusually similar to other domains (similarity ' || "
        "printf('%.2f', round(max_similarity, 2)) || ')' end",
        "case when cadence_flagged = 1 then 'anomalous publishing time pattern detected' end",
        "case when whois_flagged = 1 then 'suspicious domain registration pattern' end",
        "case when hosting_flagged = 1 then 'shares hosting infrastructure with other analyzed domains' end",
        "case when link_network_flagged = 1 then (case when mutual_link_count > 0 then "
        "printf('mutually links with %d other domain(s) in the cluster', mutual_link_count) else "
        "cast(cast(round(insular_score * 100, 0) as integer) as varchar) || '% of outgoing links stay within the analyzed cluster' end) end",
        "case when wayback_flagged = 1 then (case when wayback_flag_reason = 'new_site' then "
        "printf('only %d Wayback Machine snapshot(s) — site appears very new', wayback_snapshot_count) else "
        "printf('archive spike: %d of %d snapshots are from the last 30 days', wayback_recent_count, wayback_snapshot_count) end) end",
        f"case when author_overlap_flagged = 1 then 'author name(s) ' || {names} || ' appear across multiple domains' end",
    ]
    joined = "concat_ws('; ', " + ", ".join(reasons) + ")"
    any_r = " or ".join(f"({r}) is not null" for r in reasons)
    fired = "case " + " ".join(f"when {c} = 1 then '{nm}'" for c, nm in zip(SIGNAL_COLUMNS, SIGNAL_NAMES)) + \
        " else 'unknown signal' end"
    expl = (f"case when {n} = 1 then domain || ' — ' || {fired} || ' signal fired (1/7), but no other signals "
            "corroborate it. The 3-of-7 convergence rule requires at least 2 independent signals before flagging "
            "a domain as Suspicious. A single signal may reflect legitimate syndication, regional topic overlap, "
            "or common hosting. Verdict: Looks Legitimate.' "
            f"when not ({any_r}) then domain || ' passed all 7 checks — no suspicious patterns detected. Content, "
            "hosting, link structure, archive history, and registration data all appear organic.' "
            f"else domain || ' triggered ' || cast({n} as varchar) || '/7 signals: ' || {joined} || '. ' || "
            f"(case when {n} >= 3 then printf('With %d signals converging, the 3-of-7 rule classifies this as a "
            f"synthetic network.', {n}) else printf('%d signal(s) detected — flagged for human review. Not enough "
            f"to confirm a fake network alone.', {n}) end) end")
    sig = ", ".join(f"cast({c} as integer) as {o}" for c, o in zip(SIGNAL_COLUMNS, SIGNAL_OUT))
    return f"""
select domain, {verdict} as verdict,
  case when ({verdict}) = 'ORGANIC' then {org} else {conf} end as confidence,
  CAST(0.0 AS DOUBLE) as gnn_raw_score, {n}, {sig},
  max_similarity, burst_score, effective_age_days as domain_age_days, domain_age_source, ip_address,
  hosting_org, insular_score, wayback_snapshot_count, wayback_flag_reason, shared_authors,
  {expl} as explanation
from ({FEATURE_SQL}) f
"""


VERDICT_SQL = _verdict_sql()


@register("analysis_verdicts", sql=VERDICT_SQL, ops=("Q1", "B11", "B12", "B14", "B15", "B16", "H21"))
def q_analysis_verdicts(spark, sf_dir):
    return verdicts(build_features(spark, sf_dir), SIM_CFG)


@register("cluster_summary", ops=("D10", "D11", "B17"), sql=f"""
with v as ({VERDICT_SQL}),
g as (select cast(sum(case when verdict = 'SYNTHETIC' then 1 else 0 end) as bigint) as synthetic_domains,
             cast(sum(case when verdict = 'REVIEW' then 1 else 0 end) as bigint) as review_domains,
             cast(sum(case when verdict = 'ORGANIC' then 1 else 0 end) as bigint) as organic_domains,
             round(max(confidence), 4) as max_confidence, count(*) as domains from v)
select *, case when synthetic_domains > 0 then 'SYNTHETIC' when review_domains > 0 then 'REVIEW'
               else 'ORGANIC' end as cluster_verdict from g
""")
def q_cluster_summary(spark, sf_dir):
    s = cluster_summary(verdicts(build_features(spark, sf_dir), SIM_CFG))
    return s.select(F.col("synthetic_domains").cast("long"), F.col("review_domains").cast("long"),
                    F.col("organic_domains").cast("long"), "max_confidence", "domains", "cluster_verdict")


@register("verdict_risk_counts", ops=("D19", "B17", "B11"), sql=f"""
select verdict, case when verdict = 'SYNTHETIC' then 'HIGH_RISK' when verdict = 'REVIEW' then 'SUSPICIOUS'
                     else 'LOW_RISK' end as risk_level, count(*) as domains
from ({VERDICT_SQL}) v group by all
""")
def q_verdict_risk_counts(spark, sf_dir):
    v = verdicts(build_features(spark, sf_dir), SIM_CFG)
    lvl, _ = risk_copy("verdict")
    return v.groupBy("verdict", lvl.alias("risk_level")).agg(F.count(F.lit(1)).alias("domains"))


@register("signal_counts", ops=("D21", "D22", "D16"), sql=f"""
with v as ({VERDICT_SQL}), n as (select count(*) as total from v),
u as (unpivot (select {', '.join(SIGNAL_OUT)} from v) on {', '.join(SIGNAL_OUT)} into name signal value fired)
select signal, cast(sum(fired) as bigint) as fired, round(sum(fired) / max(n.total), 4) as share
from u, n group by signal
""")
def q_signal_counts(spark, sf_dir):
    v = verdicts(build_features(spark, sf_dir), SIM_CFG)
    stack = "stack(7, " + ", ".join(f"'{c}', {c}" for c in SIGNAL_OUT) + ") as (signal, fired)"
    long = v.selectExpr(stack)
    return long.groupBy("signal").agg(F.sum("fired").cast("long").alias("fired"),
                                      F.round(F.sum("fired") / F.count(F.lit(1)), 4).alias("share"))


@register("domain_view", ops=("B37", "B11", "B14"), sql=f"""
with v as ({VERDICT_SQL}),
w as (select *, {' + '.join(f'coalesce({c}, 0)' for c in SIGNAL_OUT)} as sig from v)
select domain, cast(sig as integer) as signals,
  case when sig >= 3 then 'SYNTHETIC' when sig >= 1 then 'REVIEW' else 'ORGANIC' end as screen_verdict,
  {sql_confidence('sig', 'max_similarity', 'burst_score')} as screen_confidence,
  case when domain_age_days is null or domain_age_days < 0 then 'age unknown'
       when domain_age_source = 'wayback_estimate' then printf('~%d days (archive estimate)', domain_age_days)
       else printf('%d days old', domain_age_days) end as age_text,
  case when wayback_flag_reason = 'new_site' then 'new site' when coalesce(wayback_flag_reason, '') <> '' then 'archive spike'
       else printf('%d snapshots', coalesce(wayback_snapshot_count, 0)) end as archive_text,
  coalesce(cast(json(shared_authors) as varchar[])[1], '') as first_author
from w
""")
def q_domain_view(spark, sf_dir):
    return domain_view(verdicts(build_features(spark, sf_dir), SIM_CFG))
