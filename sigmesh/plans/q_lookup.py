"""Lookup queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import CURRENT, PRELIMINARY_NONE, PRELIMINARY_REASONS, SUSPICIOUS_KEYWORDS, SUSPICIOUS_TLDS
from ..functions.domains import url_domain
from ..operators.lookup import cache_misses, latest_job, lookup, preliminary
from ..operators.registration import plan_lookups
from ..sources.tables import Tables
from . import mapping as M
from . import sql_mapping as S
from .q_text import sql_url_domain
from .q_verdict import FEATURE_SQL, build_features, sql_confidence
from .registry import register

# Lookup clock for the cache: half a day after the last order (snapshot) date.
CACHE_AS_OF = "2001-08-01 12:00:00"


def _page_hosts(t):
    return t.pages.select(url_domain("url").alias("domain")).filter(F.col("domain").isNotNull()).distinct()


def _tld(c):
    return "(" + " or ".join(f"ends_with({c}, {S.q(x)})" for x in SUSPICIOUS_TLDS) + ")"


def _promo(c):
    kw = " or ".join(f"contains({c}, {S.q(k)})" for k in SUSPICIOUS_KEYWORDS)
    return f"(({kw}) or (length({c}) - length(replace({c}, '-', ''))) >= 2)"


def _prelim_sql(src: str) -> str:
    r = [f"false", _tld("domain"), _promo("domain"), S.sql_suspicious("domain")]
    score = " + ".join(f"cast({x} as integer)" for x in r)
    reasons = ", ".join(f"case when {x} then {S.q(t)} end" for x, t in zip(r, PRELIMINARY_REASONS))
    return f"""
select domain, cast({score} as integer) as score,
  case when {score} >= 3 then 'SYNTHETIC' when {score} >= 1 then 'REVIEW' else 'ORGANIC' end as verdict,
  case when {score} >= 3 then 0.74 when {score} >= 1 then 0.58 else 0.76 end::double as confidence,
  coalesce(nullif(concat_ws('; ', {reasons}), ''), {S.q(PRELIMINARY_NONE)}) as explanation
from ({src}) s
"""


PAGE_HOSTS_SQL = f"select distinct {sql_url_domain('url')} as domain from pages where {sql_url_domain('url')} is not null"
PRELIM_SQL = _prelim_sql(PAGE_HOSTS_SQL)


@register("preliminary_verdicts", ops=("B18", "B17", "B4"), sql=f"""
select *, case when verdict = 'SYNTHETIC' then 'HIGH_RISK' when verdict = 'REVIEW' then 'SUSPICIOUS' else 'LOW_RISK' end
            as risk_level,
          case when verdict = 'SYNTHETIC' then 'High Risk - Likely part of a fake network'
               when verdict = 'REVIEW' then 'Suspicious - Some warning signs detected'
               else 'Looks Legitimate - No warning signs' end as headline
from ({PRELIM_SQL}) p
""")
def q_preliminary_verdicts(spark, sf_dir):
    return preliminary(_page_hosts(Tables(spark, sf_dir)))


REQUESTS_SQL = f"""
select domain from ({PAGE_HOSTS_SQL}) h
union select distinct 'd' || cast(l_partkey as varchar) from lineitem
"""


@register("domain_lookup", ops=("Q2", "B18", "C17"), sql=f"""
with f as ({FEATURE_SQL}), r as ({REQUESTS_SQL})
select r.domain, 'stored' as source,
  case when signals_triggered >= 3 then 'SYNTHETIC' when signals_triggered >= 1 then 'REVIEW' else 'ORGANIC' end
    as verdict,
  {sql_confidence('signals_triggered', 'max_similarity', 'burst_score')} as confidence
from r join f on r.domain = f.domain
union all
select domain, 'preliminary', verdict, confidence
from ({_prelim_sql(f"select domain from ({REQUESTS_SQL}) r0 where domain not in (select domain from ({S.ANALYSED}) a0)")}) p
""")
def q_domain_lookup(spark, sf_dir):
    t = Tables(spark, sf_dir)
    req = _page_hosts(t).unionByName(t.lineitem.select(M.dom("l_partkey").alias("domain"))).distinct()
    return lookup(req, build_features(spark, sf_dir))


@register("lookup_plan", ops=("A18", "B4"), sql=f"""
with h as ({PAGE_HOSTS_SQL}),
l as (select domain from h where {S.sql_suspicious('domain')} order by domain limit {CURRENT.whois_daily_limit})
select domain, 'lookup' as action from l
union all select domain, 'heuristic' from h where domain not in (select domain from l)
""")
def q_lookup_plan(spark, sf_dir):
    t = Tables(spark, sf_dir)
    empty_cache = spark.createDataFrame([], "domain string")
    return plan_lookups(_page_hosts(t), empty_cache, 0, CURRENT.whois_daily_limit)


@register("cache_misses", ops=("A17",), sql=f"""
with c as (select 'd' || cast(o_custkey as varchar) as domain, o_orderdate as cached_at from orders),
h as (select distinct domain from c
      where epoch(TIMESTAMP '{CACHE_AS_OF}') - epoch(cached_at) >= 0
        and epoch(TIMESTAMP '{CACHE_AS_OF}') - epoch(cached_at) < {CURRENT.cache_ttl_hours} * 3600)
select domain from ({S.ANALYSED}) a where domain not in (select domain from h)
""")
def q_cache_misses(spark, sf_dir):
    t = Tables(spark, sf_dir)
    cache = t.orders.select(M.dom("o_custkey").alias("domain"), F.col("o_orderdate").cast("timestamp").alias("cached_at"))
    return cache_misses(M.analysed_domains(t), cache, CACHE_AS_OF, CURRENT.cache_ttl_hours)


@register("latest_job", ops=("E2",), sql="""
select 'd' || cast(o_custkey as varchar) as domain, arg_max(o_orderkey, (o_orderdate, o_orderkey)) as job_id,
       max(o_orderdate) as finished_at
from orders where o_orderstatus = 'F' and o_totalprice > 0 group by o_custkey
""")
def q_latest_job(spark, sf_dir):
    """Orders as analysis jobs: status F = completed, a positive total = evidence."""
    o = Tables(spark, sf_dir).orders.select(
        M.dom("o_custkey").alias("domain"), F.col("o_orderkey").alias("job_id"),
        F.when(F.col("o_orderstatus") == "F", "completed").otherwise("running").alias("status"),
        F.col("o_orderdate").alias("finished_at"), (F.col("o_totalprice") > 0).alias("has_result"))
    return latest_job(o)
