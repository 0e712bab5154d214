"""Cadence queries on ``events``."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.cadence import cadence_features, cadence_rule_flag, top_bursty
from ..sources.tables import Tables
from . import mapping as M
from .registry import register

CADENCE_SQL_CORE = """
with r as (
  select 'd' || cast(user_id as varchar) as domain, hour(ts) as h, minute(ts) as m,
         isodow(ts) - 1 as wd
  from events where ts is not null
), hc as (
  select domain, h, count(*) as nh from r group by domain, h
), b as (
  select domain, max(nh) as max_nh from hc group by domain
)
select r.domain,
       cast(count(*) as integer) as page_count,
       round(avg(h), 2) as avg_hour,
       round(var_pop(h), 4) as hour_variance,
       round(var_pop(m), 4) as minute_variance,
       cast(count(distinct h) as integer) as unique_hours,
       cast(count(distinct wd) as integer) as unique_days,
       round(max(b.max_nh) / count(*), 4) as burst_score
from r join b on r.domain = b.domain
group by r.domain
"""


@register("cadence_features", sql=CADENCE_SQL_CORE, ops=("D1", "H9"))
def q_cadence_features(spark, sf_dir):
    return cadence_features(M.publish_times(Tables(spark, sf_dir)))


@register("cadence_top_bursty", ops=("D1", "F3", "H9"), sql=f"""
select *, cast((burst_score >= 0.13 or hour_variance <= 35.0) as integer) as cadence_flagged
from ({CADENCE_SQL_CORE}) f
order by burst_score desc, domain asc
limit 10
""")
def q_cadence_top_bursty(spark, sf_dir):
    return top_bursty(cadence_rule_flag(cadence_features(M.publish_times(Tables(spark, sf_dir)))), 10)


@register("cadence_flag_share", ops=("D1", "D19"), sql=f"""
select cast((burst_score >= 0.13 or hour_variance <= 35.0) as integer) as cadence_flagged,
       count(*) as domains
from ({CADENCE_SQL_CORE}) f group by 1
""")
def q_cadence_flag_share(spark, sf_dir):
    f = cadence_rule_flag(cadence_features(M.publish_times(Tables(spark, sf_dir))))
    return f.groupBy("cadence_flagged").agg(F.count(F.lit(1)).alias("domains"))
