"""Feed, monitor and streaming queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.domains import url_domain
from ..operators.monitor import merge_feeds, plan_batches, registration_feed_domains
from ..sources.tables import Tables, table_path
from ..streaming.monitor import cadence_stream, dedup_feed, parquet_stream, run_append, run_updates, \
    social_feed_domains, timeline
from . import mapping as M
from .q_text import sql_url_domain, sql_url_domain_any
from .registry import register

SOCIAL_SQL = f"""
select distinct d as domain from (select {sql_url_domain_any('url')} as d from pages) x
where d is not null and d <> '' and not contains(d, 'reddit.com')
"""
REG_FEED_SQL = f"""
select domain from (select distinct lower(trim({sql_url_domain('url')})) as domain from pages) x
where contains(domain, '.') and ({' or '.join(f"ends_with(domain, '{t}')" for t in
                                              ('.xyz', '.top', '.click', '.online', '.site', '.info', '.buzz', '.icu'))}
                                 or length(domain) - length(replace(domain, '-', '')) >= 2)
order by domain limit 500
"""


def _social(spark, sf_dir):
    return social_feed_domains(Tables(spark, sf_dir).pages.select("url"), "url")


def _regfeed(spark, sf_dir):
    p = Tables(spark, sf_dir).pages.select(url_domain("url").alias("domain")).filter(F.col("domain").isNotNull())
    return registration_feed_domains(p)


@register("social_feed_domains", sql=SOCIAL_SQL, ops=("A5", "H2"))
def q_social_feed_domains(spark, sf_dir):
    return _social(spark, sf_dir)


@register("registration_feed_domains", sql=REG_FEED_SQL, ops=("A6", "B4"))
def q_registration_feed_domains(spark, sf_dir):
    return _regfeed(spark, sf_dir)


@register("monitor_batches", ops=("F8", "G1", "Q5"), sql=f"""
with m as (select domain from ({SOCIAL_SQL}) a union select domain from ({REG_FEED_SQL}) b),
t as (select domain from m order by domain limit 40)
select domain, cast(floor((row_number() over (order by domain) - 1) / 10) as integer) as batch_id from t
""")
def q_monitor_batches(spark, sf_dir):
    return plan_batches(merge_feeds(_social(spark, sf_dir), _regfeed(spark, sf_dir)), 40, 10)


@register("stream_cadence_hourly", ops=("S6", "S3", "S4"), sql="""
select 'd' || cast(user_id as varchar) as domain, time_bucket(INTERVAL 1 HOUR, ts) as window_start,
       count(*) as pages
from events group by all
""")
def q_stream_cadence_hourly(spark, sf_dir):
    s = parquet_stream(spark, table_path(sf_dir, "events")).select(M.dom("user_id").alias("domain"), "ts")
    return run_updates(spark, cadence_stream(s), ["domain", "window_start"], ["pages"], "cadence")


@register("stream_timeline", ops=("S5", "S3", "S4"), sql="""
select time_bucket(INTERVAL 6 HOUR, ts) as window_start, time_bucket(INTERVAL 6 HOUR, ts) + INTERVAL 6 HOUR as window_end,
       count(*) as events
from events group by all
""")
def q_stream_timeline(spark, sf_dir):
    s = parquet_stream(spark, table_path(sf_dir, "events"))
    return run_updates(spark, timeline(s), ["window_start", "window_end"], ["events"], "timeline")


@register("stream_feed_dedup", ops=("S1", "S2", "S3"))
def q_stream_feed_dedup(spark, sf_dir):
    s = parquet_stream(spark, table_path(sf_dir, "events")).select(
        M.dom("user_id").alias("domain"), F.col("ts").alias("fetched_at"))
    return run_append(spark, dedup_feed(s, "fetched_at", "24 hours"), "dedup")
