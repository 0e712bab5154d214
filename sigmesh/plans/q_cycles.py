"""Streams of the monitor: cycles per micro-batch (S4, Q5), bursts (S6) and sliding totals."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators.verdict import verdicts
from ..session import ensure_checkpoint_dir
from ..sources.tables import Tables, table_path
from ..streaming.cycles import run_cycles
from ..streaming.monitor import burst_sessions, parquet_stream, run_append, run_updates, sliding_trend
from . import mapping as M
from .q_similarity import SIM_CFG
from .q_verdict import VERDICT_SQL, build_features
from .registry import register

#: Seconds of feed in one cycle of the query (three days).
CYCLE = 259200
FEED = "source string, domain string, ran_at timestamp"


def _feed_files(spark, sf_dir) -> str:
    """The feed as one file per cycle, in the shared folder."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/feed-{uuid.uuid4().hex[:12]}"
    e = Tables(spark, sf_dir).events
    start = F.timestamp_seconds(F.floor(F.unix_timestamp(F.col("ts").cast("timestamp")) / CYCLE) * CYCLE)
    rows = e.select(F.when(F.col("user_id") % 5 == 0, "registration").otherwise("social").alias("source"), M.dom("user_id").alias("domain"),
                    start.alias("ran_at")).distinct()
    rows.withColumn("cycle", F.unix_timestamp("ran_at")).repartition("cycle").write.partitionBy("cycle").parquet(path)
    return path


@register("monitor_cycle_stream", ops=("S4", "Q5", "S3", "D13", "F8"), sql=f"""
with f as (select distinct make_timestamp(cast(floor(epoch(ts) / {CYCLE}) as bigint) * {CYCLE} * 1000000) as ran_at,
                  'd' || cast(user_id as varchar) as domain, user_id % 5 = 0 as registered from events),
c as (select ran_at, count(*) filter (where registered) as whoisds_count, count(*) filter (where not registered) as reddit_count from f group by 1),
t as (select *, row_number() over (partition by ran_at order by domain) as rk from f),
b0 as (select t.ran_at, cast(floor((rk - 1) / 10) as integer) as chunk, v.verdict
       from t left join ({VERDICT_SQL}) v on t.domain = v.domain where rk <= 40),
b as (select ran_at, chunk, max(cast(coalesce(verdict, '') = 'SYNTHETIC' as integer)) as syn, count(*) as n from b0 group by 1, 2)
select b.ran_at, cast(any_value(whoisds_count) as integer) as whoisds_count, cast(any_value(reddit_count) as integer) as reddit_count,
       cast(sum(n) as integer) as queued_unique, cast(count(*) as integer) as batches, cast(count(*) as integer) as results,
       cast(sum(syn) as integer) as synthetic_batches
from b join c on b.ran_at = c.ran_at group by b.ran_at
""")
def q_monitor_cycle_stream(spark, sf_dir):
    """A cycle per feed file: each chunk of ten domains analysed by itself, summaries per batch."""
    known = verdicts(build_features(spark, sf_dir), SIM_CFG).select("domain", "verdict").checkpoint()
    feed = (spark.readStream.schema(FEED).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true")
            .parquet(_feed_files(spark, sf_dir)))
    store = run_cycles(feed, lambda names: names.join(known, "domain", "left"))
    return store.summaries().drop("batch_id")


@register("stream_bursts", ops=("S6", "S3"), sql="""
with e as (select 'd' || cast(user_id as varchar) as domain, ts, lag(ts) over (partition by user_id order by ts) as before from events),
s as (select *, sum(case when before is null or ts > before + INTERVAL 1 HOUR then 1 else 0 end)
                over (partition by domain order by ts rows unbounded preceding) as k from e)
select domain, min(ts) as burst_start, max(ts) as last_page, count(*) as pages from s group by domain, k
having max(ts) + INTERVAL 1 HOUR <= (select max(ts) - INTERVAL 1 HOUR from events)
""")
def q_stream_bursts(spark, sf_dir):
    s = parquet_stream(spark, table_path(sf_dir, "events")).select(M.dom("user_id").alias("domain"), "ts")
    return run_append(spark, burst_sessions(s), "bursts")


@register("stream_sliding_trend", ops=("S5", "S3"), sql="""
with e as (select time_bucket(INTERVAL 6 HOUR, ts) as b from events),
w as (select b - INTERVAL 6 HOUR * k as window_start from e, (select unnest(range(0, 4)) as k) s)
select window_start, window_start + INTERVAL 24 HOUR as window_end, count(*) as events from w group by window_start
""")
def q_stream_sliding_trend(spark, sf_dir):
    s = parquet_stream(spark, table_path(sf_dir, "events"))
    return run_updates(spark, sliding_trend(s), ["window_start", "window_end"], ["events"], "sliding")
