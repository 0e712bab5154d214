"""Cluster runs (D18), the signal matrix (D22), the most anomalous cadences
and post listings with texts (A5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.cadence import cadence_features, top_anomalies
from ..operators.evaluate import cluster_runs, signal_matrix
from ..operators.models import forest_signal
from ..operators.verdict import SIGNAL_OUT, verdicts
from ..sources.tables import Tables
from ..streaming.monitor import listing_posts, social_feed_domains
from . import mapping as M
from .q_models import FOREST_COLS
from .q_similarity import SIM_CFG
from .q_text import sql_url_domain_any
from .q_verdict import VERDICT_SQL, build_features
from .registry import register

FLAGS = list(SIGNAL_OUT)


@register("cluster_runs", ops=("D18", "B31"), sql=f"""
with v as ({VERDICT_SQL}),
t as (select 'd' || doc_id as domain, cast(1 - quality as integer) as label from labels where quality in (0, 1)),
j as (select t.label, cast(coalesce(v.verdict, 'ORGANIC') in ('SYNTHETIC', 'REVIEW') as integer) as hit, {', '.join(f'coalesce(v.{c}, 0) as {c}' for c in FLAGS)}
      from t left join v on t.domain = v.domain),
g as (select label, case when label = 1 then 'synthetic_cluster' else 'organic_cluster' end as cluster, count(*) as n_domains, cast(sum(hit) as bigint) as n_flagged,
             {', '.join(f'cast(sum({c}) as bigint) as {c}' for c in FLAGS)} from j group by label),
o as (select coalesce(max(n_flagged) filter (where label = 1), 0) as tp, coalesce(max(n_domains - n_flagged) filter (where label = 1), 0) as fn,
             coalesce(max(n_flagged) filter (where label = 0), 0) as fp, coalesce(max(n_domains - n_flagged) filter (where label = 0), 0) as tn from g)
select cluster, n_domains, n_flagged, round(n_flagged / n_domains, 4) as flagged_rate, {', '.join(FLAGS)},
  null::bigint as tp, null::bigint as fn, null::bigint as fp, null::bigint as tn, null::double as precision, null::double as recall, null::double as f1 from g
union all
select 'overall', null, null, null, {', '.join('null' for _ in FLAGS)}, tp, fn, fp, tn, round(case when tp + fp > 0 then tp / (tp + fp) else 0.0 end, 4),
  round(case when tp + fn > 0 then tp / (tp + fn) else 0.0 end, 4), round(case when 2 * tp + fp + fn > 0 then 2 * tp / (2 * tp + fp + fn) else 0.0 end, 4) from o
""")
def q_cluster_runs(spark, sf_dir):
    """All labelled positive domains as one cluster and all negative ones as another, judged by the analysis."""
    v = verdicts(build_features(spark, sf_dir), SIM_CFG)
    truth = Tables(spark, sf_dir).labels.filter("quality in (0, 1)").select(M.dom("doc_id").alias("domain"), (1 - F.col("quality")).cast("int").alias("label"))
    return cluster_runs(v, truth, FLAGS)


@register("signal_matrix", ops=("D22",), sql=f"""
with v as ({VERDICT_SQL})
select domain, signal, cast(fired as integer) as fired
from (unpivot (select domain, {', '.join(f'coalesce({c}, 0) as {c}' for c in FLAGS)} from v) on {', '.join(FLAGS)} into name signal value fired) u
""")
def q_signal_matrix(spark, sf_dir):
    return signal_matrix(verdicts(build_features(spark, sf_dir), SIM_CFG), FLAGS)


@register("cadence_top_anomalies", ops=("F3", "I6"))
def q_cadence_top_anomalies(spark, sf_dir):
    """The five most anomalous publishing cadences by the forest."""
    return top_anomalies(forest_signal(cadence_features(M.publish_times(Tables(spark, sf_dir))), FOREST_COLS), 5)


def _listings(t: Tables):
    """Pages as posts in listing documents of 25: some lead elsewhere, some have addresses in their text."""
    i = F.col("page_id")
    elsewhere = F.when(i % 4 == 0, F.concat(F.lit("https://www.Moved"), i.cast("string"), F.lit(".example/x"))).when(i % 4 == 1, F.lit(""))
    said = F.when(i % 3 == 0, F.concat(F.lit("see (http://said"), (i % 40).cast("string"), F.lit(".example/a) and https://old.reddit.com/r/x [or] http://nodot/y")))
    post = F.struct(F.struct(F.col("url"), elsewhere.alias("url_overridden_by_dest"), said.alias("selftext")).alias("data"))
    groups = t.pages.groupBy(F.floor(i / 25).alias("g")).agg(F.collect_list(post).alias("children"))
    return groups.select(F.to_json(F.struct(F.struct("children").alias("data"))).alias("listing"))


_POSTS_SQL = f"""
select case when page_id % 4 = 0 then 'https://www.Moved' || page_id || '.example/x' else url end as u from pages
union all select 'http://said' || (page_id % 40) || '.example/a' from pages where page_id % 3 = 0
"""


@register("social_listing_domains", ops=("A5", "H2"), sql=f"""
select distinct d as domain from (select {sql_url_domain_any('u')} as d from ({_POSTS_SQL}) p) x
where d is not null and d <> '' and not contains(d, 'reddit.com')
""")
def q_social_listing_domains(spark, sf_dir):
    """Domains of nested listing documents: post addresses and those in post texts."""
    return social_feed_domains(listing_posts(_listings(Tables(spark, sf_dir))), "url", "selftext")


@register("social_listing_counts", ops=("A5",), sql=f"""
select (select count(*) from pages) as scanned_posts, count(distinct d) as domain_count from (select {sql_url_domain_any('u')} as d from ({_POSTS_SQL}) p) x
where d is not null and d <> '' and not contains(d, 'reddit.com')
""")
def q_social_listing_counts(spark, sf_dir):
    posts = listing_posts(_listings(Tables(spark, sf_dir)))
    n = posts.agg(F.count(F.lit(1)).alias("scanned_posts"))
    from ..operators.skew import one_row_join
    return one_row_join(n, social_feed_domains(posts, "url", "selftext").agg(F.count(F.lit(1)).alias("domain_count")))
