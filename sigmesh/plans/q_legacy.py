"""Legacy batch build and retrain queries, plus evaluation-side helpers
(D2, D4, D5, D18, D27, F4, C15, G2, B5, B33, Q7, Q8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import CLUSTER_EXEMPT_REGISTRARS, RETRAIN_KEYWORDS
from ..functions.domains import suspicious_name_retrain
from ..operators.cadence import cadence_features, cadence_rule_flag
from ..operators.evaluate import SIGNALS7, evaluation_source, to_binary
from ..operators.registration import registrar_clusters, registration_signal
from ..operators.similarity import (average_similarity_linear, block_products, blocks_for, edge_features,
                                    pairs_or_top, prepare_vectors, similarity_pairs)
from ..operators.verdict import verdict_col
from ..session import stored
from ..sources.tables import Tables
from . import mapping as M
from . import sql_mapping as S
from .q_cadence import CADENCE_SQL_CORE
from .q_evaluate import LOG_SQL, eval_log
from .q_signals import CFG, REG_SQL
from .q_similarity import SIM_CFG
from .q_text import sql_suspicious_kw
from .registry import register

LEGACY_EDGE = 0.30   # legacy edge threshold on the mapped vectors (setting; the source used .5)
LEGACY_FLAG = 0.85


PLAIN_CFG = SIM_CFG.with_(sim_threshold=LEGACY_EDGE, sim_edge_threshold=LEGACY_EDGE)


def _plain_vectors(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return t, prepare_vectors(M.vectors(t), SIM_CFG)


def _plain_pairs(spark, sf_dir):
    """Pairs by plain cosine; made by each reader."""
    t, prep = _plain_vectors(spark, sf_dir)
    return t, prep, similarity_pairs(block_products(prep, PLAIN_CFG, blocks_for(t.embeddings.count()), plain=True, sums=False))


PLAIN_PAIRS_SQL = f"""
with v as ({S.VECTORS}), a as (select domain, cast(embedding as double[]) as e from v),
p as (select x.domain as da, y.domain as db, list_cosine_similarity(x.e, y.e) as raw
      from a x join a y on x.domain < y.domain)
select da as domain_a, db as domain_b, raw from p where raw >= {LEGACY_EDGE}
"""
EDGE_FEAT_SQL = f"""
with e as ({PLAIN_PAIRS_SQL}),
u as (select domain_a as domain, raw from e union all select domain_b, raw from e),
g as (select domain, favg(raw) as a, max(raw) as m, count(*) as c from u group by domain)
select d.domain, round(coalesce(a, 0.0), 4) + 0.0 as avg_similarity, round(coalesce(m, 0.0), 4) + 0.0 as max_similarity,
  cast(coalesce(c, 0) as integer) as similar_count, cast(coalesce(m, 0.0) >= {LEGACY_FLAG} as integer) as similarity_flag
from ({S.ANALYSED}) d left join g on d.domain = g.domain
"""


@register("similarity_edge_features", sql=EDGE_FEAT_SQL, ops=("D2", "C3"))
def q_similarity_edge_features(spark, sf_dir):
    t, prep, pairs = _plain_pairs(spark, sf_dir)
    return edge_features(M.analysed_domains(t), pairs, LEGACY_FLAG)


LEGACY_SQL = f"""
with s as ({EDGE_FEAT_SQL}),
c as (select domain, hour_variance, burst_score,
             cast((burst_score >= 0.13 or hour_variance <= 35.0) as integer) as cadence_flagged
      from ({CADENCE_SQL_CORE}) c0),
r0 as ({REG_SQL}),
r as (select domain, domain_age_days, registrar,
        cast(coalesce(domain_age_days between 0 and 364, false) or (count(*) over (partition by registrar) >= 3
             and coalesce(registrar, '') not in {S.in_list(CLUSTER_EXEMPT_REGISTRARS)})
             as integer) as whois_flagged from r0),
l as (select 'd' || cast(doc_id as varchar) as domain, cast(1 - quality as integer) as label from labels),
j as (select s.domain, s.avg_similarity, s.max_similarity, s.similar_count, s.similarity_flag,
        coalesce(c.hour_variance, 0.0) as hour_variance, coalesce(c.burst_score, 0.0) as burst_score,
        coalesce(c.cadence_flagged, 0) as cadence_flagged, coalesce(r.domain_age_days, -1) as domain_age_days,
        coalesce(r.registrar, 'unknown') as registrar, coalesce(r.whois_flagged, 0) as whois_flagged,
        coalesce(l.label, -1) as label
      from s left join c on s.domain = c.domain left join r on s.domain = r.domain left join l on s.domain = l.domain)
select *, cast(similarity_flag + cadence_flagged + whois_flagged as integer) as signals,
  case when similarity_flag + cadence_flagged + whois_flagged >= 2 then 'SYNTHETIC'
       when similarity_flag + cadence_flagged + whois_flagged = 1 then 'REVIEW' else 'ORGANIC' end as verdict
from j
"""


@register("similarity_pairs_or_top", ops=("F2", "C3"), sql=f"""
with v as ({S.VECTORS}), a as (select domain, cast(embedding as double[]) as e from v),
p as (select x.domain as domain_a, y.domain as domain_b, list_cosine_similarity(x.e, y.e) as raw
      from a x join a y on x.domain < y.domain),
o as (select * from p where raw >= 0.5)
select domain_a, domain_b, round(raw, 4) + 0.0 as score from o
union all
select domain_a, domain_b, round(raw, 4) + 0.0 from (select * from p order by raw desc, domain_a, domain_b limit 100) t
where (select count(*) from o) = 0
""")
def q_similarity_pairs_or_top(spark, sf_dir):
    """Legacy edges at .5 with the top-100 fallback (plain cosine)."""
    t = Tables(spark, sf_dir)
    prep = prepare_vectors(M.vectors(t), SIM_CFG)
    cfg = SIM_CFG.with_(sim_threshold=0.5, sim_edge_threshold=0.5)
    b = stored(block_products(prep, cfg, blocks_for(t.embeddings.count()), plain=True, top_k=100, sums=False))
    return pairs_or_top(b, 100).select("domain_a", "domain_b", F.round("raw", 4).alias("score"))


@register("legacy_feature_table", sql=LEGACY_SQL, ops=("Q7", "C1", "C15", "D1", "D2", "D5", "B11", "B33"))
def q_legacy_feature_table(spark, sf_dir):
    return legacy_nodes(spark, sf_dir)


def legacy_nodes(spark, sf_dir, pairs=None):
    """The legacy feature table; ``pairs`` are given by a caller that has them."""
    t = Tables(spark, sf_dir)
    if pairs is None:
        _, _, pairs = _plain_pairs(spark, sf_dir)
    doms = M.analysed_domains(t)
    sim = edge_features(doms, pairs, LEGACY_FLAG)
    cad = cadence_rule_flag(cadence_features(M.publish_times(t))).select("domain", "hour_variance", "burst_score",
                                                                          "cadence_flagged")
    reg = registrar_clusters(registration_signal(doms, M.registration_records(t), CFG)
                             .select("domain", "registrar", "domain_age_days"), CFG) \
        .select("domain", "domain_age_days", "registrar", "whois_flagged")
    lab = t.labels.select(M.dom("doc_id").alias("domain"), (1 - F.col("quality")).cast("int").alias("label"))
    j = sim.join(cad, "domain", "left").join(reg, "domain", "left").join(lab, "domain", "left")
    j = j.fillna({"hour_variance": 0.0, "burst_score": 0.0, "cadence_flagged": 0, "domain_age_days": -1,
                  "registrar": "unknown", "whois_flagged": 0, "label": -1})
    n = (F.col("similarity_flag") + F.col("cadence_flagged") + F.col("whois_flagged")).cast("int")
    return j.withColumn("signals", n).withColumn("verdict", verdict_col("signals", "legacy"))


@register("retrain_features", ops=("Q8", "D4", "B5", "B11"), sql=f"""
with v as ({S.VECTORS}), a as (select domain, cast(embedding as double[]) as e from v),
n as (select count(*) as n from a),
p as (select x.domain, sum(case when x.domain <> y.domain then list_cosine_similarity(x.e, y.e) else 0 end) as s,
             sum(case when x.domain <> y.domain and list_cosine_similarity(x.e, y.e) >= {LEGACY_EDGE} then 1 else 0 end) as k
      from a x, a y group by x.domain)
select p.domain, round(s / greatest(n.n - 1, 1), 6) + 0.0 as avg_cosine, cast(k as integer) as neighbours,
  cast({sql_suspicious_kw('p.domain', RETRAIN_KEYWORDS)} as integer) as whois_flagged,
  cast((k > 0) as integer) + cast({sql_suspicious_kw('p.domain', RETRAIN_KEYWORDS)} as integer) as signals,
  case when cast((k > 0) as integer) + cast({sql_suspicious_kw('p.domain', RETRAIN_KEYWORDS)} as integer) >= 2 then 'SYNTHETIC'
       when cast((k > 0) as integer) + cast({sql_suspicious_kw('p.domain', RETRAIN_KEYWORDS)} as integer) = 1 then 'REVIEW'
       else 'ORGANIC' end as verdict
from p, n
""")
def q_retrain_features(spark, sf_dir):
    t, prep, pairs = _plain_pairs(spark, sf_dir)
    avg = average_similarity_linear(prep)
    k = (pairs.select(F.explode(F.array("domain_a", "domain_b")).alias("domain"))
         .groupBy("domain").agg(F.count(F.lit(1)).alias("k")))
    j = avg.join(k, "domain", "left").withColumn("k", F.coalesce("k", F.lit(0)))
    w = suspicious_name_retrain("domain").cast("int")
    n = ((F.col("k") > 0).cast("int") + w)
    return j.select("domain", F.round("avg_cosine", 6).alias("avg_cosine"), F.col("k").cast("int").alias("neighbours"),
                    w.alias("whois_flagged"), n.alias("signals"), verdict_col(n, "legacy").alias("verdict"))


@register("evaluation_source", ops=("D27",), sql=LOG_SQL + """
select case when firing >= 3 and positives > 0 then 'log' else 'features' end as source, firing as signals_firing, positives
from (select cast(""" + " + ".join(f"cast(sum({s}) > 0 as integer)" for s in SIGNALS7) + """ as integer) as firing,
             cast(sum(predicted_label) as bigint) as positives from log) x
""")
def q_evaluation_source(spark, sf_dir):
    """The log serves if three signals fire at all and it predicts positives; else the feature table does."""
    return evaluation_source(eval_log(spark, sf_dir))


@register("cluster_eval", ops=("D18", "B31"), sql=LOG_SQL + """
select label, count(*) as domains, round(avg(predicted_label), 4) as flagged_rate,
       round(avg(signals_triggered), 4) as mean_signals
from log group by label
""")
def q_cluster_eval(spark, sf_dir):
    log = eval_log(spark, sf_dir)
    return log.groupBy("label").agg(F.count(F.lit(1)).alias("domains"),
                                    F.round(F.avg(to_binary("predicted_verdict")), 4).alias("flagged_rate"),
                                    F.round(F.avg("signals_triggered"), 4).alias("mean_signals"))


@register("top_suspicious", ops=("F4",), sql=LOG_SQL + """
select doc_id, score, signals_triggered from log where label in (0, 1)
order by score desc, doc_id asc limit 10
""")
def q_top_suspicious(spark, sf_dir):
    log = eval_log(spark, sf_dir)
    return (log.filter(F.col("label").isin(0, 1)).orderBy(F.desc("score"), F.asc("doc_id")).limit(10)
            .select("doc_id", "score", "signals_triggered"))


@register("unlabelled_documents", ops=("C15", "G6", "G7"), sql="""
select lang, count(*) as docs from documents d where not exists (select 1 from labels l where l.doc_id = d.doc_id)
group by lang
""")
def q_unlabelled_documents(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return (t.documents.join(t.labels.select("doc_id"), "doc_id", "left_anti")
            .groupBy("lang").agg(F.count(F.lit(1)).alias("docs")))


@register("labelled_union", ops=("G2", "G7", "D19"), sql="""
select source, label, count(*) as n from (
  select doc_id, cast(1 - quality as integer) as label, 'quality' as source from labels where quality in (0, 1)
  union all
  select doc_id, cast(toxic as integer), 'toxicity' from labels where toxic in (0, 1)) u
group by source, label
""")
def q_labelled_union(spark, sf_dir):
    lab = Tables(spark, sf_dir).labels
    a = lab.filter(F.col("quality").isin(0, 1)).select("doc_id", (1 - F.col("quality")).cast("int").alias("label"),
                                                      F.lit("quality").alias("source"))
    b = lab.filter(F.col("toxic").isin(0, 1)).select("doc_id", F.col("toxic").cast("int").alias("label"),
                                                    F.lit("toxicity").alias("source"))
    return a.unionByName(b).groupBy("source", "label").agg(F.count(F.lit(1)).alias("n"))


@register("labelled_shuffle", ops=("F11",))
def q_labelled_shuffle(spark, sf_dir):
    """Deterministic shuffle of the labelled set: a seeded hash order."""
    lab = Tables(spark, sf_dir).labels
    return lab.orderBy(F.xxhash64("doc_id", F.lit(42)), "doc_id").select("doc_id", "quality")
