"""One-to-many searches (C5, C6) and text encoding by a plugged-in model (I7); ROC points."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import excerpt
from ..functions.vectors import unit
from ..operators.encoder import encoded
from ..operators.evaluate import roc_points
from ..operators.search import search
from ..operators.similarity import prepare_vectors
from ..session import ensure_checkpoint_dir
from ..sources.tables import Tables
from . import mapping as M
from . import sql_mapping as S
from .q_evaluate import LOG_SQL, eval_log
from .q_similarity import SIM_CFG
from .registry import register

#: Every row whose id this divides is a seed.
SEED_EVERY = 50


@register("seed_search", ops=("C5", "B6", "F1"), sql=f"""
with v as ({S.VECTORS}),
a as (select domain, cast(embedding as double[]) as e, {S.sql_authority('domain')} as auth, cast(substr(domain, 2) as bigint) as id from v),
p as (select s.domain as seed, c.domain, list_cosine_similarity(s.e, c.e) as raw, s.auth as sa, c.auth as ca
      from a s join a c on c.domain <> s.domain where s.id % {SEED_EVERY} = 0),
g as (select seed, round(favg(raw), 4) + 0.0 as avg_similarity, round(max(raw), 4) + 0.0 as max_similarity,
        cast(max(raw) >= {SIM_CFG.sim_threshold} as integer) as similarity_flag,
        cast(sum(case when (case when sa and ca then raw * 0.5 when sa or ca then raw * 0.75 else raw end)
                       >= (case when sa and ca then {SIM_CFG.sim_threshold} * 1.5 when sa or ca
                                then {SIM_CFG.sim_threshold} * 1.2 else {SIM_CFG.sim_threshold} end)
                 then 1 else 0 end) as integer) as similar_domain_count
      from p group by seed),
t as (select seed, domain, row_number() over (partition by seed order by raw desc, domain) as rank from p),
b as (select seed, string_agg(domain, ',' order by rank) as best from t where rank <= 5 group by seed)
select g.*, b.best from g join b on g.seed = b.seed
""")
def q_seed_search(spark, sf_dir):
    """Every row whose id is divisible by 50 against all rows, with its five best."""
    ensure_checkpoint_dir(spark)
    prep = prepare_vectors(M.vectors(Tables(spark, sf_dir)), SIM_CFG).select("domain", "u").checkpoint()
    seeds = prep.filter(F.substring("domain", 2, 20).cast("long") % SEED_EVERY == 0)
    stats, best = search(seeds, prep, SIM_CFG, seeds.count(), prep.count())
    names = best.groupBy("seed").agg(F.array_sort(F.collect_list(F.struct("rank", "domain"))).alias("b"))
    return stats.join(names, "seed").select(*stats.columns, F.array_join(F.transform("b", lambda x: x["domain"]), ",").alias("best"))


@register("excerpt_search", ops=("C6", "I7", "H18"))
def q_excerpt_search(spark, sf_dir):
    """Excerpts of the seed documents (ids divisible by 50) against those of all stored texts over 50 characters."""
    ensure_checkpoint_dir(spark)
    d = Tables(spark, sf_dir).documents.select(M.dom("doc_id").alias("domain"), "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    e = encoded(d.filter(F.length("text") > 50).select("domain", "doc_id", excerpt("text", 400).alias("text")))
    e = e.select("domain", "doc_id", unit("embedding").alias("u")).checkpoint()
    seeds = e.filter(F.col("doc_id") % SEED_EVERY == 0)
    _, best = search(seeds, e, SIM_CFG, seeds.count(), e.count(), k=10)
    return best.filter(F.col("score") >= min(SIM_CFG.sim_threshold, 0.35))


@register("document_encoder", ops=("I7",))
def q_document_encoder(spark, sf_dir):
    """Whole texts through the plugged-in encoder: dimension and squared length of each vector."""
    d = Tables(spark, sf_dir).documents.select("doc_id", "text")
    return encoded(d).select("doc_id", F.size("embedding").alias("dim"),
                             F.round(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x * x), 4).alias("norm2"))


@register("roc_curve", ops=("D24", "D26"), sql=LOG_SQL + """,
g as (select score, sum(label) as pos, sum(1 - label) as neg from log group by score),
t as (select sum(pos) as P, sum(neg) as N from g)
select score, cast(pos as bigint) as pos, cast(neg as bigint) as neg, cast(sum(pos) over w as bigint) as cum_pos, cast(sum(neg) over w as bigint) as cum_neg,
  round(sum(pos) over w / P, 4) as tpr, round(sum(neg) over w / N, 4) as fpr
from g, t window w as (order by score desc rows unbounded preceding)
""")
def q_roc_curve(spark, sf_dir):
    r = roc_points(eval_log(spark, sf_dir))
    return r.select("score", "pos", "neg", "cum_pos", "cum_neg", F.round(F.col("cum_pos") / F.col("P"), 4).alias("tpr"),
                    F.round(F.col("cum_neg") / F.col("N"), 4).alias("fpr"))
