"""Similarity queries on ``embeddings`` (+ ``documents`` text, bylines)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.search import search
from ..operators.simjoin import pinned, pruned_products
from ..operators.similarity import (average_similarity_linear, classify_pairs, lsh_pairs, prepare_vectors, similarity_pairs,
                                    similarity_scores_of)
from ..session import stored
from ..sources.tables import Tables
from . import mapping as M
from . import sql_mapping as S
from .q_signals import CFG as BASE_CFG
from .registry import register

# The mapped vectors are nearly orthogonal (one pair >= .5 at sf0.01), so the
# similarity threshold for the mapped data is a setting of .30.
SIM_CFG = BASE_CFG.with_(sim_threshold=0.30, sim_edge_threshold=0.30)


def similarity_products(spark, sf_dir, cfg=SIM_CFG):
    t = Tables(spark, sf_dir)
    vecs = M.vectors(t)
    prep = pinned(prepare_vectors(vecs, cfg))
    return t, vecs, prep, pruned_products(prep, cfg, prep.count())


def _sql_pairs(t: float) -> str:
    return f"""
with v as ({S.VECTORS}),
a as (select domain, parent, cast(embedding as double[]) as e, {S.sql_syndicated('text')} as synd,
             {S.sql_authority('domain')} as auth, text from v),
p as (select x.domain as d, y.domain as o, list_cosine_similarity(x.e, y.e) as raw,
             x.auth as ax, y.auth as ay, (x.synd or y.synd) as syn
      from a x join a y on x.domain <> y.domain and x.parent <> y.parent),
e as (select d, o, raw, ax, ay, syn,
             case when syn then 0.0 when ax and ay then raw * 0.5 when ax or ay then raw * 0.75 else raw end as eff,
             case when ax and ay then {t} * 1.5 when ax or ay then {t} * 1.2 else {t} end as thr
      from p)
"""


SCORES_SQL = _sql_pairs(SIM_CFG.sim_threshold) + f"""
, g as (select d, favg(eff) as av, max(eff) as mx, sum(case when eff >= thr then 1 else 0 end) as k
        from e group by d)
select a.domain, round(coalesce(av, 0.0), 4) + 0.0 as avg_similarity, round(coalesce(mx, 0.0), 4) + 0.0 as max_similarity,
       cast(coalesce(mx, 0.0) >= {SIM_CFG.sim_threshold} as integer) as similarity_flag,
       cast(coalesce(k, 0) as integer) as similar_domain_count
from a left join g on a.domain = g.d
"""


@register("similarity_scores", sql=SCORES_SQL, ops=("C3", "C4", "D3", "B7", "B8", "B22", "H5", "H15", "H16"))
def q_similarity_scores(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return similarity_scores_of(M.vectors(t), SIM_CFG, t.embeddings.count())


PAIRS_SQL = _sql_pairs(SIM_CFG.sim_threshold) + """
select least(d, o) as domain_a, greatest(d, o) as domain_b, round(raw, 4) + 0.0 as score, round(eff, 4) + 0.0 as effective
from e where d < o and eff >= thr
"""


@register("similarity_pairs_exact", sql=PAIRS_SQL, ops=("C3", "C4", "B22", "H14", "F1"))
def q_similarity_pairs_exact(spark, sf_dir):
    t, vecs, prep, products = similarity_products(spark, sf_dir)
    p = similarity_pairs(products)
    return p.select("domain_a", "domain_b", F.round("raw", 4).alias("score"), F.round("eff", 4).alias("effective"))


def _nav_sql(col: str) -> list[str]:
    from ..config import NAV_PHRASES
    low = f"substr(lower(substr(coalesce({col}, ''), 1, 1000)), 1, 600)"
    return [f"contains({low}, {S.q(p)})" for p in NAV_PHRASES]


EDGES_SQL = _sql_pairs(SIM_CFG.sim_threshold) + f"""
, b as (select distinct domain, {S.sql_strip('lower(author)')} as an from ({S.BYLINES}) x
        where length({S.sql_strip('lower(author)')}) > 0),
h as (select distinct domain from b),
pe as (select least(d, o) as domain_a, greatest(d, o) as domain_b, raw, eff, ax, ay, syn
       from e where d < o and eff >= thr),
ov as (select distinct pe.domain_a, pe.domain_b from pe join b b1 on b1.domain = pe.domain_a
       join b b2 on b2.domain = pe.domain_b and b2.an = b1.an),
x as (select pe.*, ta.text as text_a, tb.text as text_b,
             case when ha.domain is not null and hb.domain is not null then ov.domain_a is not null end as overlap
      from pe join a ta on ta.domain = pe.domain_a join a tb on tb.domain = pe.domain_b
      left join h ha on ha.domain = pe.domain_a left join h hb on hb.domain = pe.domain_b
      left join ov on ov.domain_a = pe.domain_a and ov.domain_b = pe.domain_b),
y as (select *, ({' + '.join(f'cast(({pa}) and ({pb}) as integer)' for pa, pb in zip(_nav_sql('text_a'), _nav_sql('text_b')))}) as nav
      from x)
select domain_a, domain_b, round(raw, 4) + 0.0 as score, round(eff, 4) + 0.0 as effective,
  (ax or ay) as authority_discounted, syn as syndicated,
  case when syn then 'shared_journalistic'
       when raw >= 0.90 and coalesce(overlap, false) then 'structural_clone'
       when raw >= 0.75 and overlap = false then 'shared_journalistic'
       when raw >= 0.80 and nav >= 5 then 'structural_clone'
       when raw >= 0.65 then 'shared_journalistic'
       else 'topic_overlap' end as similarity_type
from y
"""


@register("similarity_edges", sql=EDGES_SQL, ops=("C4", "B21", "B22", "G5", "H20"))
def q_similarity_edges(spark, sf_dir):
    t, vecs, prep, products = similarity_products(spark, sf_dir)
    return classify_pairs(stored(similarity_pairs(products)), vecs, M.bylines(t), SIM_CFG)


@register("similarity_avg_linear", ops=("D4", "H15", "H16"), sql=f"""
with v as ({S.VECTORS}), a as (select domain, cast(embedding as double[]) as e from v),
n as (select count(*) as n from a)
select x.domain, round(sum(case when x.domain <> y.domain then list_cosine_similarity(x.e, y.e) else 0 end)
                        / greatest(max(n.n) - 1, 1), 6) + 0.0 as avg_cosine
from a x, a y, n group by x.domain
""")
def q_similarity_avg_linear(spark, sf_dir):
    prep = prepare_vectors(M.vectors(Tables(spark, sf_dir)), SIM_CFG)
    return average_similarity_linear(prep).select("domain", F.round("avg_cosine", 6).alias("avg_cosine"))


@register("similarity_pairs_lsh", ops=("C3",))
def q_similarity_pairs_lsh(spark, sf_dir):
    prep = prepare_vectors(M.vectors(Tables(spark, sf_dir)), SIM_CFG)
    return lsh_pairs(prep, SIM_CFG.sim_threshold).select("domain_a", "domain_b", F.round("raw", 4).alias("score"))


@register("seed_vs_corpus", ops=("C5", "B6"), sql=f"""
with v as ({S.VECTORS}),
a as (select domain, parent, cast(embedding as double[]) as e, {S.sql_authority('domain')} as auth from v),
s as (select * from a where cast(substr(domain, 2) as bigint) % 50 = 0),
p as (select s.domain as seed, list_cosine_similarity(s.e, c.e) as raw, s.auth as sa, c.auth as ca
      from s join a c on c.domain <> s.domain)
select seed, round(favg(raw), 4) + 0.0 as avg_similarity, round(max(raw), 4) + 0.0 as max_similarity,
  cast(max(raw) >= {SIM_CFG.sim_threshold} as integer) as similarity_flag,
  cast(sum(case when (case when sa and ca then raw * 0.5 when sa or ca then raw * 0.75 else raw end)
                 >= (case when sa and ca then {SIM_CFG.sim_threshold} * 1.5 when sa or ca
                          then {SIM_CFG.sim_threshold} * 1.2 else {SIM_CFG.sim_threshold} end)
           then 1 else 0 end) as integer) as similar_domain_count
from p group by seed
""")
def q_seed_vs_corpus(spark, sf_dir):
    """Every row whose id is divisible by 50 against all rows."""
    prep = pinned(prepare_vectors(M.vectors(Tables(spark, sf_dir)), SIM_CFG))
    seeds = prep.filter(F.substring("domain", 2, 20).cast("long") % 50 == 0)
    return search(seeds, prep, SIM_CFG, seeds.count(), prep.count())[0]
