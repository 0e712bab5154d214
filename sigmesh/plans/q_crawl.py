"""The crawl queue over mapped pages and links."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.iterative import crawl_frontier
from ..operators.skew import top_k_per_key
from ..sources.tables import Tables
from . import mapping as M
from .registry import register

#: Every supplier whose key this divides is a seed.
SEED_EVERY = 50
DEPTH = 3


def crawl_inputs(t: Tables):
    """Pages: suppliers d<key> and parts d<key> without one; suppliers of two nations redirect to the next key,
    debts leave too little text; parts over a size are reachable. Links: a supplier's parts in the order of its lines."""
    supplier = t.supplier.select(F.col("s_suppkey").alias("k"), (F.col("s_acctbal") >= 0).alias("ok"),
                                 F.when(F.col("s_nationkey").isin(3, 4), M.dom(F.col("s_suppkey") + 1)).alias("final_domain"))
    part = (t.part.select(F.col("p_partkey").alias("k"), (F.col("p_size") > 10).alias("ok"), F.lit(None).cast("string").alias("final_domain"))
            .join(supplier.select("k"), "k", "left_anti"))
    pages = supplier.unionByName(part).select(M.dom("k").alias("domain"), "ok", "final_domain")
    first = (t.lineitem.filter("l_suppkey <> l_partkey").groupBy(M.dom("l_suppkey").alias("src"), M.dom("l_partkey").alias("dst"))
             .agg(F.min(F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("at")))
    links = top_k_per_key(first, "src", [F.asc("at"), F.asc("dst")], 5, ["dst"]).select("src", F.col("rank").alias("place"), "dst")
    seeds = supplier.filter(F.col("k") % SEED_EVERY == 0).select(M.dom("k").alias("domain"), F.col("k").alias("place"))
    return seeds, pages, links


def _level(k: int) -> str:
    """One level of the queue in SQL: q<k> from the levels before it (s<k-1>)."""
    return f"""
c{k} as (select l.dst, q.place as by_place, l.place as link from q{k - 1} q join lk l on l.src = q.domain
         where q.status = 'result' and l.dst not in (select domain from s{k - 1})),
o{k} as (select dst, min(by_place * 10 + link) as o from c{k} group by dst),
r{k} as (select redirects_to, min(place) as since from s{k - 1} where redirects_to is not null group by redirects_to),
n{k} as (select dst as domain, row_number() over (order by o) - 1 + (select count(*) from s{k - 1}) as place
         from o{k} left join r{k} on dst = redirects_to where since is null or since > o // 10),
q{k} as (select n.domain, {k} as depth, n.place, case when coalesce(p.ok, false) then 'result' else 'failed' end as status, p.redirects_to
         from n{k} n left join pg p on n.domain = p.domain),
s{k} as (select * from s{k - 1} union all select * from q{k})"""


def crawl_sql(depth: int, columns: str) -> str:
    return f"""
with sp as (select s_suppkey as k, s_acctbal >= 0 as ok, case when s_nationkey in (3, 4) then 'd' || cast(s_suppkey + 1 as varchar) end as redirects_to from supplier),
pg as (select 'd' || cast(k as varchar) as domain, ok, redirects_to from sp union all
       select 'd' || cast(p_partkey as varchar), p_size > 10, null from part where p_partkey not in (select k from sp)),
f as (select 'd' || cast(l_suppkey as varchar) as src, 'd' || cast(l_partkey as varchar) as dst, min(l_orderkey * 10 + l_linenumber) as first_at
      from lineitem where l_suppkey <> l_partkey group by 1, 2),
lk as (select * from (select *, row_number() over (partition by src order by first_at, dst) as place from f) x where place <= 5),
q0 as (select 'd' || cast(k as varchar) as domain, 0 as depth, row_number() over (order by k) - 1 as place,
              case when ok then 'result' else 'failed' end as status, redirects_to from sp where k % {SEED_EVERY} = 0),
s0 as (select * from q0),{','.join(_level(k) for k in range(1, depth + 1))}
select {columns} from s{depth}"""


@register("crawl_queue", ops=("G3", "G6"), sql=crawl_sql(
    DEPTH, "domain, cast(depth as integer) as depth, cast(place as bigint) as place, status, redirects_to"))
def q_crawl_queue(spark, sf_dir):
    """From every fiftieth supplier: pages in queue order, those that failed, and redirects."""
    seeds, pages, links = crawl_inputs(Tables(spark, sf_dir))
    return crawl_frontier(seeds, pages, links, depth=DEPTH)
