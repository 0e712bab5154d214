"""Graph tables and queries.

Nodes and typed edges are plain tables.  Pair edges (similarity, mutual
links) are stored once with ``domain_a < domain_b``; group edges (shared
host, shared author) are stored as memberships, never expanded into pairs.
Upserts are last-write-wins by ``updated_at`` through ``max_by`` — a partial
aggregation, not a window — so a re-written hot node is still reduced
map-side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import RECENT_NONE, RECENT_REASONS, STORED_NONE, STORED_REASONS
from ..session import stored
from .neighbours import VectorEdges, neighbour_sums, summed
from .skew import top_k_per_key

NODE_CUTS = {"registrar": 80, "hosting_org": 100, "shared_authors": 200, "explanation": 400}


def _last_write(df: DataFrame, keys: list[str], ts: str = "updated_at") -> DataFrame:
    cols = [c for c in df.columns if c not in keys]
    order = F.struct(F.col(ts), F.to_json(F.struct(*cols)))  # equal stamps: the larger row
    return (df.groupBy(*keys).agg(F.max_by(F.struct(*cols), order).alias("r"))
              .select(*keys, "r.*"))


def upsert_nodes(current: DataFrame | None, updates: DataFrame, run_ts: str) -> DataFrame:
    """MERGE by domain (A11): string cuts, update stamp, newest row wins."""
    u = updates
    for c, n in NODE_CUTS.items():
        if c in u.columns:
            u = u.withColumn(c, F.substring(F.col(c), 1, n))
    u = u.withColumn("updated_at", F.to_timestamp(F.lit(run_ts)))
    allr = u if current is None else current.unionByName(u, allowMissingColumns=True)
    return _last_write(allr, ["domain"])


def upsert_edges(current: DataFrame | None, edges: DataFrame, nodes: DataFrame, kind: str,
                 run_ts: str) -> DataFrame:
    """Edges whose two endpoints exist (C14), keyed (a, b, kind), newest wins
    (A12-A14)."""
    n = nodes.select("domain").distinct()
    e = (edges.join(n.withColumnRenamed("domain", "domain_a"), "domain_a", "left_semi")
              .join(n.withColumnRenamed("domain", "domain_b"), "domain_b", "left_semi")
              .withColumn("kind", F.lit(kind)).withColumn("updated_at", F.to_timestamp(F.lit(run_ts))))
    allr = e if current is None else current.unionByName(e, allowMissingColumns=True)
    return _last_write(allr, ["domain_a", "domain_b", "kind"])


def undirected(edges: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Both directions of each pair edge as (src, dst, ...)."""
    ways = F.inline(F.array(F.struct(F.col("domain_a").alias("src"), F.col("domain_b").alias("dst")),
                            F.struct(F.col("domain_b").alias("src"), F.col("domain_a").alias("dst"))))
    return edges.select(ways, *(cols or []))  # edges are made by tiles: one reader runs them once


def degrees(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Undirected degree per node, 0 for isolated nodes."""
    d = undirected(edges.select("domain_a", "domain_b").distinct()).groupBy("src").agg(
        F.count(F.lit(1)).alias("degree"))
    return nodes.select("domain").join(d.withColumnRenamed("src", "domain"), "domain", "left") \
        .select("domain", F.coalesce("degree", F.lit(0)).cast("long").alias("degree"))


def graph_stats(nodes: DataFrame, edges: DataFrame, verdict: str = "verdict") -> DataFrame:
    """Counts of nodes, edges by kind and nodes by verdict."""
    n = nodes.agg(F.count(F.lit(1)).alias("nodes"),
                  F.sum((F.col(verdict) == "SYNTHETIC").cast("long")).alias("synthetic"),
                  F.sum((F.col(verdict) == "REVIEW").cast("long")).alias("review"),
                  F.sum((F.col(verdict) == "ORGANIC").cast("long")).alias("organic"))
    e = edges.groupBy().pivot("kind", ["SIMILAR_TO", "LINKS_TO"]).agg(F.count(F.lit(1)))
    from .skew import one_row_join
    return one_row_join(n, e.select(F.coalesce(F.col("SIMILAR_TO"), F.lit(0)).cast("long").alias("similar_edges"),
                                    F.coalesce(F.col("LINKS_TO"), F.lit(0)).cast("long").alias("link_edges")))


def neighborhood(edges: DataFrame, nodes: DataFrame, focus: DataFrame, limit: int = 50) -> DataFrame:
    """1-hop neighbourhood over SIMILAR_TO edges of each focus domain (C16, F5):
    an optional match, so a domain without neighbours keeps one row of nulls;
    similarity to 4 decimals, 0 where it is missing; missing verdicts count as
    ORGANIC and missing signals as 0; at most ``limit`` neighbours per focus.
    nodes: domain, verdict, signals, excerpt."""
    u = undirected(edges.filter("kind = 'SIMILAR_TO'"), ["similarity"])
    seeds = focus.select(F.col("domain").alias("src")).join(nodes.select(F.col("domain").alias("src")), "src", "left_semi").distinct()
    j = u.join(seeds, "src", "left_semi").withColumn("similarity", F.round(F.coalesce("similarity", F.lit(0.0)), 4))
    ranked = top_k_per_key(j, "src", [F.desc("similarity"), F.asc("dst")], limit, ["dst"])
    of = nodes.select(F.col("domain").alias("dst"), F.coalesce("verdict", F.lit("ORGANIC")).alias("neighbor_verdict"),
                      F.coalesce("signals", F.lit(0)).cast("int").alias("neighbor_signals"), F.col("excerpt").alias("neighbor_excerpt"))
    near = ranked.join(of, "dst")
    alone = seeds.join(near.select("src"), "src", "left_anti")
    return (near.unionByName(alone, allowMissingColumns=True)
            .select(F.col("src").alias("domain"), F.col("dst").alias("neighbor"), "similarity", "neighbor_verdict", "neighbor_signals",
                    "neighbor_excerpt", F.col("rank").cast("int").alias("rank")))


def domain_cards(nodes: DataFrame, edges: DataFrame | VectorEdges, k: int = 8) -> DataFrame:
    """Each node with its first ``k`` related domains by name and the distinct
    count (C17); the top-k is two-stage and bounded, the count is a partial
    aggregation. Of ``VectorEdges`` each tile gives a domain's count and its first ``k``."""
    if isinstance(edges, VectorEdges):
        found = stored(neighbour_sums(edges, None, 1, k))
        sums = summed(found, 1).withColumn("own", F.coalesce("own", F.lit(False)))
        cnt = sums.select(F.col("domain").alias("src"), (F.get("x", F.lit(0)) + F.col("own").cast("int")).alias("related_count"))
        u = (found.filter("other IS NOT NULL").select(F.col("domain").alias("src"), F.col("other").alias("dst"))
             .unionByName(sums.filter("own").select(F.col("domain").alias("src"), F.col("domain").alias("dst"))))
    else:
        u = undirected(edges.select("domain_a", "domain_b")).distinct()
        cnt = u.groupBy("src").agg(F.count(F.lit(1)).alias("related_count"))
    first = (top_k_per_key(u, "src", [F.asc("dst")], k, ["dst"])
             .groupBy("src").agg(F.array_sort(F.collect_list(F.struct("rank", "dst"))).alias("a"))
             .select("src", F.transform("a", lambda x: x["dst"]).alias("related")))
    return (nodes.select("domain").join(cnt.withColumnRenamed("src", "domain"), "domain", "left")
            .join(first.withColumnRenamed("src", "domain"), "domain", "left")
            .select("domain", F.coalesce("related_count", F.lit(0)).cast("long").alias("related_count"),
                    F.concat_ws(",", F.coalesce("related", F.array().cast("array<string>"))).alias("related")))


def neighbor_mean(nodes: DataFrame, edges: DataFrame | VectorEdges, feats: list[str]) -> DataFrame:
    """Mean of source features per target over undirected edges plus self
    loops (I1): sum / in-degree (>= 1 with the self loop). Of ``VectorEdges``
    tiles give sums and numbers of the features, and no pair moves."""
    if isinstance(edges, VectorEdges):
        size = 2 * len(feats) + 1
        per = [f for c in feats for f in (F.coalesce(F.sum(F.col(c).cast("double")), F.lit(0.0)), F.count(c).cast("double"))]
        values = stored(nodes.filter("domain IS NOT NULL").groupBy("domain").agg(F.array(*per, F.count(F.lit(1)).cast("double")).alias("x")))
        sums = summed(neighbour_sums(edges, values, size), size)
        j = sums.join(values.withColumnRenamed("x", "me"), "domain", "full")
        # a self loop for each row of a node; an edge to itself counts in both directions
        loops = F.coalesce(F.get("me", F.lit(size - 1)), F.lit(0.0)) + F.when(F.coalesce("own", F.lit(False)), 2.0).otherwise(0.0)
        of = lambda i: F.coalesce(F.get("x", F.lit(i)), F.lit(0.0)) + loops * F.coalesce(F.get("me", F.lit(i)), F.lit(0.0))
        return j.filter(of(size - 1) > 0).select("domain", *[F.when(of(2 * i + 1) > 0, of(2 * i) / of(2 * i + 1)).alias(f"nm_{c}") for i, c in enumerate(feats)])
    pairs = undirected(edges.select("domain_a", "domain_b").distinct())
    selfl = nodes.select(F.col("domain").alias("src"), F.col("domain").alias("dst"))
    e = pairs.unionByName(selfl)
    x = e.join(nodes.select(F.col("domain").alias("src"), *feats), "src")
    return x.groupBy(F.col("dst").alias("domain")).agg(*[F.avg(c).alias(f"nm_{c}") for c in feats])


def recently_detected(nodes: DataFrame, n: int) -> DataFrame:
    """SYNTHETIC/REVIEW nodes, newest first, limit clamped to 1..50."""
    k = max(1, min(int(n), 50))
    return (nodes.filter(F.col("verdict").isin("SYNTHETIC", "REVIEW"))
            .orderBy(F.desc("updated_at"), F.desc("confidence"), F.asc("domain")).limit(k))


def graph_sample(nodes: DataFrame, edges: DataFrame, n_nodes: int = 200, n_edges: int = 300):
    """Stable sample for display (F7): first nodes and edges by key."""
    return (nodes.orderBy("domain").limit(n_nodes),
            edges.orderBy("domain_a", "domain_b").limit(n_edges))


def cached_reasons() -> Column:
    """Stored-node summary (B19): reasons joined by ". ", with a fallback."""
    r = F.array_compact(F.array(
        F.when(F.col("max_similarity") >= 0.82, F.lit(STORED_REASONS[0])),
        F.when(F.col("domain_age_days").between(0, 90), F.lit(STORED_REASONS[1])),
        F.when(F.col("burst_score") >= 0.6, F.lit(STORED_REASONS[2])),
        F.when(F.col("related_count") > 0,
               F.format_string(STORED_REASONS[3], F.col("related_count")))))
    return F.concat(F.when(F.size(r) > 0, F.array_join(r, ". ")).otherwise(F.lit(STORED_NONE)), F.lit("."))


def recent_reasons() -> Column:
    """Recent-feed reason (B20): bits joined by ", ", with a fallback."""
    r = F.array_compact(F.array(
        F.when(F.col("max_similarity") >= 0.82, F.lit(RECENT_REASONS[0])),
        F.when(F.col("signals_triggered") >= 2, F.lit(RECENT_REASONS[1])),
        F.when(F.col("domain_age_days").between(0, 90), F.lit(RECENT_REASONS[2]))))
    return F.when(F.size(r) > 0, F.array_join(r, ", ")).otherwise(F.lit(RECENT_NONE))
