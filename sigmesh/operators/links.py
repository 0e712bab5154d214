"""Link-network signal (C11, C12, D6, D7, G4) and hyperlink edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Settings
from ..session import stored
from .skew import one_row_join


def clean_links(col, k: int = 15):
    """Bar-joined links: split, trim, keep those with a dot and > 4 chars,
    first ``k`` (H7).  Returns an array column."""
    c = F.col(col) if isinstance(col, str) else col
    parts = F.transform(F.split(F.coalesce(c, F.lit("")), r"\|"), lambda x: F.trim(x))
    keep = F.filter(parts, lambda x: (F.length(x) > 4) & (F.locate(".", x) > 0))
    return F.slice(keep, 1, k)


def _links_in_set(links: DataFrame, analysed: DataFrame) -> DataFrame:
    """Distinct links (src != dst) with set membership of both ends.

    The set side holds one row per domain; a hot ``dst`` or ``src`` on the
    link side is split by AQE's skew join (both inputs are shuffle stages),
    and a small set is broadcast by AQE's size check."""
    s = analysed.select("domain").distinct()
    l = links.select("src", "dst").filter(F.col("src") != F.col("dst")).distinct()
    return (l.join(s.select(F.col("domain").alias("dst"), F.lit(True).alias("dst_in")), "dst", "left")
             .join(s.select(F.col("domain").alias("src"), F.lit(True).alias("src_in")), "src", "left"))


def _mutual_from(l2: DataFrame) -> DataFrame:
    # a pair is mutual when both directions exist: one aggregation on the
    # unordered pair key, no self-join (links are distinct, so count == 2)
    both = l2.filter(F.col("src_in") & F.col("dst_in"))
    return (both.groupBy(F.least("src", "dst").alias("domain_a"), F.greatest("src", "dst").alias("domain_b"))
            .agg(F.count(F.lit(1)).alias("dirs")).filter(F.col("dirs") == 2).drop("dirs"))


def mutual_links(links: DataFrame, analysed: DataFrame) -> DataFrame:
    """Undirected pairs (domain_a < domain_b) linking both ways, both in the
    analysed set (C11).  Grouping on the unordered pair key has no hot key:
    each key holds at most two rows."""
    return _mutual_from(_links_in_set(links, analysed))


def link_signal(links: DataFrame, analysed: DataFrame, cfg: Settings) -> DataFrame:
    """Per analysed domain: n_links, in_set_links, insular_score,
    mutual_link_count, link_network_flagged (D6, D7, G4).  Both branches read
    the distinct links stored once; their shuffles end with that."""
    s = analysed.select("domain").distinct()
    l2 = stored(_links_in_set(links, s))
    per_src = (l2.groupBy(F.col("src").alias("domain"))
               .agg(F.count(F.lit(1)).alias("n_links"),
                    F.sum(F.coalesce(F.col("dst_in"), F.lit(False)).cast("int")).alias("in_set_links")))
    mutual = _mutual_from(l2)
    mcount = (mutual.select(F.explode(F.array("domain_a", "domain_b")).alias("domain"))
              .groupBy("domain").agg(F.count(F.lit(1)).alias("mutual_link_count")))
    set_size = s.agg(F.count(F.lit(1)).alias("set_size"))
    j = one_row_join(s.join(per_src, "domain", "left").join(mcount, "domain", "left"), set_size)
    n = F.coalesce(F.col("n_links"), F.lit(0))
    score = F.when(n >= cfg.min_links_insular, F.coalesce(F.col("in_set_links"), F.lit(0)) / F.greatest(n, F.lit(1))) \
             .otherwise(F.lit(0.0))
    insular = (score >= cfg.insular_threshold) & (n >= cfg.min_links_insular) & \
        (F.col("set_size") >= cfg.min_domains_insular)
    mc = F.coalesce(F.col("mutual_link_count"), F.lit(0))
    return j.select(
        "domain",
        n.cast("int").alias("n_links"),
        F.coalesce(F.col("in_set_links"), F.lit(0)).cast("int").alias("in_set_links"),
        F.round(score, 4).alias("insular_score"),
        mc.cast("int").alias("mutual_link_count"),
        ((mc > 0) | insular).cast("int").alias("link_network_flagged"),
    )


def link_edges(pages: DataFrame, nodes: DataFrame, per_domain: int = 5) -> DataFrame:
    """Hyperlink edges for the graph (A16): first ``per_domain`` cleaned links
    of each page, both ends must be nodes, de-duplicated."""
    first = pages.select("domain", F.posexplode(F.slice(clean_links("links"), 1, per_domain))
                         .alias("pos", "target"))
    n = nodes.select("domain").distinct()
    return (first.join(n, "domain", "left_semi")
            .join(n.withColumnRenamed("domain", "target"), "target", "left_semi")
            .select(F.col("domain").alias("src"), F.col("target").alias("dst")).distinct())
