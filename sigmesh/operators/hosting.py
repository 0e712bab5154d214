"""Shared-hosting signal.

The source builds every pair of domains on one IP or ASN.  A CDN address can
hold a third of all domains, so pairs are never materialised here: a domain
is flagged when its group (IP, non-CDN ASN, or for CDN domains the
(IP|ASN, creation day, registrar) group) has another live member.  Group
sizes come from partial aggregation and a salted join back to the rows.
Edges are emitted as group memberships ("hyperedges"); the pair count of a
group is n·(n−1)/2 and is reported, not expanded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import CDN_ASNS
from ..functions.domains import is_cdn, org_asn, org_name
from .skew import group_sizes, reuse, salted_join


def hosting_records_from_org(df: DataFrame, org_line: str = "org_line") -> DataFrame:
    """Split ``"AS13335 Cloudflare, Inc."`` into asn + org and add ``is_cdn``."""
    return (df.withColumn("asn", F.coalesce(F.nullif(F.col("asn"), F.lit("")), org_asn(org_line)))
              .withColumn("hosting_org", org_name(org_line))
              .withColumn("is_cdn", is_cdn("ip_address", "asn", "hosting_org")))


def _live_with_keys(hosting: DataFrame, registration: DataFrame | None) -> DataFrame:
    live = hosting.filter(F.col("status") == "ok")
    if registration is not None:
        reg = registration.select("domain", F.to_date("created_date").alias("created_day"),
                                  F.lower(F.trim("registrar")).alias("reg_norm"))
        live = live.join(reg, "domain", "left")
    else:
        live = live.withColumn("created_day", F.lit(None).cast("date")) \
                   .withColumn("reg_norm", F.lit(None).cast("string"))
    known = F.col("created_day").isNotNull() & F.col("reg_norm").isNotNull() & \
        (F.col("reg_norm") != "") & (F.col("reg_norm") != "unknown")
    asn_ok = (F.col("asn").isNotNull()) & (F.col("asn") != "") & ~F.col("asn").isin(*CDN_ASNS)
    ip_ok = F.col("ip_address").isNotNull() & (F.col("ip_address") != "")
    return live.select(
        "domain", "ip_address", "asn", "hosting_org", "is_cdn",
        F.when(ip_ok, F.col("ip_address")).alias("k_ip"),
        F.when(asn_ok, F.col("asn")).alias("k_asn"),
        F.when(ip_ok & known, F.concat_ws("|", "ip_address", F.col("created_day").cast("string"), "reg_norm"))
         .alias("k_ip_gate"),
        F.when(asn_ok & known, F.concat_ws("|", "asn", F.col("created_day").cast("string"), "reg_norm"))
         .alias("k_asn_gate"),
    )


def hosting_signal(domains: DataFrame, hosting: DataFrame,
                   registration: DataFrame | None = None) -> DataFrame:
    """Per domain: ip, asn, org, is_cdn, shared_ip_count, shared_asn_count,
    hosting_flagged.

    Non-CDN domain: flagged when another live domain has its IP or its
    (non-CDN) ASN.  CDN domain: flagged only when such a domain was also
    created the same day through the same registrar (C9).  Fewer than two live
    rows means no group can have two members, so all flags are 0 (B35).
    """
    live = reuse(_live_with_keys(hosting, registration))
    # one stacked pass for the four group kinds: (kind, key) memberships ->
    # one partial aggregation -> one skew-safe join back -> pivot per domain
    kinds = (("ip", "k_ip"), ("asn", "k_asn"), ("ip_gate", "k_ip_gate"), ("asn_gate", "k_asn_gate"))
    memb = live.select("domain", F.explode(F.array(*[
        F.struct(F.lit(k).alias("kind"), F.col(c).alias("key")) for k, c in kinds])).alias("m")) \
        .select("domain", "m.kind", "m.key").filter(F.col("key").isNotNull())
    sizes = group_sizes(memb.select("kind", "key"), ["kind", "key"], "n")
    sized = salted_join(memb, sizes, ["kind", "key"], "inner", ["domain"], size_col="n")
    per_dom = sized.groupBy("domain").agg(*[F.max(F.when(F.col("kind") == k, F.col("n"))).alias(f"n_{k}")
                                            for k, _ in kinds])
    out = live.join(per_dom, "domain", "left")
    others = lambda c: F.greatest(F.coalesce(F.col(c), F.lit(1)) - 1, F.lit(0))
    cdn = F.coalesce(F.col("is_cdn"), F.lit(False))
    flagged = F.when(cdn, (others("n_ip_gate") + others("n_asn_gate")) > 0) \
               .otherwise((others("n_ip") + others("n_asn")) > 0)
    scored = out.select(
        "domain", "ip_address", "asn", "hosting_org", cdn.alias("is_cdn"),
        others("n_ip").cast("int").alias("shared_ip_count"),
        others("n_asn").cast("int").alias("shared_asn_count"),
        flagged.cast("int").alias("hosting_flagged"),
        "k_ip", "k_asn", "k_ip_gate", "k_asn_gate",
    )
    return domains.select("domain").join(scored, "domain", "left")


def host_memberships(scored: DataFrame) -> DataFrame:
    """Hosting edges as group memberships (domain, edge_type, group_key) for
    flagged domains. A domain may stand in a group of each kind; where pairs are
    counted, SAME_IP takes precedence (``host_pair_counts``)."""
    cdn = F.col("is_cdn")
    ip_key = F.when(cdn, F.col("k_ip_gate")).otherwise(F.col("k_ip"))
    asn_key = F.when(cdn, F.col("k_asn_gate")).otherwise(F.col("k_asn"))
    flagged = scored.filter(F.col("hosting_flagged") == 1)
    ip_m = flagged.select("domain", F.lit("SAME_IP").alias("edge_type"), ip_key.alias("group_key"))
    asn_m = flagged.select("domain", F.lit("SAME_ASN").alias("edge_type"), asn_key.alias("group_key"))
    m = ip_m.unionByName(asn_m).filter(F.col("group_key").isNotNull())
    sizes = group_sizes(m, ["edge_type", "group_key"], "members")
    return salted_join(m, sizes, ["edge_type", "group_key"], "inner", ["domain"], size_col="members") \
        .filter(F.col("members") > 1)


def host_pair_counts(memberships: DataFrame) -> DataFrame:
    """Number of undirected pairs each group implies: n·(n−1)/2. A pair that
    shares both an address and a network counts as SAME_IP alone (C10): what
    the address groups inside a network hold is taken from its pairs."""
    def pairs(n):
        return (F.col(n) * (F.col(n) - 1) / 2).cast("long")
    groups = memberships.groupBy("edge_type", "group_key").agg(F.count(F.lit(1)).alias("n"))
    by_domain = memberships.groupBy("domain").agg(*[F.max(F.when(F.col("edge_type") == k, F.col("group_key"))).alias(c)
                                                    for k, c in (("SAME_IP", "ip"), ("SAME_ASN", "asn"))])
    inside = (by_domain.filter("ip IS NOT NULL AND asn IS NOT NULL").groupBy("asn", "ip").agg(F.count(F.lit(1)).alias("k"))
              .groupBy(F.col("asn").alias("group_key")).agg(F.sum(pairs("k")).alias("taken")).withColumn("edge_type", F.lit("SAME_ASN")))
    return (groups.join(inside, ["edge_type", "group_key"], "left")
            .select("edge_type", "group_key", "n", (pairs("n") - F.coalesce("taken", F.lit(0))).alias("pairs")))
