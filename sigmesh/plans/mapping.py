"""Mapping of the driver tables onto the detection inputs.

No web data exists offline, so each input the detector needs is derived from
a driver table (all keys become domain names ``d<key>``).  Every mapping is a
whole-table projection or aggregation — nothing is sampled or capped — so the
work grows with the scale factor.

| input              | driver table and rule                                              |
|--------------------|--------------------------------------------------------------------|
| publication times  | events: domain = d<user_id>, ts                                    |
| analysed domains   | customer: d<c_custkey>                                             |
| registration       | customer ⋈ orders: registrar = c_mktsegment, created = first order |
| hosting            | customer ⋈ nation: ip from nation and balance band, asn from nation|
| outlinks           | lineitem: d<l_suppkey> -> d<l_partkey>, distinct                   |
| archive snapshots  | orders: d<o_custkey>, snapshot time = o_orderdate                  |
| bylines            | lineitem ⋈ part: d<l_suppkey>, "<p_name> <p_brand> <p_size>"        |
| embeddings / text  | embeddings ⋈ documents: d<vec_id>, parent site = label             |
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import Tables

# Fixed clock for the mapped data: one month after the last order date.
MAPPED_AS_OF = "2001-09-01 00:00:00"
# Nations whose hosting is a CDN (Cloudflare and Amazon style records).
CDN_NATIONS = {0: ("AS13335", "Cloudflare, Inc.", "104.16"), 1: ("AS16509", "Amazon.com, Inc.", "52.95")}


def dom(col) -> F.Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.concat(F.lit("d"), c.cast("string"))


def publish_times(t: Tables) -> DataFrame:
    return t.events.select(dom("user_id").alias("domain"), F.col("ts"))


def analysed_domains(t: Tables) -> DataFrame:
    return t.customer.select(dom("c_custkey").alias("domain"))


def registration_records(t: Tables) -> DataFrame:
    """domain, created_date, registrar, registration_country, source."""
    first = (t.orders.groupBy("o_custkey")
             .agg(F.min("o_orderdate").alias("created_ts")))
    nation = t.nation.select("n_nationkey", "n_name")
    return (t.customer.select("c_custkey", "c_mktsegment", "c_nationkey")
            .join(first, F.col("c_custkey") == F.col("o_custkey"), "left")
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
            .select(dom("c_custkey").alias("domain"),
                    F.to_date("created_ts").alias("created_date"),
                    F.col("c_mktsegment").alias("registrar"),
                    F.coalesce(F.col("n_name"), F.lit("")).alias("registration_country"),
                    F.when(F.col("created_ts").isNull(), F.lit("heuristic"))
                     .otherwise(F.lit("whoisxml")).alias("source")))


def hosting_records(t: Tables) -> DataFrame:
    """domain, ip_address, asn, hosting_org, status."""
    band = (F.floor(F.col("c_acctbal") / 1000) + 2).cast("int")
    nk = F.col("c_nationkey")
    asn = F.concat(F.lit("AS"), (F.lit(64512) + nk).cast("string"))
    org = F.concat(F.col("n_name"), F.lit(" TELECOM"))
    ip = F.format_string("10.%d.%d.1", nk, band)
    for key, (c_asn, c_org, c_pref) in CDN_NATIONS.items():
        asn = F.when(nk == key, F.lit(c_asn)).otherwise(asn)
        org = F.when(nk == key, F.lit(c_org)).otherwise(org)
        ip = F.when(nk == key, F.format_string(c_pref + ".%d.1", band)).otherwise(ip)
    return (t.customer.select("c_custkey", "c_nationkey", "c_acctbal")
            .join(t.nation.select("n_nationkey", "n_name"), nk == F.col("n_nationkey"), "left")
            .select(dom("c_custkey").alias("domain"), ip.alias("ip_address"), asn.alias("asn"),
                    F.concat_ws(" ", asn, org).alias("org_line"), F.lit("ok").alias("status")))


def outlinks(t: Tables) -> DataFrame:
    """Distinct directed links src -> dst."""
    # de-duplicate on the integer keys (cheaper to shuffle), then name them
    return (t.lineitem.select("l_suppkey", "l_partkey").filter(F.col("l_suppkey") != F.col("l_partkey"))
            .distinct().select(dom("l_suppkey").alias("src"), dom("l_partkey").alias("dst")))


def snapshots(t: Tables) -> DataFrame:
    """domain, ts as ``yyyyMMddHHmmss`` text."""
    return t.orders.select(dom("o_custkey").alias("domain"),
                           F.date_format("o_orderdate", "yyyyMMddHHmmss").alias("ts"))


def bylines(t: Tables) -> DataFrame:
    """domain, author (one row per article byline)."""
    return (t.lineitem.select("l_suppkey", "l_partkey")
            .join(t.part.select("p_partkey", "p_name", "p_brand", "p_size"),
                  F.col("l_partkey") == F.col("p_partkey"))
            .select(dom("l_suppkey").alias("domain"),
                    F.concat_ws(" ", "p_name", "p_brand", F.col("p_size").cast("string")).alias("author")))


#: The rules on a vector's text (excerpts, syndication, navigation phrases) look at no more than its first characters.
RULE_CHARS = 1000


def vectors(t: Tables) -> DataFrame:
    """domain, parent, embedding, text (the first ``RULE_CHARS`` of the document of the same id: whole texts need not move)."""
    docs = t.documents.select(F.col("doc_id"), F.substring("text", 1, RULE_CHARS).alias("text"))
    return (t.embeddings.select("vec_id", "embedding", "label")
            .join(docs, F.col("vec_id") == F.col("doc_id"), "left")
            .select(dom("vec_id").alias("domain"),
                    F.concat(F.lit("site"), F.col("label").cast("string")).alias("parent"),
                    F.col("embedding"), F.coalesce(F.col("text"), F.lit("")).alias("text")))
