"""Feature assembly, verdict, confidence and explanation (B11-B17, B32, B37,
C1, C2, D10-D12).

Every signal table has one row per domain, so assembly is a chain of left
joins on ``domain``; Spark hash-partitions each input on ``domain`` once and
the joins reuse that partitioning.  Nulls stay nulls inside; sentinels are
applied in one final projection (``with_sentinels``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import CLUSTER_TEXT, EVIDENCE_TIERS, RISK_COPY, SIGNAL_COLUMNS, SIGNAL_NAMES, Settings
from .archive import effective_age

SIGNAL_OUT = ("signal_1_similarity", "signal_2_cadence", "signal_3_whois", "signal_4_hosting",
              "signal_5_link_network", "signal_6_wayback", "signal_7_authors")


def assemble_features(domains: DataFrame, *signals: DataFrame) -> DataFrame:
    """Left-join each per-domain signal table onto the base domain set."""
    out = domains.select("domain").distinct()
    for s in signals:
        out = out.join(s, "domain", "left")
    return out


def signals_triggered(cols=SIGNAL_COLUMNS) -> Column:
    """Sum of the seven 0/1 flags."""
    return reduce(lambda a, b: a + b, [F.coalesce(F.col(c), F.lit(0)) for c in cols])


FEATURE_DEFAULTS = {
    "avg_similarity": 0.0, "max_similarity": 0.0, "similarity_flag": 0, "similar_domain_count": 0,
    "anomaly_score": 0.0, "cadence_flagged": 0, "burst_score": 0.0,
    "domain_age_days": -1, "whois_flagged": 0, "registrar": "unknown", "registration_country": "",
    "whois_source": "heuristic",
    "ip_address": "", "asn": "", "hosting_org": "", "hosting_flagged": 0, "is_cdn": False,
    "shared_ip_count": 0, "shared_asn_count": 0,
    "mutual_link_count": 0, "insular_score": 0.0, "link_network_flagged": 0,
    "wayback_snapshot_count": 0, "wayback_first_seen": "", "wayback_recent_count": 0,
    "wayback_age_days": -1, "wayback_flagged": 0, "wayback_flag_reason": "",
    "shared_author_count": 0, "author_overlap_flagged": 0,
}


def feature_table(assembled: DataFrame) -> DataFrame:
    """Final per-domain feature row with effective age, signal count and
    sentinels (B13, B12, B32)."""
    f = effective_age(assembled)
    f = f.withColumn("signals_triggered", signals_triggered().cast("int"))
    fills = {k: v for k, v in FEATURE_DEFAULTS.items() if k in f.columns}
    f = f.fillna(fills)
    if "shared_authors" in f.columns:
        f = f.withColumn("shared_authors", F.to_json(F.coalesce(F.col("shared_authors"),
                                                                F.array().cast("array<string>"))))
    return f.withColumn("effective_age_days", F.coalesce(F.col("effective_age_days"), F.lit(-1)))


def verdict_col(n, profile: str = "current", cfg: Settings | None = None) -> Column:
    """Verdict from the signal count (B11): current ≥3 / =2; stored-graph ≥3 / ≥1;
    legacy ≥2 / ≥1."""
    n = F.col(n) if isinstance(n, str) else n
    if profile == "current":
        syn = cfg.synthetic_at if cfg else 3
        return F.when(n >= syn, "SYNTHETIC").when(n == syn - 1, "REVIEW").otherwise("ORGANIC")
    if profile == "stored":
        return F.when(n >= 3, "SYNTHETIC").when(n >= 1, "REVIEW").otherwise("ORGANIC")
    if profile == "legacy":
        return F.when(n >= 2, "SYNTHETIC").when(n >= 1, "REVIEW").otherwise("ORGANIC")
    raise ValueError(profile)


def round2(c: Column) -> Column:
    """Round to 2 places on the binary value (floor(x*100 + .5)/100): the same
    IEEE steps in every engine, and the result Python's round gives except
    on exact binary ties."""
    return F.floor(c * 100.0 + 0.5) / 100.0


def confidence_col(n, max_sim, burst, prob) -> Column:
    """Canonical confidence (B14), rounded to 2 places."""
    n, s, b, p = [F.col(c) if isinstance(c, str) else c for c in (n, max_sim, burst, prob)]
    boosts = F.least(s * 0.20, F.lit(0.10)) + F.least(b * 0.15, F.lit(0.06)) + p * 0.05
    high = F.greatest(F.lit(0.65), F.least(0.65 + F.least((n - 3) / 4.0, F.lit(1.0)) * 0.20 + boosts, F.lit(0.97)))
    mid = F.greatest(F.lit(0.02), F.least(0.40 + (n - 1) * 0.10 + boosts, F.lit(0.64)))
    low = F.greatest(F.lit(0.70), F.least(1.0 - boosts, F.lit(0.97)))
    return round2(F.when(n >= 3, high).when(n >= 1, mid).otherwise(low))


def organic_confidence_col(max_sim, burst, prob) -> Column:
    """ORGANIC override for 0 or 1 signal."""
    s, b, p = [F.col(c) if isinstance(c, str) else c for c in (max_sim, burst, prob)]
    boosts = F.least(s * 0.20, F.lit(0.20)) + F.least(b * 0.15, F.lit(0.10)) + p * 0.05
    return round2(F.greatest(F.lit(0.70), F.least(1.0 - boosts, F.lit(0.97))))


def _pct0(c: Column) -> Column:
    # whole percent, half-up (the same rounding as the SQL twin)
    return F.concat(F.round(c * 100, 0).cast("int").cast("string"), F.lit("%"))


def explanation_col() -> Column:
    """Template explanation from the fired signals."""
    n = F.col("signals_triggered")
    names = F.concat_ws(", ", F.transform(F.slice(F.from_json("shared_authors", "array<string>"), 1, 3),
                                          lambda x: F.concat(F.lit('"'), x, F.lit('"'))))
    reasons = F.array(
        F.when(F.col("similarity_flag") == 1,
               F.format_string("content is unusually similar to other domains (similarity %.2f)",
                               F.round(F.col("max_similarity"), 2))),
        F.when(F.col("cadence_flagged") == 1, F.lit("anomalous publishing time pattern detected")),
        F.when(F.col("whois_flagged") == 1, F.lit("suspicious domain registration pattern")),
        F.when(F.col("hosting_flagged") == 1,
               F.lit("shares hosting infrastructure with other analyzed domains")),
        F.when(F.col("link_network_flagged") == 1,
               F.when(F.col("mutual_link_count") > 0,
                      F.format_string("mutually links with %d other domain(s) in the cluster",
                                      F.col("mutual_link_count")))
               .otherwise(F.concat(_pct0(F.col("insular_score")),
                                   F.lit(" of outgoing links stay within the analyzed cluster")))),
        F.when(F.col("wayback_flagged") == 1,
               F.when(F.col("wayback_flag_reason") == "new_site",
                      F.format_string("only %d Wayback Machine snapshot(s) — site appears very new",
                                      F.col("wayback_snapshot_count")))
               .otherwise(F.format_string("archive spike: %d of %d snapshots are from the last 30 days",
                                          F.col("wayback_recent_count"), F.col("wayback_snapshot_count")))),
        F.when(F.col("author_overlap_flagged") == 1,
               F.concat(F.lit("author name(s) "), names, F.lit(" appear across multiple domains"))),
    )
    joined = F.concat_ws("; ", reasons)
    none = F.concat(F.col("domain"), F.lit(" passed all 7 checks — no suspicious patterns detected. "
                                           "Content, hosting, link structure, archive history, and "
                                           "registration data all appear organic."))
    some = F.concat(
        F.col("domain"), F.lit(" triggered "), n.cast("string"), F.lit("/7 signals: "), joined, F.lit(". "),
        F.when(n >= 3, F.format_string("With %d signals converging, the 3-of-7 rule classifies this as a "
                                       "synthetic network.", n))
         .otherwise(F.format_string("%d signal(s) detected — flagged for human review. Not enough to "
                                    "confirm a fake network alone.", n)))
    fired = reduce(lambda acc, pair: acc.when(F.col(pair[0]) == 1, F.lit(pair[1])),
                   list(zip(SIGNAL_COLUMNS, SIGNAL_NAMES))[1:],
                   F.when(F.col(SIGNAL_COLUMNS[0]) == 1, F.lit(SIGNAL_NAMES[0]))).otherwise("unknown signal")
    single = F.concat(
        F.col("domain"), F.lit(" — "), fired,
        F.lit(" signal fired (1/7), but no other signals corroborate it. The 3-of-7 convergence rule "
              "requires at least 2 independent signals before flagging a domain as Suspicious. A single "
              "signal may reflect legitimate syndication, regional topic overlap, or common hosting. "
              "Verdict: Looks Legitimate."))
    return F.when(n == 1, single).when(F.size(F.array_compact(reasons)) == 0, none).otherwise(some)


def verdicts(features: DataFrame, cfg: Settings, prob: str | None = None) -> DataFrame:
    """Per-domain verdict record."""
    p = F.col(prob) if prob else F.lit(0.0)
    n = F.col("signals_triggered")
    v = verdict_col(n, "current", cfg)
    conf = F.when(v == "ORGANIC", organic_confidence_col("max_similarity", "burst_score", p)) \
            .otherwise(confidence_col(n, "max_similarity", "burst_score", p))
    return features.select(
        "domain",
        v.alias("verdict"),
        conf.alias("confidence"),
        F.round(p, 4).alias("gnn_raw_score"),
        n.alias("signals_triggered"),
        *[F.col(src).cast("int").alias(dst) for src, dst in zip(SIGNAL_COLUMNS, SIGNAL_OUT)],
        "max_similarity", "burst_score", F.col("effective_age_days").alias("domain_age_days"),
        "domain_age_source", "ip_address",
        "hosting_org", "insular_score", "wayback_snapshot_count", "wayback_flag_reason", "shared_authors",
        explanation_col().alias("explanation"),
    )


def risk_copy(col: str = "verdict") -> tuple[Column, Column]:
    """Verdict -> (risk_level, headline)."""
    lvl = reduce(lambda acc, r: acc.when(F.col(col) == r[0], F.lit(r[1])), RISK_COPY[1:],
                 F.when(F.col(col) == RISK_COPY[0][0], F.lit(RISK_COPY[0][1])))
    head = reduce(lambda acc, r: acc.when(F.col(col) == r[0], F.lit(r[2])), RISK_COPY[1:],
                  F.when(F.col(col) == RISK_COPY[0][0], F.lit(RISK_COPY[0][2])))
    return lvl.otherwise(RISK_COPY[-1][1]), head.otherwise(RISK_COPY[-1][2])


def cluster_summary(v: DataFrame, batch_col: str | None = None) -> DataFrame:
    """Counts by verdict, max confidence and the cluster verdict by precedence."""
    g = v.groupBy(batch_col) if batch_col else v.groupBy()
    out = g.agg(
        F.sum((F.col("verdict") == "SYNTHETIC").cast("int")).alias("synthetic_domains"),
        F.sum((F.col("verdict") == "REVIEW").cast("int")).alias("review_domains"),
        F.sum((F.col("verdict") == "ORGANIC").cast("int")).alias("organic_domains"),
        F.round(F.max("confidence"), 4).alias("max_confidence"),
        F.count(F.lit(1)).alias("domains"))
    return out.withColumn("cluster_verdict",
                          F.when(F.col("synthetic_domains") > 0, "SYNTHETIC")
                           .when(F.col("review_domains") > 0, "REVIEW").otherwise("ORGANIC"))


def cluster_text(summary: DataFrame) -> DataFrame:
    """One summary sentence per cluster (D11; the REVIEW sentence says two
    signals, K15).  Confidence as a whole percent, half-up."""
    pct = F.round(F.col("max_confidence") * 100, 0).cast("int")
    return summary.withColumn("summary", F.when(
        F.col("cluster_verdict") == "SYNTHETIC", F.format_string(CLUSTER_TEXT[0], F.col("synthetic_domains"), pct))
        .when(F.col("cluster_verdict") == "REVIEW", F.format_string(CLUSTER_TEXT[1], F.col("review_domains")))
        .otherwise(F.format_string(CLUSTER_TEXT[2], F.col("domains"))))


def evidence_tier(col: str = "score") -> Column:
    """>= .85, >= .75, else."""
    c = F.col(col)
    return F.when(c >= 0.85, EVIDENCE_TIERS[0]).when(c >= 0.75, EVIDENCE_TIERS[1]).otherwise(EVIDENCE_TIERS[2])


def domain_view(v: DataFrame) -> DataFrame:
    """Per-domain screen view (B37): recount flags, REVIEW at >= 1, confidence
    without model probability, age text, archive text, first shared author."""
    n = reduce(lambda a, b: a + b, [F.coalesce(F.col(c), F.lit(0)) for c in SIGNAL_OUT])
    age = F.col("domain_age_days")
    age_txt = (F.when(age.isNull() | (age < 0), F.lit("age unknown"))
               .when(F.col("domain_age_source") == "wayback_estimate",
                     F.format_string("~%d days (archive estimate)", age))
               .otherwise(F.format_string("%d days old", age)))
    return v.select(
        "domain", n.cast("int").alias("signals"),
        verdict_col(n, "stored").alias("screen_verdict"),
        confidence_col(n, "max_similarity", "burst_score", F.lit(0.0)).alias("screen_confidence"),
        age_txt.alias("age_text"),
        F.when(F.col("wayback_flag_reason") == "new_site", F.lit("new site"))
         .when(F.coalesce(F.col("wayback_flag_reason"), F.lit("")) != "", F.lit("archive spike"))
         .otherwise(F.format_string("%d snapshots", F.coalesce(F.col("wayback_snapshot_count"), F.lit(0)))).alias("archive_text"),
        F.coalesce(F.try_element_at(F.from_json("shared_authors", "array<string>"), F.lit(1)), F.lit("")).alias("first_author"))
