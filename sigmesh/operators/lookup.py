"""Lookup path: preliminary verdict, stored-card lookup, cache and job
helpers (B17, B18, Q2, A17, E2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import PRELIMINARY_NONE, PRELIMINARY_REASONS
from ..functions.domains import has_promo_pattern, has_suspicious_tld, suspicious_name
from .verdict import confidence_col, risk_copy, verdict_col


def preliminary(domains: DataFrame, registration: DataFrame | None = None) -> DataFrame:
    """Name-and-age heuristic (B18): score of four rules -> SYNTHETIC .74 /
    REVIEW .58 / ORGANIC .76, with reasons."""
    d = domains.select("domain")
    if registration is not None:
        d = d.join(registration.select("domain", "domain_age_days", "whois_flagged"), "domain", "left")
    else:
        d = d.withColumn("domain_age_days", F.lit(None).cast("int")).withColumn("whois_flagged", F.lit(None).cast("int"))
    whois = F.coalesce(F.col("whois_flagged"), suspicious_name("domain").cast("int"))
    rules = [F.coalesce(F.col("domain_age_days").between(0, 90), F.lit(False)),
             has_suspicious_tld("domain"), has_promo_pattern("domain"), whois == 1]
    score = sum((r.cast("int") for r in rules[1:]), rules[0].cast("int"))
    reasons = F.array_compact(F.array(*[F.when(r, F.lit(t)) for r, t in zip(rules, PRELIMINARY_REASONS)]))
    verdict = F.when(score >= 3, "SYNTHETIC").when(score >= 1, "REVIEW").otherwise("ORGANIC")
    conf = F.when(score >= 3, 0.74).when(score >= 1, 0.58).otherwise(0.76)
    out = d.select("domain", score.cast("int").alias("score"), verdict.alias("verdict"), conf.alias("confidence"),
                   F.when(F.size(reasons) > 0, F.array_join(reasons, "; ")).otherwise(F.lit(PRELIMINARY_NONE))
                   .alias("explanation"))
    lvl, head = risk_copy("verdict")
    return out.withColumn("risk_level", lvl).withColumn("headline", head)


def lookup(requests: DataFrame, stored: DataFrame, registration: DataFrame | None = None) -> DataFrame:
    """Stored card when the domain is a node, else the preliminary verdict
    (Q2): hits by inner join, misses by anti-join, one union."""
    r = requests.select("domain").distinct()
    hits = r.join(stored, "domain").select(
        "domain", F.lit("stored").alias("source"),
        verdict_col("signals_triggered", "stored").alias("verdict"),
        confidence_col("signals_triggered", "max_similarity", "burst_score", F.lit(0.0)).alias("confidence"))
    misses = preliminary(r.join(stored.select("domain"), "domain", "left_anti"), registration).select(
        "domain", F.lit("preliminary").alias("source"), "verdict", "confidence")
    return hits.unionByName(misses)


def fresh(cache: DataFrame, as_of: str, ttl_hours: int, ts: str = "cached_at") -> Column:
    """Cache hit test (A17): entry younger than the TTL at ``as_of``."""
    age_s = F.unix_timestamp(F.to_timestamp(F.lit(as_of))) - F.unix_timestamp(F.col(ts))
    return (age_s >= 0) & (age_s < ttl_hours * 3600)


def cache_misses(domains: DataFrame, cache: DataFrame, as_of: str, ttl_hours: int) -> DataFrame:
    """Domains without a fresh cache entry (A17): anti-join on the fresh set."""
    hit = cache.filter(fresh(cache, as_of, ttl_hours)).select("domain").distinct()
    return domains.select("domain").distinct().join(hit, "domain", "left_anti")


def latest_job(jobs: DataFrame) -> DataFrame:
    """Latest completed job with evidence per domain (E2), by (finished_at, job_id)."""
    done = jobs.filter((F.col("status") == "completed") & F.col("has_result"))
    return (done.groupBy("domain")
            .agg(F.max_by(F.struct("job_id", "finished_at"), F.struct("finished_at", "job_id")).alias("j"))
            .select("domain", "j.job_id", "j.finished_at"))
