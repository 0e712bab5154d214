"""Archive-history signal.

Snapshots are first collapsed to one row per (domain, month) by partial
aggregation; a domain then has at most one row per month of history, so the
per-domain ranking that applies the 500-row reply cap is bounded by the time
span, not by the data volume.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import Settings


def archive_features(snaps: DataFrame, cfg: Settings) -> DataFrame:
    """snapshots (domain, ts 'yyyyMMddHHmmss') -> domain, wayback_snapshot_count,
    wayback_first_seen, wayback_recent_count, wayback_age_days."""
    months = (snaps.select("domain", F.col("ts").cast("string").alias("ts"))
              .filter(F.length("ts") >= 8)
              .groupBy("domain", F.substring("ts", 1, 6).alias("month"))
              .agg(F.min("ts").alias("ts")))
    w = Window.partitionBy("domain").orderBy("month")
    kept = months.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= cfg.wayback_max_rows)
    cutoff = F.date_format(F.date_sub(F.to_date(F.lit(cfg.as_of)), cfg.wayback_recent_days), "yyyyMMdd")
    agg = kept.groupBy("domain").agg(
        F.count(F.lit(1)).alias("wayback_snapshot_count"),
        F.substring(F.min("ts"), 1, 8).alias("wayback_first_seen"),
        F.sum(F.when(F.substring("ts", 1, 8) >= cutoff, 1).otherwise(0)).alias("wayback_recent_count"))
    first = F.to_date(F.col("wayback_first_seen"), "yyyyMMdd")
    return agg.select(
        "domain",
        F.col("wayback_snapshot_count").cast("int").alias("wayback_snapshot_count"),
        "wayback_first_seen",
        F.col("wayback_recent_count").cast("int").alias("wayback_recent_count"),
        F.datediff(F.to_date(F.lit(cfg.as_of)), first).cast("int").alias("wayback_age_days"),
    )


def archive_flags(domains: DataFrame, feats: DataFrame, cfg: Settings,
                  status: DataFrame | None = None) -> DataFrame:
    """``new_site`` = no error and count < min; ``recent_spike`` = count >=
    min, recent >= 2, recent/count >= ratio.  A domain without an archive row
    is unknown and not flagged (K6); fallback rows are never flagged."""
    j = domains.select("domain").join(feats, "domain", "left")
    if status is not None:
        j = j.join(status.select("domain", "status"), "domain", "left")
    else:
        j = j.withColumn("status", F.lit(None).cast("string"))
    if "wayback_error" not in j.columns:
        j = j.withColumn("wayback_error", F.lit(False))
    known = F.col("wayback_snapshot_count").isNotNull() & (F.coalesce(F.col("status"), F.lit("")) != "fallback")
    cnt = F.col("wayback_snapshot_count")
    rec = F.col("wayback_recent_count")
    new = known & ~F.coalesce(F.col("wayback_error"), F.lit(False)) & (cnt < cfg.wayback_min_snapshots)
    spike = known & (cnt >= cfg.wayback_min_snapshots) & (rec >= 2) & \
        (rec / F.greatest(cnt, F.lit(1)) >= cfg.wayback_spike_ratio)
    return j.select(
        "domain",
        F.coalesce(cnt, F.lit(0)).alias("wayback_snapshot_count"),
        F.coalesce(F.col("wayback_first_seen"), F.lit("")).alias("wayback_first_seen"),
        F.coalesce(rec, F.lit(0)).alias("wayback_recent_count"),
        F.col("wayback_age_days"),
        (new | spike).cast("int").alias("wayback_flagged"),
        F.when(new, "new_site").when(spike, "recent_spike").otherwise("").alias("wayback_flag_reason"),
    )


def effective_age(df: DataFrame) -> DataFrame:
    """Registration age if known (>= 0), else archive age; source tag."""
    reg = F.col("domain_age_days")
    arc = F.col("wayback_age_days")
    reg_ok = reg.isNotNull() & (reg >= 0)
    arc_ok = arc.isNotNull() & (arc >= 0)
    return (df.withColumn("effective_age_days", F.when(reg_ok, reg).when(arc_ok, arc))
              .withColumn("domain_age_source",
                          F.when(reg_ok, "whois").when(arc_ok, "wayback_estimate").otherwise("unknown")))
