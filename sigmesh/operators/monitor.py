"""Batch side of the monitor: feed merge, batch plan, run log (A6-A8, F8,
G1, G6, D13, D14, E3, E4, B24, B25)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.domains import has_suspicious_tld, hyphen_count
from .order import with_rank

RUN_SCHEMA = ("ran_at string, whoisds_count int, reddit_count int, queued_unique int, batches int, "
              "results int, synthetic_batches int")


def registration_feed_domains(domains: DataFrame, cap: int = 500) -> DataFrame:
    """New-registration feed (A6): a dot and a suspicious TLD or >= 2 hyphens;
    distinct; first ``cap`` by name (the cap is the feed's rule)."""
    d = domains.select(F.lower(F.trim("domain")).alias("domain")).filter(F.locate(".", F.col("domain")) > 0)
    d = d.filter(has_suspicious_tld("domain") | (hyphen_count("domain") >= 2)).distinct()
    return d.orderBy("domain").limit(cap)


def merge_feeds(a: DataFrame, b: DataFrame) -> DataFrame:
    """Union distinct of two feeds (G1)."""
    return a.select("domain").union(b.select("domain")).distinct()


def plan_batches(domains: DataFrame, cap: int = 40, size: int = 10) -> DataFrame:
    """Sorted distinct domains, first ``cap``, chunks of ``size`` (F8).  The
    global row number runs after ``limit(cap)``, on at most ``cap`` rows."""
    top = domains.select("domain").distinct().orderBy("domain").limit(cap)
    rn = F.row_number().over(Window.orderBy("domain"))
    return top.withColumn("batch_id", F.floor((rn - 1) / size).cast("int"))


def monitor_cycles(feed: DataFrame, verdicts: DataFrame, window: str = "6 hours", cap: int = 40,
                   size: int = 10) -> DataFrame:
    """One monitor run per time window (Q5 as a batch roll-up): the window's
    feed domains, sorted, first ``cap`` (two-stage top-k, so a busy window
    is ranked in many tasks), chunks of ``size``; a batch is synthetic when
    one of its domains has a SYNTHETIC verdict (D13)."""
    from .skew import top_k_per_key
    f = (feed.select("domain", F.window("ts", window).start.alias("ran_at"))
         .groupBy("ran_at", "domain").agg(F.count(F.lit(1)).alias("hits")))
    counts = f.groupBy("ran_at").agg(F.count(F.lit(1)).alias("reddit_count"),
                                     F.sum("hits").alias("feed_rows"))
    top = top_k_per_key(f, "ran_at", [F.asc("domain")], cap, ["domain"])
    top = top.withColumn("batch_id", F.floor((F.col("rank") - 1) / size).cast("int"))
    v = top.join(verdicts.select("domain", "verdict"), "domain", "left")
    b = v.groupBy("ran_at", "batch_id").agg(F.max((F.col("verdict") == "SYNTHETIC").cast("int")).alias("syn"),
                                            F.count(F.lit(1)).alias("n"))
    runs = b.groupBy("ran_at").agg(F.sum("n").cast("int").alias("queued_unique"),
                                   F.count(F.lit(1)).cast("int").alias("batches"),
                                   F.sum("n").cast("int").alias("results"),
                                   F.coalesce(F.sum("syn"), F.lit(0)).cast("int").alias("synthetic_batches"))
    return runs.join(counts, "ran_at").select(
        "ran_at", F.lit(0).cast("int").alias("whoisds_count"), F.col("reddit_count").cast("int"),
        "queued_unique", "batches", "results", "synthetic_batches")


def append_run(summary: DataFrame, path: str) -> None:
    """Append one run line."""
    summary.write.mode("append").json(path)


def read_runs(spark, path: str) -> DataFrame:
    """Run log, blank and corrupt lines skipped (A7); times moved to UTC by their offset."""
    df = (spark.read.schema(RUN_SCHEMA + ", _corrupt_record string")
          .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").json(path))
    df = df.filter(F.col("_corrupt_record").isNull() & F.col("ran_at").isNotNull()).drop("_corrupt_record")
    return df.withColumn("ran_ts", F.try_to_timestamp("ran_at"))


def latest_run(runs: DataFrame) -> DataFrame:
    """Latest run status, "no-data" when empty."""
    last = runs.agg(F.max_by(F.struct(*[c for c in runs.columns]), F.col("ran_ts")).alias("r"))
    return last.select(F.when(F.col("r").isNull(), F.lit("no-data")).otherwise(F.lit("ok")).alias("status"),
                       "r.*")


def _run_rate() -> Column:
    return F.when(F.col("batches") > 0, F.col("synthetic_batches") / F.col("batches")).otherwise(F.lit(0.0))


def run_timeline(runs: DataFrame) -> DataFrame:
    """"Run i" labels by time, synthetic rate and chip per run (E3, B25);
    numbers come from range partitions and prefix offsets, not from one task."""
    rate = _run_rate()
    return (with_rank(runs, ["ran_ts"], "_place").withColumn("run", F.concat(F.lit("Run "), (F.col("_place") + 1).cast("string")))
            .withColumn("synthetic_rate", F.round(rate, 4))
            .withColumn("chip", run_chip(rate)).withColumn("threat", threat_level(rate)).drop("_place"))


def rate_trend(runs: DataFrame) -> DataFrame:
    """Change of the synthetic rate from first to last run."""
    a = runs.withColumn("synthetic_rate", F.round(_run_rate(), 4)).agg(F.min_by("synthetic_rate", "ran_ts").alias("first_rate"),
              F.max_by("synthetic_rate", "ran_ts").alias("last_rate"), F.count(F.lit(1)).alias("runs"))
    d = F.col("last_rate") - F.col("first_rate")
    return a.select("*", F.round(d, 4).alias("change"),
                    F.when(d > 0, "↑").when(d < 0, "↓").otherwise("→").alias("arrow"))


def monitor_health(runs: DataFrame) -> DataFrame:
    """Totals; organic = total − synthetic; percent to 1 place."""
    a = runs.agg(F.sum("batches").alias("total"), F.sum("synthetic_batches").alias("synthetic"))
    return a.select("total", "synthetic", (F.col("total") - F.col("synthetic")).alias("organic"),
                    F.round(F.when(F.col("total") > 0, F.col("synthetic") * 100.0 / F.col("total"))
                            .otherwise(0.0), 1).alias("synthetic_pct"))


def threat_level(rate: Column) -> Column:
    """>= .5 HIGH, >= .25 ELEVATED, else NORMAL."""
    return F.when(rate >= 0.5, "HIGH").when(rate >= 0.25, "ELEVATED").otherwise("NORMAL")


def freshness(hours: Column) -> Column:
    """< 6 h fresh, < 24 h recent, else stale."""
    return F.when(hours < 6, "fresh").when(hours < 24, "recent").otherwise("stale")


def run_chip(rate: Column) -> Column:
    """>= .5 HIGH, > 0 MED, else OK."""
    return F.when(rate >= 0.5, "HIGH").when(rate > 0, "MED").otherwise("OK")
