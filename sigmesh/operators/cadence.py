"""Publishing-cadence features (D1, H9, H10) and the cadence flag rules.

``cadence_features`` is a two-level aggregation: first per (domain, hour) —
partial aggregation collapses every map task's rows for a hot domain into at
most 24 rows before the shuffle — then per domain.  Variances are built from
exact integer sums, so they do not depend on row order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from ..functions.timeparts import hour_of, minute_of, weekday_of


def cadence_features(pages: DataFrame, domain: str = "domain", ts: str = "ts") -> DataFrame:
    """Per-domain cadence row: page_count, avg_hour, hour_variance,
    minute_variance, unique_hours, unique_days, burst_score (D1).

    ``pages`` holds one row per published page with a timestamp column; rows
    whose timestamp is missing are dropped (hour = −1 in the source rule).
    Compute it on pages *before* any per-domain de-duplication.
    """
    rows = (pages
            .select(F.col(domain).alias("domain"),
                    hour_of(ts).alias("hour"), minute_of(ts).alias("minute"),
                    weekday_of(ts).alias("weekday"))
            .filter(F.col("hour") >= 0))
    per_hour = (rows.groupBy("domain", "hour")
                .agg(F.count(F.lit(1)).alias("nh"),
                     F.sum(F.col("minute").cast("long")).alias("sm"),
                     F.sum((F.col("minute") * F.col("minute")).cast("long")).alias("sm2"),
                     F.bit_or(F.expr("shiftleft(1, weekday)")).alias("wmask")))
    h = F.col("hour").cast("long")
    agg = (per_hour.groupBy("domain")
           .agg(F.sum("nh").alias("n"),
                F.sum(F.col("nh") * h).alias("sh"),
                F.sum(F.col("nh") * h * h).alias("sh2"),
                F.sum("sm").alias("sm"), F.sum("sm2").alias("sm2"),
                F.count(F.lit(1)).alias("unique_hours"),
                F.bit_or("wmask").alias("wmask"),
                F.max("nh").alias("max_nh")))
    n = F.col("n")
    nd = n.cast("double")

    def var_pop(s, s2):
        # (n*Σx² − (Σx)²) / n² — exact integer numerator, one rounding step.
        return (n * F.col(s2) - F.col(s) * F.col(s)).cast("double") / (nd * nd)

    return agg.select(
        "domain",
        n.cast("int").alias("page_count"),
        F.round(F.col("sh") / nd, 2).alias("avg_hour"),
        F.round(var_pop("sh", "sh2"), 4).alias("hour_variance"),
        F.round(var_pop("sm", "sm2"), 4).alias("minute_variance"),
        F.col("unique_hours").cast("int").alias("unique_hours"),
        F.bit_count("wmask").cast("int").alias("unique_days"),
        F.round(F.col("max_nh") / nd, 4).alias("burst_score"),
    )


def cadence_rule_flag(features: DataFrame, burst_at: float = 0.13,
                      variance_at: float = 35.0) -> DataFrame:
    """Machine-like cadence by rule: a dominant hour or a narrow spread of hours."""
    return features.withColumn(
        "cadence_flagged",
        ((F.col("burst_score") >= burst_at) | (F.col("hour_variance") <= variance_at)).cast("int"))


def top_bursty(features: DataFrame, k: int = 10) -> DataFrame:
    """Most bursty domains, ties broken by name (F3 ordering, complete key)."""
    return features.orderBy(F.desc("burst_score"), F.asc("domain")).limit(k)


def top_anomalies(scored: DataFrame, k: int = 5) -> DataFrame:
    """the ``k`` most anomalous domains, lowest score first, ties by name."""
    return scored.orderBy(F.asc("anomaly_score"), F.asc("domain")).limit(k)


def cadence_row_features(pages: DataFrame, domain: str = "domain", ts: str = "ts",
                         text: str = "text", links: str = "links") -> DataFrame:
    """Live per-row features: hour, minute, weekday (0 when unparsable),
    text length, has-links (H10)."""
    t = F.col(ts)
    links_c = F.col(links)
    if isinstance(pages.schema[links].dataType, ArrayType):
        has_links = F.coalesce(F.size(links_c) > 0, F.lit(False))
    else:
        has_links = F.coalesce(F.length(links_c) > 0, F.lit(False))
    return pages.select(
        F.col(domain).alias("domain"),
        F.coalesce(F.hour(t), F.lit(0)).cast("double").alias("f_hour"),
        F.coalesce(F.minute(t), F.lit(0)).cast("double").alias("f_minute"),
        F.coalesce(F.weekday(t), F.lit(0)).cast("double").alias("f_dow"),
        F.length(F.coalesce(F.col(text), F.lit(""))).cast("double").alias("f_text_len"),
        has_links.cast("double").alias("f_has_links"),
    )
