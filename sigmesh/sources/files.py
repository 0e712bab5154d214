"""File sources and sinks (A2, A3, A9, A10, A19, A20, A22; page archives are in
``archive``, the model store in ``versions``).

Readers declare schemas (no inference); writers use the committer protocol
(no temp-file renames) and partition where later reads prune.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import min_text

REPORT_ID_RE = r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"
DEFAULT_TS = "2024-12-15 03:47:00"


def read_csv_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Header CSV with a declared schema; quoted multi-line fields allowed (A2)."""
    return (spark.read.schema(schema).option("header", True).option("multiLine", True)
            .option("escape", '"').csv(path))


def tolerant_corpus(frames: list[DataFrame], max_chars: int | None = None, min_chars: int = 50) -> DataFrame:
    """Corpus from several sources in priority order (A3): text = first present
    of text/content/page_text/body; links and timestamp likewise with a default
    timestamp; text longer than ``min_chars``; first source wins per domain."""
    parts = []
    for rank, df in enumerate(frames):
        cols = set(df.columns)
        text = F.coalesce(*[F.col(c).cast("string") for c in ("text", "content", "page_text", "body") if c in cols],
                          F.lit(None).cast("string"))
        links = F.coalesce(*[F.col(c).cast("string") for c in ("links", "outlinks") if c in cols],
                           F.lit("").cast("string"))
        ts = F.coalesce(*[F.col(c).cast("string") for c in ("timestamp", "ts", "published") if c in cols],
                        F.lit(DEFAULT_TS))
        txt = F.substring(text, 1, max_chars) if max_chars else text  # whole texts unless a cap is asked
        parts.append(df.select(F.lower(F.trim(F.col("domain").cast("string"))).alias("domain"),
                               txt.alias("text"), links.alias("links"),
                               ts.alias("timestamp"), F.lit(rank).alias("file_rank")))
    allp = parts[0]
    for p in parts[1:]:
        allp = allp.unionByName(p, allowMissingColumns=True)
    allp = allp.filter((F.col("domain") != "") & min_text("text", min_chars))
    # first source (then first text) wins per domain: a partial aggregation
    return (allp.groupBy("domain")
            .agg(F.min_by(F.struct("text", "links", "timestamp", "file_rank"),
                          F.struct("file_rank", "text")).alias("r"))
            .select("domain", "r.*"))


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Stage-table sink."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def publish(df: DataFrame, base: str, version: str) -> str:
    """Versioned publish (A10): write ``base/v=<version>``; earlier versions
    stay as the backup; readers pick the newest version directory."""
    path = f"{base.rstrip('/')}/v={version}"
    df.write.mode("overwrite").parquet(path)
    return path


def read_latest(spark: SparkSession, base: str) -> DataFrame:
    df = spark.read.parquet(base)
    if "v" not in df.columns:
        return df
    # versions by number where they have one (v10 after v9), then by name
    order = F.struct(F.regexp_extract(F.col("v").cast("string"), r"(\d+)", 1).try_cast("long").alias("n"), F.col("v").cast("string").alias("v"))
    latest = df.agg(F.max(order).alias("top")).select("top.v").scalar()
    return df.filter(F.col("v").cast("string") == latest).drop("v")


def save_reports(reports: DataFrame, path: str) -> None:
    """Reports partitioned by id (A19), so a lookup prunes to one folder."""
    reports.write.mode("append").partitionBy("report_id").json(path)


def get_report(spark: SparkSession, path: str, report_id: str) -> DataFrame:
    """One report by id; ids that are not 36-char UUIDs return nothing."""
    df = spark.read.json(path)
    ok = F.lit(report_id).rlike(REPORT_ID_RE)
    return df.filter(ok & (F.col("report_id") == report_id))


def new_report_id() -> str:
    return str(uuid.uuid4())


def export_report(result: DataFrame) -> DataFrame:
    """Nine-field JSON document per analysis."""
    fields = ["report_id", "saved_at", "project", "analyzed_at", "seed_domains", "cluster_verdict",
              "confidence", "summary", "domain_verdicts"]
    have = [c for c in fields if c in result.columns]
    return result.select(F.to_json(F.struct(*have)).alias("document"))


def write_metrics(df: DataFrame, path: str, section: str) -> None:
    """Merge one named section into the metrics table (A22): dynamic partition
    overwrite replaces only that section."""
    (df.withColumn("section", F.lit(section)).write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic").partitionBy("section").parquet(path))
