"""Structured Streaming forms of the monitor.

The source polls feeds on a timer and recomputes a whole cycle.  Here feeds
and page events are streams: ``readStream`` → watermark → windowed or
de-duplicating operators → ``foreachBatch`` sinks that are idempotent by
batch id.  ``trigger(availableNow=True)`` drains what exists and stops (the
"cycle"); ``processingTime='6 hours'`` is the interval run.

Checkpoints and outputs live under the shared folder named by
``spark.checkpoint.dir`` (see ``session.ensure_checkpoint_dir``).
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.domains import url_domain_any
from ..session import ensure_checkpoint_dir

FEED_SCHEMA = ("source string, fetched_at timestamp, error string, subreddits array<string>, "
               "scanned_posts int, domain_count int, domains array<string>")


def _reader(spark: SparkSession, schema, max_files: int | None):
    r = spark.readStream.schema(schema)
    return r if max_files is None else r.option("maxFilesPerTrigger", max_files)


def feed_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Feed documents as a stream of (source, fetched_at, domain)."""
    s = _reader(spark, FEED_SCHEMA, max_files).option("mode", "PERMISSIVE").json(path)
    return s.select("source", "fetched_at", F.explode_outer("domains").alias("domain")) \
            .filter(F.col("domain").isNotNull())


def parquet_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Any parquet table as a stream (schema from the batch reader).

    All files present form one micro-batch, so no row of theirs is late,
    whatever the order of the files; ``max_files`` splits them into batches,
    and then only rows within the watermark's delay count.
    Wall-clock timestamps (TIMESTAMP_NTZ) become event-time timestamps in
    the session zone (UTC), since watermarks need TIMESTAMP."""
    from pyspark.sql.types import TimestampNTZType
    schema = spark.read.parquet(path).schema
    reader = _reader(spark, schema, max_files)
    p = spark._jvm.org.apache.hadoop.fs.Path(path)  # the path's own store tells what it is
    if p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(p).isFile():
        # a single-file table: stream its folder, filtered to the file
        s = reader.option("pathGlobFilter", os.path.basename(path)).parquet(os.path.dirname(path))
    else:
        s = reader.parquet(path)
    for f in schema.fields:
        if isinstance(f.dataType, TimestampNTZType):
            s = s.withColumn(f.name, F.col(f.name).cast("timestamp"))
    return s


def dedup_feed(stream: DataFrame, ts: str = "fetched_at", horizon: str = "24 hours",
               key: str = "domain") -> DataFrame:
    """Distinct keys within a horizon (S2): a repeat inside the watermark delay
    of the first sighting is dropped; state is bounded by the horizon."""
    return stream.withWatermark(ts, horizon).dropDuplicatesWithinWatermark([key])


def cadence_stream(stream: DataFrame, ts: str = "ts", key: str = "domain",
                   window: str = "1 hour", lateness: str = "1 hour") -> DataFrame:
    """Pages per domain and hour window."""
    return (stream.withWatermark(ts, lateness)
            .groupBy(key, F.window(ts, window).alias("w"))
            .agg(F.count(F.lit(1)).alias("pages"))
            .select(key, F.col("w.start").alias("window_start"), "pages"))


def timeline(stream: DataFrame, ts: str = "ts", window: str = "6 hours",
             lateness: str = "6 hours") -> DataFrame:
    """Run timeline as tumbling windows (S5): events and distinct sources."""
    return (stream.withWatermark(ts, lateness)
            .groupBy(F.window(ts, window).alias("w"))
            .agg(F.count(F.lit(1)).alias("events"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "events"))


def burst_sessions(stream: DataFrame, ts: str = "ts", key: str = "domain", gap: str = "1 hour",
                   lateness: str = "1 hour") -> DataFrame:
    """Publishing bursts (S6): runs of one domain's pages less than ``gap``
    apart, as session windows. A burst is given out once no page can join it:
    when its end has passed the watermark."""
    return (stream.withWatermark(ts, lateness)
            .groupBy(key, F.session_window(ts, gap).alias("w"))
            .agg(F.count(F.lit(1)).alias("pages"), F.max(ts).alias("last_page"))
            .select(key, F.col("w.start").alias("burst_start"), "last_page", "pages"))


def sliding_trend(stream: DataFrame, ts: str = "ts", window: str = "24 hours", slide: str = "6 hours",
                  lateness: str = "6 hours") -> DataFrame:
    """Moving totals (S5): events of the last ``window``, every ``slide``."""
    return (stream.withWatermark(ts, lateness)
            .groupBy(F.window(ts, window, slide).alias("w"))
            .agg(F.count(F.lit(1)).alias("events"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "events"))


def _scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint location (a URI on a cluster)."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/stream-{name}-{uuid.uuid4().hex[:8]}"


def run_updates(spark: SparkSession, agg: DataFrame, keys: list[str], value_cols: list[str],
                name: str, available_now: bool = True) -> DataFrame:
    """Drive an aggregating stream in update mode.

    Each micro-batch's updated rows go to ``<out>/batch_id=<n>`` (overwrite,
    so a retried batch is idempotent); the final table is the newest update
    per key (``max_by`` on batch id).  Returns that table as a DataFrame."""
    base = _scratch(spark, name)
    out, ckpt = f"{base}/out", f"{base}/ckpt"

    wrote: list[int] = []

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
        wrote.append(batch_id)

    w = agg.writeStream.outputMode("update").foreachBatch(sink).option("checkpointLocation", ckpt)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="6 hours")
    q = w.start()
    if not available_now:
        return q  # caller manages the running query
    q.awaitTermination()
    if not wrote:  # no micro-batch produced output
        return spark.createDataFrame([], agg.schema)
    rows = spark.read.parquet(out)
    latest = rows.groupBy(*keys).agg(F.max_by(F.struct(*value_cols), F.col("batch_id")).alias("v"))
    return latest.select(*keys, "v.*")


def run_append(spark: SparkSession, stream: DataFrame, name: str) -> DataFrame:
    """Drain an append-mode stream to parquet with ``availableNow``; return the rows."""
    base = _scratch(spark, name)
    out, ckpt = f"{base}/out", f"{base}/ckpt"
    q = (stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt)
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def social_feed_domains(posts: DataFrame, url_col: str = "url", text_col: str | None = None) -> DataFrame:
    """Domains from posts (A5): link URL plus URLs in the post text; host
    lower-cased without any ``www.``; drop empty, dotless and the social
    site itself under any of its names; distinct."""
    urls = F.array(F.col(url_col))
    if text_col:
        urls = F.concat(urls, F.regexp_extract_all(F.coalesce(F.col(text_col), F.lit("")),
                                                   F.lit(r"https?://[^\s)\]]+"), 0))
    d = posts.select(F.explode(urls).alias("u")).select(url_domain_any("u").alias("domain"))
    return d.filter(F.col("domain").isNotNull() & (F.col("domain") != "") & ~F.contains("domain", F.lit("reddit.com"))) \
            .distinct()


LISTING = ("struct<data:struct<children:array<struct<data:struct<url:string, url_overridden_by_dest:string, selftext:string>>>>>")


def listing_posts(raw: DataFrame, col: str = "listing") -> DataFrame:
    """Posts of listing documents (A5), one row each: the address a post leads
    to (its own page, else its url) and its text; unreadable documents give none."""
    posts = raw.select(F.explode(F.from_json(F.col(col), LISTING)["data"]["children"]).alias("c")).select("c.data.*")
    url = F.coalesce(F.nullif(F.col("url_overridden_by_dest"), F.lit("")), F.col("url"), F.lit(""))
    return posts.select(url.alias("url"), F.coalesce("selftext", F.lit("")).alias("selftext"))
