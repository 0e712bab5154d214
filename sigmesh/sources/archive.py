"""Page archives (A1): WARC records as text files.

Reading needs no parser of its own: records are split at their version line by
Spark's text source, so one large archive is read by many tasks and a compressed
one by one task a file. Header fields and body are expressions; the filters
(response record, HTML type, http address, length of the body) stand on them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

VERSION = "WARC/1.0"
_EDGE = VERSION + "\r\n"
_BLANK = "\r\n\r\n"


def _header(name: str) -> Column:
    """A field of the record's own header (names in any case), or null."""
    found = F.regexp_extract(F.col("head"), rf"(?im)^{name}:[ \t]*([^\r\n]*)", 1)
    return F.when(found != "", F.trim(found))


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """All records of the archives under ``path``: record_type, url, date, http_status, content_type, body."""
    # a stray line "WARC/1.0" inside a body would cut it; the blank second line of a cut piece tells
    raw = spark.read.option("lineSep", _EDGE).text(path).select(F.col("value").alias("record"))
    raw = raw.filter(F.col("record").rlike(r"(?i)\AWARC-|\r\nWARC-"))
    at = F.instr("record", _BLANK)
    parts = raw.select(F.when(at > 0, F.left("record", at - 1)).otherwise(F.col("record")).alias("head"),
                       F.when(at > 0, F.substring("record", at + len(_BLANK), F.length("record"))).otherwise(F.lit("")).alias("rest"))
    parts = parts.select(_header("WARC-Type").alias("record_type"), _header("WARC-Target-URI").alias("url"), _header("WARC-Date").alias("date"),
                         F.regexp_replace("rest", r"\r\n\r\n\z", "").alias("rest"))
    # a response carries an HTTP message: its status line and fields come before the body
    http = F.col("rest").startswith("HTTP/")
    cut = F.instr("rest", _BLANK)
    message = parts.select("record_type", "url", "date",
                           F.when(http & (cut > 0), F.left("rest", cut - 1)).when(http, F.col("rest")).otherwise(F.lit("")).alias("head"),
                           F.when(http & (cut > 0), F.substring("rest", cut + len(_BLANK), F.length("rest"))).when(http, F.lit("")).otherwise(F.col("rest")).alias("body"))
    status = F.regexp_extract("head", r"\AHTTP/\S+ (\d{3})", 1)
    return message.select("record_type", "url", "date", F.when(status != "", status.cast("int")).alias("http_status"),
                          _header("Content-Type").alias("content_type"), "body")


def read_pages_archive(spark: SparkSession, path: str, min_body: int = 100, limit: int | None = None) -> DataFrame:
    """HTML pages of an archive (A1): url, html. ``limit`` stops after that many (the source's own early stop)."""
    rows = read_archive(spark, path)
    rows = rows.filter((F.col("record_type") == "response") & F.lower("content_type").contains("text/html")
                       & F.col("url").startswith("http") & (F.length("body") >= min_body))
    rows = rows.select("url", F.col("body").alias("html"))
    return rows if limit is None else rows.limit(limit)


def write_archive(pages: DataFrame, path: str, date: str = "2024-12-15T03:47:00Z", compression: str = "none") -> None:
    """Pages (url, html, and optionally record_type, content_type) as archive files."""
    kind = F.col("record_type") if "record_type" in pages.columns else F.lit("response")
    mime = F.col("content_type") if "content_type" in pages.columns else F.lit("text/html; charset=utf-8")
    html = F.coalesce(F.col("html"), F.lit(""))
    message = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: "), mime, F.lit("\r\nContent-Length: "), F.octet_length(html).cast("string"), F.lit(_BLANK), html)
    record = F.concat(F.lit("WARC-Type: "), kind, F.lit("\r\nWARC-Target-URI: "), F.coalesce(F.col("url"), F.lit("")), F.lit(f"\r\nWARC-Date: {date}\r\nContent-Length: "),
                      F.octet_length(message).cast("string"), F.lit(_BLANK), message, F.lit("\r\n\r"))
    # the writer's line feed completes the blank line that ends a record
    pages.select(F.concat(F.lit(_EDGE), record).alias("value")).write.mode("overwrite").option("lineSep", "\n").option("compression", compression).text(path)
