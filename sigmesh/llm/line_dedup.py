"""Line de-duplication (DataFrame functions only).

Lines are exploded with a 128-bit hash of their key (the line stripped of
ASCII white space at both ends, A-Z lower-cased). Documents are counted per
hash; a hash in ``min_docs`` documents or more loses its lines everywhere but
in the document with the largest doc_id. The positions to drop come back to
their document, whose text is cut around them in one pass.

Defined cases: a null or empty text is one empty line; keys shorter than
``min_chars`` code points never count; documents are counted by their doc_id, so
rows of one id count once, whatever their texts, and rows without an id don't
count; the largest id keeps its lines in all of its rows, rows without an id
lose theirs; an empty table gives an empty result. A long text is split whole
inside one row. Other columns are not read.
"""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, documents, salted_left_join

MIN_CHARS = 20
MIN_DOCS = 3
ASCII_SPACE = " \t\n\x0b\x0c\r"


def line_key(line):
    return F.translate(F.btrim(line, F.lit(ASCII_SPACE)), string.ascii_uppercase, string.ascii_lowercase)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """One row per input row: doc_id, kept_text, n_lines, n_dropped."""
    scratch = Scratch(spark, "lines")
    d = documents(docs)
    # a row's key: its id and text, so that rows of one id never mix
    d = d.withColumn("row", F.unhex(F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.lit("\0"), F.col("text")))))
    lines = d.select("doc_id", "row", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    lines = lines.select("doc_id", "row", "pos", line_key(F.col("line")).alias("key")).filter(F.length("key") >= min_chars)
    lines = lines.select("doc_id", "row", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"))
    at = scratch.table(lines.groupBy("row", "doc_id", "h1", "h2").agg(F.collect_set("pos").alias("at")), "lines")
    often = (at.groupBy("h1", "h2").agg(F.count_distinct("doc_id").alias("docs"), F.max("doc_id").alias("keeper"))
             .filter(F.col("docs") >= min_docs).select("h1", "h2", "keeper", F.lit(True).alias("often")))
    hit = salted_left_join(at, often, ["h1", "h2"], "row").filter(F.col("often") & ~F.col("doc_id").eqNullSafe(F.col("keeper")))
    drops = hit.groupBy("row").agg(F.array_sort(F.flatten(F.collect_list("at"))).alias("drop"))

    joined = d.join(drops, "row", "left")
    lines = F.split("text", "\n")
    edge = F.concat(F.array(F.lit(-1)), F.col("drop"), F.array(F.size(lines)))
    joined = joined.select("doc_id", "text", lines.alias("lines"), F.coalesce(F.size("drop"), F.lit(0)).alias("n_drop"),
                           F.when(F.col("drop").isNotNull(), edge).alias("edge"))
    parts = F.transform(F.sequence(F.lit(1), F.size("edge") - 1),
                        lambda j: F.slice(F.col("lines"), F.element_at("edge", j) + 2,
                                          F.element_at("edge", j + 1) - F.element_at("edge", j) - 1))
    kept = F.when(F.col("edge").isNull(), F.col("text")).otherwise(F.array_join(F.flatten(parts), "\n"))
    return joined.select("doc_id", kept.alias("kept_text"), F.size("lines").cast("long").alias("n_lines"),
                         F.when(F.col("n_drop") > 0, F.col("n_drop")).otherwise(0).cast("long").alias("n_dropped"))
