"""The numbered queries over the given tables, with their SQL where SQL can say it."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (centroids, exact_dedup, html_main, huffman, license_scan, line_dedup, mixing, multiset, near_dedup, packing, quality, spelling,
               toxicity)


def _tokenizer(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def domains_of(labels: DataFrame) -> DataFrame:
    """Domains of the labelled table: toxic, junk (low quality) or good."""
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "junk").when(F.col("quality") == 1, "good")
    return labels.select("doc_id", domain.alias("domain"))


TARGETS = {"good": 0.90, "junk": 0.06, "toxic": 0.04}


def op1_huffman_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = huffman.write_tokens(spark, _table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.json"), 2)
    return huffman.read_tokens(spark, path)


def op2_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixing.mixture(spark, _table(spark, sf_dir, "documents"), domains_of(_table(spark, sf_dir, "labels")), TARGETS)
    share = [F.coalesce(F.col("p")[d], F.lit(0.0)).alias(f"p_{d}") for d in TARGETS]
    return rows.select("doc_id", "n_tokens", *share, "rate", "copies")


def op3_template_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = html_main.main_text(spark, _table(spark, sf_dir, "pages"))
    return text.withColumn("n_chars", F.length("text").cast("long"))


def op4_tournament_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(spark, _table(spark, sf_dir, "documents"), _tokenizer("word_bpe_49k.json"), 1)


def op5_odd_sketch_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(spark, _table(spark, sf_dir, "documents"))


def op6_rule_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality.verdicts(quality.ledger(spark, _table(spark, sf_dir, "documents")))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "failed")


def op7_block_naming(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(spark, _table(spark, sf_dir, "documents")).drop("repeats")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = line_dedup.drop_repeated_lines(spark, _table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_lines", "n_dropped", F.sha2(F.encode("kept_text", "UTF-8"), 256).alias("kept_sha256"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_matches(spark, _table(spark, sf_dir, "documents"))


def op10_cnn_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return toxicity.score(spark, docs, toxicity.fit(docs, _table(spark, sf_dir, "labels")))


def op11_multiset_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = multiset.edited(spark, _table(spark, sf_dir, "documents"))
    return rows.select("doc_id", F.col("n_chars").cast("long").alias("n_chars"), "edited_sha256",
                       multiset.as_text(F.col("vector")).alias("fingerprint"),
                       multiset.as_text(F.col("edited_vector")).alias("edited_fingerprint"),
                       multiset.likeness(F.col("vector"), F.col("edited_vector")).alias("near_edited"),
                       multiset.likeness(F.col("vector"), F.col("next_vector")).alias("near_next"))


def op12_spelling_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spark, _table(spark, sf_dir, "documents"))


def op13_hilbert_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.clusters(spark, _table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (op1_huffman_tokens, op2_soft_mixing, op3_template_removal, op4_tournament_packing, op5_odd_sketch_dedup,
                                   op6_rule_ledger, op7_block_naming, op8_line_dedup, op9_license_scan, op10_cnn_toxicity,
                                   op11_multiset_hash, op12_spelling_tiles, op13_hilbert_centroids)}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SPACE_CHARS = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

SQL = {
    "op7_block_naming": r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM n WINDOW w AS (PARTITION BY t)""",
    "op8_line_dedup": f"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
k AS (SELECT *, translate(trim(line, {_SPACE_CHARS}), '{_UPPER}', '{_LOWER}') AS key FROM l),
often AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
j AS (SELECT k.doc_id, k.pos, k.line, (o.key IS NOT NULL AND o.keeper <> k.doc_id) AS gone FROM k LEFT JOIN often o ON k.key = o.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id""",
}
