"""Exact de-duplication by deterministic block naming (DataFrame functions only).

The normalised text is cut into blocks of a fixed number of bytes. Distinct
blocks are sorted into integer names; neighbouring names of a text are then
paired and the distinct pairs sorted into names again, until each text has a
single name. Two texts have the same (number of blocks, name) exactly when
they are equal.

Texts never move more than once: a block travels with its 64-bit hash in one
distinct aggregation, which shows the hashes that stand for more than one
block. Only those blocks are told apart by their bytes (a rank among the
blocks of the hash joins the sort key); every other block is sorted by its
hash alone, which is then as unique as its bytes.

Defined cases: null text counts as empty; the empty text is one empty block;
rows with the same doc_id and text are repeats, of which the first occurrence
is kept; a null doc_id is kept only if no equal text has an id. An empty
table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, documents, salted_left_join

BLOCK_BYTES = 4096
SPACES = r"[\x20\x09-\x0D]+"


def normalised(text):
    return F.regexp_replace(text, SPACES, " ")


def _blocks(df: DataFrame, block_bytes: int) -> DataFrame:
    d = documents(df).select("doc_id", normalised("text").alias("t"))
    d = d.select("doc_id", "t", F.encode("t", "UTF-8").alias("b"))
    d = d.withColumn("m", F.greatest(F.lit(1), F.ceil(F.octet_length("b") / F.lit(block_bytes))).cast("long"))
    return d.withColumn("cut", F.transform(F.sequence(F.lit(0).cast("long"), F.col("m") - 1),
                                           lambda i: F.substring(F.col("b"), (i * block_bytes + 1).cast("int"), F.lit(block_bytes))))


def _hash(block, bits: int):
    return F.xxhash64(block) if bits >= 64 else F.shiftrightunsigned(F.xxhash64(block), 64 - bits)


def _named(scratch: Scratch, keys: DataFrame, cols: list[str], label: str) -> DataFrame:
    """Sort the distinct keys over range partitions; a key's name is its place there."""
    d = keys.select(*cols).distinct().repartitionByRange(*cols).sortWithinPartitions(*cols)
    return scratch.table(d.withColumn("name", F.monotonically_increasing_id()), label)


def identities(spark: SparkSession, docs: DataFrame, block_bytes: int = BLOCK_BYTES, hash_bits: int = 64) -> DataFrame:
    """One row per (doc_id, text): text_sha256, repeats (equal rows with this id), m (blocks) and name.

    ``hash_bits`` below 64 shortens the block hash; the result stays the same.
    """
    scratch = Scratch(spark, "exact")
    cut = _blocks(docs, block_bytes)
    seq = scratch.table(
        cut.select("doc_id", F.sha2("b", 256).alias("text_sha256"), "m",
                   F.transform("cut", lambda b: _hash(b, hash_bits)).alias("hs"))
        .groupBy("doc_id", "text_sha256", "m", "hs").agg(F.count(F.lit(1)).alias("repeats")), "sequences")

    # hashes that stand for several blocks
    texts = cut.select(F.explode("cut").alias("block")).select(_hash(F.col("block"), hash_bits).alias("h"), "block")
    clash = scratch.table(texts.distinct().groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("h"), "clash")
    at = seq.select("doc_id", "text_sha256", "m", "repeats", F.posexplode("hs").alias("pos", "h"))
    if clash.isEmpty():
        at = at.withColumn("rank", F.lit(0).cast("long"))
    else:
        ranked = _named(scratch, texts.join(clash, "h", "left_semi"), ["h", "block"], "clash-blocks")
        where = cut.select("doc_id", F.sha2("b", 256).alias("text_sha256"), F.posexplode("cut").alias("pos", "block"))
        where = where.withColumn("h", _hash(F.col("block"), hash_bits)).join(ranked, ["h", "block"])
        where = where.select(F.col("doc_id").alias("_d"), F.col("text_sha256").alias("_s"), F.col("pos").alias("_p"),
                             (F.col("name") + 1).alias("rank")).distinct()
        at = (at.join(where, (F.col("doc_id").eqNullSafe(F.col("_d"))) & (F.col("text_sha256") == F.col("_s"))
                      & (F.col("pos") == F.col("_p")), "left")
              .select("doc_id", "text_sha256", "m", "repeats", "pos", "h", F.coalesce("rank", F.lit(0)).alias("rank")))

    doc = ["doc_id", "text_sha256", "m", "repeats"]
    names = _named(scratch, at, ["h", "rank"], "names-0")
    at = scratch.table(at.join(names, ["h", "rank"]).select(*doc, "pos", "name"), "level-0")
    longest = at.agg(F.max("m")).first()[0] or 1
    done = [at.filter("m = 1").select(*doc, "name")]
    left, level = longest, 0
    open_rows = at.filter("m > 1")
    while left > 1:
        level += 1
        left = -(-left // 2)
        here = F.struct("pos", "name")
        pairs = (open_rows.groupBy(*doc, F.shiftright("pos", 1).alias("half"))
                 .agg(F.min(here).alias("a"), F.max(here).alias("b"))
                 .select(*doc, F.col("half").alias("pos"), F.col("a.name").alias("a"),
                         F.when(F.col("b.pos") > F.col("a.pos"), F.col("b.name")).otherwise(F.lit(-1)).alias("b")))
        pairs = scratch.table(pairs, f"pairs-{level}")
        names = _named(scratch, pairs, ["a", "b"], f"names-{level}")
        at = scratch.table(pairs.join(names, ["a", "b"]).select(*doc, "pos", "name"), f"level-{level}")
        rest = F.ceil(F.col("m") / F.lit(1 << level))
        done.append(at.filter(rest == 1).select(*doc, "name"))
        open_rows = at.filter(rest > 1)
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def exact_groups(spark: SparkSession, docs: DataFrame, **options) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256, repeats."""
    ids = identities(spark, docs, **options)
    groups = (ids.groupBy("m", "name").agg(F.min("doc_id").alias("keep_id"), F.sum("repeats").alias("group_size"))
              .filter("group_size > 1"))
    rows = salted_left_join(ids.withColumn("_spread", F.coalesce("doc_id", F.xxhash64("text_sha256"))),
                            groups, ["m", "name"], "_spread")
    rows = rows.withColumn("occurrence", F.explode(F.sequence(F.lit(1).cast("long"), F.col("repeats"))))
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return rows.select("doc_id", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
                       (F.col("doc_id").eqNullSafe(keep) & (F.col("occurrence") == 1)).alias("kept"), "text_sha256", "repeats")


def keep_first(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``docs`` without its exact copies; all columns stay."""
    groups = exact_groups(spark, docs).filter("kept")
    kept = Scratch(spark, "exact-kept").table(
        groups.select(F.col("doc_id").alias("_xd_id"), F.col("text_sha256").alias("_xd_sha"), "repeats"), "kept")
    rows = docs.withColumn("_xd_row", F.sha2(F.encode(normalised(F.coalesce(docs["text"], F.lit(""))), "UTF-8"), 256))
    same = rows["doc_id"].cast("long").eqNullSafe(kept["_xd_id"]) & (rows["_xd_row"] == kept["_xd_sha"])
    once = rows.join(kept.filter("repeats = 1"), same, "left_semi").select(*docs.columns)
    again = kept.filter("repeats > 1")
    if again.isEmpty():
        return once
    # rows repeated whole: one of each, found per task before the shuffle
    whole = F.struct(*[rows[c] for c in docs.columns])
    one = rows.join(again, same, "left_semi").groupBy("doc_id", "_xd_row").agg(F.first(whole).alias("_xd_all"))
    return once.unionByName(one.select("_xd_all.*"))
