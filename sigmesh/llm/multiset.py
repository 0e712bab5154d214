"""Homomorphic multiset fingerprints of texts (DataFrame functions only).

A text is the multiset of its paragraphs (pieces between line feeds). Each
paragraph is hashed into a wide vector and a text's fingerprint is the sum of
its paragraphs' vectors, every lane modulo 2**32:

* 2 counts: paragraphs and features;
* 16 equality lanes, cut from eight 64-bit hashes of the paragraph's SHA-256:
  equal multisets of paragraphs have equal lanes in any order, and others
  differ but for a chance of 2**-512;
* 64 likeness lanes: each feature of the paragraph (three words in a row, words
  being the pieces between spaces; all of them where there are fewer) adds +1 or
  -1 to every lane by the bits of its 64-bit hash. The product of two texts'
  lanes estimates how many features they share.

Sums make it incremental: ``plus`` and ``minus`` insert or delete paragraphs
without the rest of the text. ``edited`` does so itself: of an edited text only
the paragraphs that went and those that came are hashed again.

``likeness`` is 2 a.b / (a.a + b.b) over the likeness lanes, at least 0: 1 for
equal fingerprints, about the shared part of the features otherwise (standard
error near 1/8 for texts that share nothing, less for near ones).

Defined cases: a null text counts as empty; the empty text is one empty
paragraph; rows of one doc_id and text are repeats and get the same result once
each; rows without doc_id come first in the order; ties of doc_id go by the
SHA-256 of id and text; a single row is its own next document; an empty table
gives an empty result. A long text is taken whole; one row of it is the largest
thing a task holds. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sigmesh.operators.order import with_rank

from .common import Scratch, documents

MASK = 0xFFFFFFFF
EQUAL_HASHES = 8
SIGN_LANES = 64
WINDOW = 3
COUNTS = 2
EQUAL_LANES = 2 * EQUAL_HASHES
_PAIR = 0x0000000100000001  # bits g and g + 32 of a hash, counted in one long without carry


def paragraphs(text: Column) -> Column:
    return F.split(text, "\n")


def _features(paragraph: Column) -> Column:
    def hashes(words: Column) -> Column:
        last = F.greatest(F.size(words) - WINDOW, F.lit(0))
        return F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(WINDOW)]))
    # a one-element array binds the words once
    return F.get(F.transform(F.array(F.split(paragraph, " ")), hashes), F.lit(0))


def part_vectors(df: DataFrame, keys: list[str], parts: str) -> DataFrame:
    """Sums of the paragraphs of each (keys, part): ``parts`` is an array of structs (part, paragraph).

    Where ``df`` is partitioned by one of ``keys``, no shuffle is needed. A paragraph
    becomes rows of one number each: its equality hashes, then its features.
    """
    # no row is empty; the outer form keeps the planner from filtering on the whole expression first
    rows = df.select(*keys, F.explode_outer(parts).alias("_p")).select(*keys, F.col("_p.part").alias("part"), F.col("_p.paragraph").alias("_t"))
    digest = F.array(F.sha2(F.encode("_t", "UTF-8"), 256))
    equal = F.get(F.transform(digest, lambda d: F.array(*[F.xxhash64(d, F.lit(k)) for k in range(EQUAL_HASHES)])), F.lit(0))
    rows = rows.select(*keys, "part", F.posexplode_outer(F.concat(equal, _features(F.col("_t")))).alias("_i", "_h"))
    feature = F.col("_i") >= EQUAL_HASHES
    sums = [F.sum((F.col("_i") == 0).cast("long")).alias("s0"), F.sum(feature.cast("long")).alias("s1")]
    for k in range(EQUAL_HASHES):
        sums += [F.sum(F.when(F.col("_i") == k, F.col("_h").bitwiseAND(F.lit(MASK))).otherwise(0)).alias(f"e{2 * k}"),
                 F.sum(F.when(F.col("_i") == k, F.shiftrightunsigned("_h", 32)).otherwise(0)).alias(f"e{2 * k + 1}")]
    sums += [F.sum(F.when(feature, F.shiftrightunsigned("_h", g).bitwiseAND(F.lit(_PAIR))).otherwise(0)).alias(f"b{g}")
             for g in range(SIGN_LANES // 2)]
    return rows.groupBy(*keys, "part").agg(*sums)


SUMS = ["s0", "s1", *[f"e{k}" for k in range(EQUAL_LANES)], *[f"b{g}" for g in range(SIGN_LANES // 2)]]


def vector(sums: dict[str, Column]) -> Column:
    """The fingerprint vector (array of long) from the sums of ``part_vectors``, lanes modulo 2**32."""
    n = sums["s1"]
    low = [2 * sums[f"b{g}"].bitwiseAND(F.lit(MASK)) - n for g in range(SIGN_LANES // 2)]
    high = [2 * F.shiftrightunsigned(sums[f"b{g}"], 32) - n for g in range(SIGN_LANES // 2)]
    lanes = [sums["s0"], n, *[sums[f"e{k}"] for k in range(EQUAL_LANES)], *low, *high]
    return F.array(*[x.bitwiseAND(F.lit(MASK)) for x in lanes])


def plus(a: Column, b: Column) -> Column:
    """Fingerprint of the paragraphs of both."""
    return F.zip_with(a, b, lambda x, y: (x + y).bitwiseAND(F.lit(MASK)))


def minus(a: Column, b: Column) -> Column:
    """Fingerprint of a's paragraphs without those of b."""
    return F.zip_with(a, b, lambda x, y: (x - y).bitwiseAND(F.lit(MASK)))


def _signs(v: Column) -> Column:
    """Likeness lanes as signed numbers."""
    return F.transform(F.slice(v, COUNTS + EQUAL_LANES + 1, SIGN_LANES),
                       lambda x: F.when(x > MASK >> 1, x - (MASK + 1)).otherwise(x).cast("double"))


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def likeness(a: Column, b: Column) -> Column:
    """0 to 1: the estimated share of features that two fingerprints have in common; 1 where they are equal."""
    x, y = _signs(a), _signs(b)
    both = _dot(x, x) + _dot(y, y)
    return F.when(a == b, F.lit(1.0)).when(both == 0, F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), 2 * _dot(x, y) / both))


def as_text(v: Column) -> Column:
    """Fingerprint as lowercase hex, eight digits a lane."""
    return F.array_join(F.transform(v, lambda x: F.lower(F.lpad(F.hex(x), 8, "0"))), "")


def _row() -> Column:
    """A row's key: its id and text, so that rows of one id never mix."""
    return F.unhex(F.sha2(F.encode(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.lit("\n"), F.col("text")), "UTF-8"), 256))


def _pieces(part: int, text: Column) -> Column:
    return F.transform(paragraphs(text), lambda p: F.struct(F.lit(part).alias("part"), p.alias("paragraph")))


def fingerprints(docs: DataFrame) -> DataFrame:
    """One row per distinct (doc_id, text): doc_id, row (its key), n_chars, vector."""
    d = documents(docs).select(_row().alias("row"), "doc_id", F.length("text").alias("n_chars"), "text").dropDuplicates(["row", "doc_id", "n_chars", "text"])
    keys = ["row", "doc_id", "n_chars"]
    sums = part_vectors(d.select(*keys, _pieces(0, F.col("text")).alias("parts")), keys, "parts")
    return sums.select("doc_id", "row", "n_chars", vector({s: F.col(s) for s in SUMS}).alias("vector"))


def edited(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Fingerprints of every row, of its edited text and of the next document.

    The edited text is the text with its last quarter of code points replaced by the
    first as many (or all) of the next row in the order of doc_id; after the last comes
    the first. One row per input row: doc_id, n_chars, edited_sha256, vector,
    edited_vector, next_vector.
    """
    scratch = Scratch(spark, "multiset")
    d = documents(docs).select(_row().alias("row"), "doc_id", "text")
    ids = d.groupBy("row", "doc_id", F.length("text").alias("n_chars")).agg(F.count(F.lit(1)).alias("repeats"))
    ranked = scratch.table(with_rank(ids, ["doc_id", "row"], "place", lambda x: scratch.table(x, "sorted")), "places")
    n, most = ranked.agg(F.count(F.lit(1)), F.max("repeats")).first()
    if not n:
        return d.select("doc_id", F.lit(0).alias("n_chars"), *[F.lit(None).cast(t).alias(c) for c, t in (
            ("edited_sha256", "string"), ("vector", "array<bigint>"), ("edited_vector", "array<bigint>"), ("next_vector", "array<bigint>"))])
    # texts move once, by row: the same exchange serves as next document and as the document itself
    texts = d.select("row", "text")
    texts = texts.dropDuplicates() if most > 1 else texts
    here = ranked.withColumn("taken", F.floor(F.col("n_chars") / 4).cast("int"))
    follows = ranked.select(F.pmod(F.col("place") - 1, F.lit(n)).alias("place"), F.col("row").alias("next_row"))
    asked = here.select("place", F.col("row").alias("for_row"), "taken").join(follows, "place").select(F.col("next_row").alias("row"), "for_row", "taken")
    heads = texts.join(asked, "row").select(F.col("for_row").alias("row"), F.substring("text", F.lit(1), F.col("taken")).alias("came"))
    rows = texts.join(here, "row").join(heads, "row")

    stays = F.col("n_chars") - F.col("taken")
    rows = rows.withColumn("head", F.left("text", stays)).withColumn("stub", F.substring_index("head", "\n", -1))
    ends = F.length("head") - F.length("stub") - 1  # where the paragraphs end that the edit leaves as they are
    kept = F.when(ends >= 0, _pieces(0, F.left("head", ends))).otherwise(F.array().cast("array<struct<part:int,paragraph:string>>"))
    went = _pieces(1, F.concat("stub", F.substring("text", stays + 1, F.col("taken"))))
    came = _pieces(2, F.concat("stub", "came"))
    keys = ["row", "place", "doc_id", "n_chars", "repeats", "edited"]
    rows = rows.select("row", "place", "doc_id", "n_chars", "repeats",
                       F.unhex(F.sha2(F.encode(F.concat("head", "came"), "UTF-8"), 256)).alias("edited"),
                       F.concat(kept, went, came).alias("parts"))
    parts = part_vectors(rows, keys, "parts").select(*keys, F.struct("part", vector({s: F.col(s) for s in SUMS}).alias("v")).alias("p"))
    both = parts.groupBy(*keys).agg(F.collect_list("p").alias("ps"))  # three parts at most

    def total(but: int) -> Column:
        vs = F.transform(F.filter("ps", lambda p: p["part"] != but), lambda p: p["v"])
        return F.aggregate(F.slice(vs, 2, 2), F.get(vs, F.lit(0)), plus)

    both = scratch.table(both.select("place", "doc_id", "n_chars", "repeats", F.lower(F.hex("edited")).alias("edited_sha256"),
                                     total(2).alias("vector"), total(1).alias("edited_vector")), "vectors")
    after = both.select(F.pmod(F.col("place") - 1, F.lit(n)).alias("place"), F.col("vector").alias("next_vector"))
    out = both.join(after, "place")
    if most > 1:
        out = out.withColumn("_k", F.explode(F.sequence(F.lit(1).cast("long"), F.col("repeats"))))
    return out.select("doc_id", "n_chars", "edited_sha256", "vector", "edited_vector", "next_vector")
