"""Near-duplicate documents: MinHash bands, odd sketches, exact check.

A document's set holds the 64-bit hashes of its distinct 3-word shingles (of
the whole word sequence if it is shorter). Documents with the same set are
one representative. ``BANDS`` bands of ``ROWS`` MinHash values find candidate
pairs: a pair at the threshold of 0.85 shares no band with a chance of about
1.4e-7 ((1 - 0.85 ** ROWS) ** BANDS). The MinHash samples are also folded into an odd sketch, a bitmap of
the parity of hashed samples; the population count of the XOR of two
sketches estimates the similarity, and pairs estimated far below the
threshold (over six standard deviations) go no further. What is left is
checked on the full sets.

No group is ever expanded into all its pairs:
* first every member of a bucket is paired with the bucket's smallest member.
  Of a document's pairs the one with the closest sketch is checked on the full
  texts, and the links found are joined into components; then the other pairs,
  as far as they still lie across components;
* then only buckets that still hold several components are looked at, and
  only pairs across components. Members of a bucket's largest component meet
  the others block against block (``BLOCK`` rows at most on a side) inside a
  task, which returns the pairs whose sketches are close. Here a sharper
  sketch of more samples decides, made only for the members of such buckets.
Within a component no further link can change the result, so nothing is lost.

Defined cases: null or empty texts, or texts of white space only, have no
shingles and link with nothing; rows of the same doc_id are one node, linked
by any of their texts; rows with a null id are compared with no other; an
empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sigmesh.operators.components import component_labels

from . import textkit
from .common import Scratch, documents, salted_left_join

SHINGLE = 3
PER_CENT = 85  # link when 100 * intersection >= PER_CENT * union
BANDS, ROWS = 72, 10
SKETCH_BITS = 1024
DEVIATIONS = 6.5
#: Samples, bits and deviations of the sharper sketch for pairs inside open buckets.
WIDE_SAMPLES, WIDE_BITS, WIDE_DEVIATIONS = 4608, 8192, 5.5
BLOCK = 1024

_SAMPLES = BANDS * ROWS
_RNG = np.random.default_rng(20240229)
_MUL = (_RNG.integers(0, 1 << 31, WIDE_SAMPLES, dtype=np.uint64) * 2 + 1).astype(np.uint32)
_ADD = _RNG.integers(0, 1 << 32, WIDE_SAMPLES, dtype=np.uint64).astype(np.uint32)


def shingle_sets(chunk: textkit.Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of every text of a chunk, and where each text's begin."""
    starts, ends, first = chunk.words()
    h = chunk.spans(chunk.sums(textkit.LOWER), starts, ends)
    counts = np.diff(first)
    pos, begin = textkit.windows(first, SHINGLE)
    grams = textkit.combine(h, pos, SHINGLE)
    short = np.flatnonzero((counts > 0) & (counts < SHINGLE))
    sizes = np.diff(begin)
    sizes[short] = 1
    off = np.concatenate([[0], np.cumsum(sizes)])
    out = np.empty(off[-1], dtype=np.uint64)
    own = np.ones(len(out), dtype=bool)
    own[off[short]] = False
    out[own] = grams
    for k in range(1, SHINGLE):
        of = short[counts[short] == k]
        out[off[of]] = textkit.combine(h, first[of], k)
    for a, b in zip(off[:-1], off[1:]):
        out[a:b].sort()
    new = np.ones(len(out), dtype=bool)
    new[1:] = out[1:] != out[:-1]
    new[off[:-1][sizes > 0]] = True
    kept = np.concatenate([[0], np.cumsum(new)])
    return out[new], kept[off]


def min_hashes(sets: np.ndarray, at: np.ndarray, samples: int) -> np.ndarray:
    """MinHash values (texts x samples) of the sets that begin at ``at``."""
    h = (sets >> np.uint64(32)).astype(np.uint32)
    low = np.empty((len(at), samples), dtype=np.uint32)
    x = np.empty_like(h)
    for i in range(samples):
        np.multiply(h, _MUL[i], out=x)
        np.add(x, _ADD[i], out=x)
        low[:, i] = np.minimum.reduceat(x, at)
    return low


def odd_sketches(low: np.ndarray, bits: int) -> np.ndarray:
    """Parity bitmaps (as 64-bit words) of the hashed samples of every text."""
    n, samples = low.shape
    bit = textkit.mix(low.astype(np.uint64) + (np.arange(samples, dtype=np.uint64) << np.uint64(32)), 5) & np.uint64(bits - 1)
    flat = (np.arange(n)[:, None] * bits + bit.astype(np.int64)).reshape(-1)
    odd = np.bincount(flat, minlength=n * bits).reshape(n, bits) & 1
    return np.packbits(odd.astype(np.uint8), axis=1).view("<i8")


def signatures(sets: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For texts with shingles: two sums that name the set, the sketch (as 64-bit words) and the band keys."""
    full = np.flatnonzero(np.diff(off))
    at = off[:-1][full]
    k1 = np.add.reduceat(textkit.mix(sets, 11), at)
    k2 = np.add.reduceat(textkit.mix(sets, 12), at)
    low = min_hashes(sets, at, _SAMPLES)
    sketch = odd_sketches(low, SKETCH_BITS)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (len(full), BANDS)).copy()
    for r in range(ROWS):
        key = textkit.mix(key ^ low[:, r::ROWS].astype(np.uint64), r + 1)
    return k1.view(np.int64), k2.view(np.int64), sketch, key.view(np.int64)


def largest_difference(per_cent: int = PER_CENT, samples: int = _SAMPLES, bits: int = SKETCH_BITS, deviations: float = DEVIATIONS) -> int:
    """Sketch bits that two sets at the threshold differ in at most, ``deviations`` standard deviations out.

    Samples that differ: 2 samples (1 - J) on average, binomial. Bits that differ: the parities of so many
    balls thrown into ``bits`` bins.
    """
    j = per_cent / 100
    far = 2 * samples * (1 - j)
    keep = np.exp(-2 * far / bits)
    mean = bits / 2 * (1 - keep)
    of_samples = 2 * np.sqrt(samples * j * (1 - j)) * keep
    of_bits = np.sqrt(max(0.0, bits / 4 * (1 - keep ** 2) - far * keep ** 2))
    return int(np.ceil(mean + deviations * np.hypot(of_samples, of_bits)))


def _list_array(rows: np.ndarray) -> pa.Array:
    n, w = rows.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(0, (n + 1) * w, w, dtype=np.int32)), pa.array(rows.reshape(-1)))


_SIGNED = "doc_id long, n_shingles long, k1 long, k2 long, sketch array<long>, bands array<long>"


def _sign_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for c in textkit.chunks(b.column("text"), 1 << 20):
            sets, off = shingle_sets(c)
            sizes = np.diff(off)
            n = len(sizes)
            k1, k2 = np.zeros(n, np.int64), np.zeros(n, np.int64)
            sketch, bands = np.zeros((n, SKETCH_BITS // 64), np.int64), np.zeros((n, BANDS), np.int64)
            full = sizes > 0
            if full.any():
                k1[full], k2[full], sketch[full], bands[full] = signatures(sets, off)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").slice(c.lo, n), pa.array(sizes.astype(np.int64)), pa.array(k1), pa.array(k2), _list_array(sketch), _list_array(bands)],
                names=["doc_id", "n_shingles", "k1", "k2", "sketch", "bands"])


def _wide_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Both sketches of every text, for the comparison inside open buckets."""
    for b in batches:
        for c in textkit.chunks(b.column("text"), 1 << 18):
            sets, off = shingle_sets(c)
            full = np.flatnonzero(np.diff(off))
            low = min_hashes(sets, off[:-1][full], WIDE_SAMPLES)
            both = [odd_sketches(low[:, :_SAMPLES], SKETCH_BITS), odd_sketches(low, WIDE_BITS)]
            ids = b.column("doc_id").slice(c.lo, c.hi - c.lo).take(pa.array(full))
            yield pa.RecordBatch.from_arrays([ids, pa.array(np.diff(off)[full].astype(np.int64)), *[pa.array([r.tobytes() for r in x], pa.binary()) for x in both]],
                                             names=["doc_id", "n_shingles", "sketch", "wide"])


def _sets_of(col: pa.Array) -> list[np.ndarray]:
    out = []
    for c in textkit.chunks(col):
        sets, off = shingle_sets(c)
        out += [sets[a:b] for a, b in zip(off[:-1], off[1:])]
    return out


def _linked_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of texts whose full sets are similar enough."""
    for whole in batches:
        for lo in range(0, whole.num_rows, 64):
            b = whole.slice(lo, 64)
            good = np.zeros(b.num_rows, dtype=bool)
            for i, (x, y) in enumerate(zip(_sets_of(b.column("text_a")), _sets_of(b.column("text_b")))):
                both = len(x) + len(y) - len(np.union1d(x, y))
                good[i] = both > 0 and 100 * both >= PER_CENT * (len(x) + len(y) - both)
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b")], names=["a", "b"]).filter(pa.array(good))


def _confirmed(scratch: Scratch, pairs: DataFrame, texts: DataFrame, label: str) -> tuple[DataFrame, DataFrame]:
    """The candidate pairs (a, b) as a table, and those that hold on their texts' full sets."""
    pairs = scratch.table(pairs, f"pairs-{label}")
    ta = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    tb = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    # both sides grow with the input: one way to join them at every size
    rows = pairs.hint("merge").join(ta, "a").hint("merge").join(tb, "b").select("a", "b", "text_a", "text_b")
    return pairs, scratch.table(rows.mapInArrow(_linked_batches, "a long, b long"), f"links-{label}")


def _differ(s_a, s_b):
    """Bits in which two sketches differ."""
    return F.aggregate(F.zip_with(s_a, s_b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda t, x: t + x)


def _of_components(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs (a, b) whose ends are in different components."""
    of = labels.select(F.col("node"), F.col("component"))
    j = (pairs.join(of.select(F.col("node").alias("a"), F.col("component").alias("_a")), "a", "left")
         .join(of.select(F.col("node").alias("b"), F.col("component").alias("_b")), "b", "left"))
    return j.filter(F.coalesce("_a", "a") != F.coalesce("_b", "b")).select("a", "b")


def _block_pairs(pdf: pd.DataFrame) -> pd.DataFrame:
    """Pairs across components between two sides of a bucket's block whose sizes and sketches are close."""
    out_a, out_b = [], []
    limit, wide_limit = largest_difference(), largest_difference(PER_CENT, WIDE_SAMPLES, WIDE_BITS, WIDE_DEVIATIONS)
    sk, wide = (np.frombuffer(b"".join(pdf[c]), dtype="<u8").reshape(len(pdf), -1) for c in ("sketch", "wide"))
    ids, comp, n = pdf["doc_id"].to_numpy(), pdf["component"].to_numpy(), pdf["n_shingles"].to_numpy()
    left, right = pdf["is_left"].to_numpy(), pdf["is_right"].to_numpy()
    r = np.flatnonzero(right)
    for i in np.flatnonzero(left):
        at = r[(comp[r] != comp[i]) & (100 * np.minimum(n[r], n[i]) >= PER_CENT * np.maximum(n[r], n[i]))]
        if len(at):
            at = at[np.bitwise_count(sk[at] ^ sk[i]).sum(axis=1) <= limit]
            at = at[np.bitwise_count(wide[at] ^ wide[i]).sum(axis=1) <= wide_limit]
            out_a.append(np.minimum(ids[at], ids[i]))
            out_b.append(np.maximum(ids[at], ids[i]))
    a = np.concatenate(out_a) if out_a else np.zeros(0, np.int64)
    b = np.concatenate(out_b) if out_b else np.zeros(0, np.int64)
    return pd.DataFrame({"a": a, "b": b}).drop_duplicates()


def _across(scratch: Scratch, buckets: DataFrame, labels: DataFrame, texts: DataFrame) -> DataFrame | None:
    """Candidate pairs across components in buckets that hold several, or None if there are none."""
    of = labels.select(F.col("node").alias("doc_id"), "component")
    rows = scratch.table(buckets.join(of, "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id")), "bucket-components")
    counts = rows.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"))
    per_key = (counts.groupBy("key").agg(F.count(F.lit(1)).alias("components"), F.sum("n").alias("members"),
                                         F.max(F.struct("n", "component")).alias("top"))
               # of two members, one is the smallest and has met the other
               .filter("components > 1 and members > 2")
               .select("key", F.col("top.component").alias("main"),
                       F.greatest(F.lit(1), F.ceil(F.col("top.n") / F.lit(BLOCK))).cast("int").alias("main_blocks"),
                       F.greatest(F.lit(1), F.ceil((F.col("members") - F.col("top.n")) / F.lit(BLOCK))).cast("int").alias("rest_blocks")))
    per_key = scratch.table(per_key, "open-buckets")
    if per_key.isEmpty():
        return None
    rows = salted_left_join(rows, per_key, ["key"], "doc_id").filter(F.col("main").isNotNull())
    # rest blocks meet main blocks (numbered after them) and each other
    is_main = F.col("component") == F.col("main")
    h = F.xxhash64("doc_id", "key")
    block = F.when(is_main, F.col("rest_blocks") + F.pmod(h, F.col("main_blocks"))).otherwise(F.pmod(h, F.col("rest_blocks"))).cast("int")
    rows = rows.select("key", "doc_id", "component", "rest_blocks", "main_blocks", is_main.alias("is_main"), block.alias("block"))
    rest = F.sequence(F.lit(0), F.col("rest_blocks") - 1)
    all_blocks = F.sequence(F.lit(0), F.col("rest_blocks") + F.col("main_blocks") - 1)
    meets = F.when(F.col("is_main"), F.transform(rest, lambda i: F.struct(i.alias("i"), F.col("block").alias("j")))) \
        .otherwise(F.transform(all_blocks, lambda j: F.struct(F.least(F.col("block"), j).alias("i"), F.greatest(F.col("block"), j).alias("j"))))
    rows = rows.withColumn("m", F.explode(meets)).select("key", "doc_id", "component", "m.i", "m.j", "block")
    rows = scratch.table(rows, "block-rows")
    n_rows = rows.count()
    open_texts = texts.join(rows.select("doc_id").distinct().hint("merge"), "doc_id", "left_semi")
    sketches = scratch.table(open_texts.mapInArrow(_wide_batches, "doc_id long, n_shingles long, sketch binary, wide binary"), "sketches")
    rows = rows.join(sketches, "doc_id")
    rows = rows.select("key", "i", "j", "doc_id", "component", "n_shingles", "sketch", "wide",
                       (F.col("block") == F.col("i")).alias("is_left"), (F.col("block") == F.col("j")).alias("is_right"))
    # a number of its own: the rows are few but dear, and would be coalesced by their size
    parts = max(int(scratch.spark.conf.get("spark.sql.shuffle.partitions")), -(-n_rows // (2 * BLOCK)))
    rows = rows.repartition(parts, "key", "i", "j")
    return rows.groupBy("key", "i", "j").applyInPandas(_block_pairs, "a long, b long").distinct()


def near_duplicates(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept."""
    scratch = Scratch(spark, "near")
    texts = documents(docs)
    signed = scratch.table(texts.mapInArrow(_sign_batches, _SIGNED), "signatures")
    sets = scratch.table(signed.select("doc_id", "n_shingles", "k1", "k2"), "set-names")
    with_set = sets.filter("n_shingles > 0 and doc_id is not null")
    same = with_set.groupBy("n_shingles", "k1", "k2").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    same = scratch.table(same, "sets")
    first = same.select(F.col("rep").alias("doc_id"), "n_shingles", "k1", "k2")
    reps = scratch.table(signed.join(first, ["doc_id", "n_shingles", "k1", "k2"], "left_semi")
                         .select("doc_id", "n_shingles", "sketch", "bands"), "representatives")
    scratch.drop(signed)
    keys = reps.select("doc_id", F.explode("bands").alias("key"))
    shared = (keys.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("least"))
              .filter("n > 1").select("key", "least"))
    buckets = scratch.table(salted_left_join(keys, shared, ["key"], "doc_id", 4).filter(F.col("least").isNotNull()), "buckets")

    # the texts of all documents that share a bucket, once: every later step reads these alone
    texts = scratch.table(texts.join(buckets.select("doc_id").distinct().hint("merge"), "doc_id", "left_semi"), "texts")
    info = reps.select("doc_id", "n_shingles", "sketch")
    star = buckets.filter("doc_id != least").select(F.col("least").alias("a"), F.col("doc_id").alias("b")).distinct()
    ia = info.select(F.col("doc_id").alias("a"), F.col("n_shingles").alias("n_a"), F.col("sketch").alias("s_a"))
    ib = info.select(F.col("doc_id").alias("b"), F.col("n_shingles").alias("n_b"), F.col("sketch").alias("s_b"))
    near = star.join(ia, "a").join(ib, "b").filter(100 * F.least("n_a", "n_b") >= PER_CENT * F.greatest("n_a", "n_b"))
    near = near.withColumn("differ", _differ(F.col("s_a"), F.col("s_b"))).filter(F.col("differ") <= largest_difference())
    met = scratch.table(near.select("a", "b", "differ"), "near")
    closest = met.groupBy("b").agg(F.min(F.struct("differ", "a")).alias("m")).select(F.col("m.a").alias("a"), "b")
    seen, links = _confirmed(scratch, closest, texts, "closest")
    labels = component_labels(links, "a", "b")
    rest = _of_components(met.select("a", "b").join(seen, ["a", "b"], "left_anti"), labels)
    _, found = _confirmed(scratch, rest, texts, "star")
    links = links.unionByName(found)
    labels = component_labels(links, "a", "b")
    more = _across(scratch, buckets.select("doc_id", "key"), labels, texts)
    if more is not None:
        _, found = _confirmed(scratch, more.join(met.select("a", "b"), ["a", "b"], "left_anti"), texts, "across")
        labels = component_labels(links.unionByName(found), "a", "b")
    labels = scratch.table(labels.select(F.col("node").alias("rep"), "component"), "labels")

    of = same.filter("copies > 1").select("n_shingles", "k1", "k2", "rep")
    rows = salted_left_join(sets, of, ["n_shingles", "k1", "k2"], "doc_id")
    rows = rows.withColumn("rep", F.when(F.col("n_shingles") > 0, F.coalesce("rep", "doc_id")))
    rows = rows.join(labels, "rep", "left")
    component = F.coalesce("component", "rep", "doc_id")
    return rows.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def keep_one(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``docs`` with one document of every component; all columns stay."""
    kept = near_duplicates(spark, docs).filter("kept").select(F.col("doc_id").alias("_nd_id")).distinct()
    return docs.join(kept, docs["doc_id"].cast("long").eqNullSafe(kept["_nd_id"]), "left_semi")
