"""Content-similarity signal.

Exact mode
    Vectors are unit-normalised and hashed into ``num_blocks`` blocks.  Each
    row is sent to the B block pairs it belongs to; one tile (``applyInArrow``)
    per block pair multiplies the two blocks and emits
    only (a) pairs at or above the edge threshold, where they are asked for,
    and (b) per-domain partial
    statistics (sum, count, max of effective similarity, count over the pair
    threshold).  All-pairs scores never leave the task, and per-domain
    statistics are finished by a partial aggregation on ``domain``.  Work is
    quadratic by definition of the exact rule. A tile holds its vectors
    (2 × block rows) and matrices of ``STEP_CELLS`` comparisons; pairs leave it
    in batches, so its memory depends neither on the rows nor on the pairs.

LSH mode (scale)
    ``BucketedRandomProjectionLSH`` on unit vectors: cos >= t ⇔ L2 <= sqrt(2−2t).
    Vectors meet in tiles of boxes, with their bucket numbers; candidate pairs
    are re-checked exactly.  Recall is probabilistic; the
    average uses the linear-time identity below, not pairs.

Linear-time average (R2)
    Σ_j x̂_i·x̂_j = x̂_i·Σ_j x̂_j, so the plain average over all other domains
    needs one vector sum, not pairs.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Settings
from ..functions.domains import author_norm, is_authority
from ..functions.text import is_syndicated, nav_phrase_flags
from ..functions.vectors import unit
from ..session import ship_package, stored
from .boxes import SAMPLE_ROWS, Boxed, dealt, directions, grown, most, parts
from .skew import one_row_join, salted_join

# Rows of one block of the exact pass: a task multiplies two blocks, and every
# vector is sent to as many block pairs as there are blocks. Up to FEW_BLOCKS
# blocks have BLOCK_ROWS rows; then they grow up to MOST_BLOCK_ROWS, so that
# copies grow with the rows for long.
BLOCK_ROWS = 2048
FEW_BLOCKS = 16
MOST_BLOCK_ROWS = 32_768
#: Comparisons of one step of a tile, and pairs of one batch that leaves it.
STEP_CELLS = 1 << 19
BATCH_PAIRS = 1 << 16
#: Pairs whose vectors are multiplied again at a time.
PAIR_STEP = 1 << 13
#: Blocks of LSH pairs: so many at first, then so many rows each (a tile has them once, as they came).
FEW_BOXES, MOST_BOX_ROWS = 8, 65_536
#: Rows of a box inside a tile of LSH pairs, and rows of a step over a tile's rows.
LEAF_ROWS, STEP_ROWS = 256, 4096
#: Products of a pair of boxes of which one reaches the threshold, from which on all are taken again at once.
MANY = 80
#: Tiles of one shuffle that get a partition of their own.
MAX_TILE_PARTITIONS = 4096

BLOCK_OUT = ("kind string, domain_a string, domain_b string, raw double, eff double, "
             "n long, sum_eff double, max_eff double, n_over long")


def prepare_vectors(vecs: DataFrame, cfg: Settings, text_col: str = "text") -> DataFrame:
    """domain, parent, u (unit vector), auth, synd."""
    return vecs.select(
        "domain", "parent", unit("embedding").alias("u"),
        is_authority("domain").alias("auth"),
        (is_syndicated(text_col, cfg.excerpt_chars) if text_col in vecs.columns
         else F.lit(False)).alias("synd"))


_PRODUCT = pa.schema([("kind", pa.string()), ("domain_a", pa.string()), ("domain_b", pa.string()), ("raw", pa.float64()), ("eff", pa.float64()),
                      ("n", pa.int64()), ("sum_eff", pa.float64()), ("max_eff", pa.float64()), ("n_over", pa.int64())])


def _products(kind: str, a: pa.Array, **columns) -> pa.RecordBatch:
    """Rows of one kind; columns that are not given are null, ``n`` and ``n_over`` 0."""
    none = {"n": np.zeros(len(a), np.int64), "n_over": np.zeros(len(a), np.int64)}
    values = {"kind": pa.array([kind] * len(a), pa.string()), "domain_a": a, **none, **columns}
    return pa.RecordBatch.from_arrays([pa.array(values[f.name], f.type) if f.name in values else pa.nulls(len(a), f.type) for f in _PRODUCT], schema=_PRODUCT)


def matrix_of(column: pa.ChunkedArray) -> np.ndarray:
    """A column of equally long number lists as a matrix."""
    flat = pc.list_flatten(column).to_numpy()
    return flat.astype(np.float64, copy=False).reshape(len(column), -1)


class Side:
    """The rows of one side of a tile, as arrays; ``site`` numbers the parents (null is one too)."""

    def __init__(self, rows: pa.Table, site: np.ndarray):
        self.name = rows["domain"].combine_chunks()
        self.u = matrix_of(rows["u"])
        self.site = site
        self.auth, self.synd = (rows[c].to_numpy().astype(bool) for c in ("auth", "synd"))

    def __len__(self) -> int:
        return len(self.name)


def sides(rows: pa.Table, *masks) -> list[Side]:
    """One side per mask over the rows; rows without a vector have nothing to compare."""
    there = pc.is_valid(rows["u"])
    codes = pc.dictionary_encode(rows["parent"].combine_chunks())
    site = pc.fill_null(codes.indices, len(codes.dictionary)).to_numpy()
    out = []
    for m in masks:
        m = pc.fill_null(pc.and_(m, there), False)
        out.append(Side(rows.filter(m), site[m.to_numpy()]))
    return out


def tile_products(left: Side, right: Side, cfg: Settings, floor: float, plain: bool = False, top_k: int = 0, one_way: bool = False,
                  pairs: bool = True, sums: bool = True) -> Iterator[pa.RecordBatch]:
    """'part', 'pair' and 'top' rows of all comparisons of two sides (a side with itself: the same object twice).

    ``one_way``: parts for the left side alone, and pairs only where its name is the smaller one.
    """
    itself = left is right
    if not len(left) or not len(right):
        return
    discounts = not plain and bool(left.auth.any() or right.auth.any())
    l_synd, r_synd = ((np.zeros(0, np.int64),) * 2 if plain else (np.flatnonzero(x.synd) for x in (left, right)))
    sites = int(max(left.site.max(), right.site.max())) + 1
    names = (left.name.to_numpy(zero_copy_only=False), right.name.to_numpy(zero_copy_only=False)) if one_way else None

    def comparable(of: Side, to: Side) -> np.ndarray:
        if plain:
            return np.full(len(of), len(to) - itself, np.int64)
        return len(to) - np.bincount(to.site, minlength=sites)[of.site]

    def part(of: Side, to: Side, total: np.ndarray, most: np.ndarray, over: np.ndarray) -> pa.RecordBatch:
        n = comparable(of, to)
        at = n > 0
        return _products("part", of.name.filter(pa.array(at)), n=n[at], max_eff=most[at], n_over=over[at], **({"sum_eff": total[at]} if sums else {}))

    l_sum, l_max, l_over = np.zeros(len(left)), np.full(len(left), -np.inf), np.zeros(len(left), np.int64)
    r_sum, r_max, r_over = np.zeros(len(right)), np.full(len(right), -np.inf), np.zeros(len(right), np.int64)
    top = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0)]
    waiting, n_waiting = [], 0
    step = max(1, STEP_CELLS // len(right))

    def flushed() -> pa.RecordBatch:
        i, j, raw_at, eff_at, over_at = (np.concatenate(x) for x in zip(*waiting))
        return _products("pair", left.name.take(pa.array(i)), domain_b=right.name.take(pa.array(j)), raw=raw_at, eff=eff_at, n_over=over_at.astype(np.int64))

    for lo in range(0, len(left), step):
        at = slice(lo, lo + step)
        raw = left.u[at] @ right.u.T
        eff, limit = raw, cfg.sim_threshold
        if discounts:
            a, b = left.auth[at][:, None], right.auth[None, :]
            limit = cfg.sim_threshold * np.where(a & b, cfg.authority_pair_mult, np.where(a | b, cfg.authority_mixed_mult, 1.0))
            eff = raw * np.where(a & b, cfg.authority_pair_weight, np.where(a | b, cfg.authority_mixed_weight, 1.0))
        if len(l_synd) or len(r_synd):  # whole rows and columns of the tile
            eff = raw.copy() if eff is raw and (pairs or top_k) else eff
            eff[l_synd[(l_synd >= lo) & (l_synd < lo + step)] - lo] = 0.0
            eff[:, r_synd] = 0.0
        barred = np.zeros(raw.shape, dtype=bool) if plain else left.site[at][:, None] == right.site[None, :]
        if itself:
            barred[np.arange(len(raw)), np.arange(lo, lo + len(raw))] = True
        if sums:
            kept = np.where(barred, 0.0, eff)
            l_sum[at] = kept.sum(1)
        shown = eff.copy() if top_k or (pairs and eff is raw) else eff
        np.copyto(shown, -np.inf, where=barred)
        l_max[at] = shown.max(1)
        if not itself and not one_way:
            np.maximum(r_max, shown.max(0), out=r_max)
            if sums:
                r_sum += kept.sum(0)
        i, j = np.divmod(np.flatnonzero(shown >= (np.minimum(limit, floor) if pairs else limit)), len(right))
        eff_at = shown[i, j]
        over_at = eff_at >= (limit[i, j] if discounts else limit)
        l_over[at] = np.bincount(i[over_at], minlength=len(raw))
        if not itself and not one_way:
            r_over += np.bincount(j[over_at], minlength=len(right))
        if pairs and len(i):
            wanted = j > i + lo if itself else names[0][i + lo] < names[1][j] if one_way else np.ones(len(i), dtype=bool)
            i, j, eff_at, over_at = i[wanted], j[wanted], eff_at[wanted], over_at[wanted]
            waiting.append((i + lo, j, raw[i, j], eff_at, over_at))
            n_waiting += len(i)
            if n_waiting >= BATCH_PAIRS:
                yield flushed()
                waiting, n_waiting = [], 0
        if top_k:  # the best ``top_k`` comparable pairs so far, by raw score (F2 fallback)
            where = np.flatnonzero(np.triu(~barred, lo + 1) if itself else ~barred)
            score = raw.ravel()[where]
            if len(score) > top_k:
                good = score >= np.partition(score, len(score) - top_k)[len(score) - top_k]
                where, score = where[good], score[good]
            i, j = np.divmod(where, len(right))
            top = [np.concatenate(x) for x in zip(top, (i + lo, j, score, eff[i, j]))]
            best = np.argsort(-top[2], kind="stable")[:top_k]
            top = [x[best] for x in top]
    if n_waiting:
        yield flushed()
    yield part(left, right, l_sum, l_max, l_over)
    if not itself and not one_way:
        yield part(right, left, r_sum, r_max, r_over)
    if len(top[0]):
        yield _products("top", left.name.take(pa.array(top[0])), domain_b=right.name.take(pa.array(top[1])), raw=top[2], eff=top[3])


def block_task(cfg: Settings, floor: float, **how):
    """``tile_products`` of a pair of blocks (lo, hi)."""
    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(list(batches))
        lo, hi = (k.as_py() for k in key)
        if lo == hi:
            one, = sides(rows, pc.equal(rows["blk"], lo))
            yield from tile_products(one, one, cfg, floor, **how)
        else:
            yield from tile_products(*sides(rows, pc.equal(rows["blk"], lo), pc.equal(rows["blk"], hi)), cfg, floor, **how)
    return run


def spread(rows: DataFrame, tiles: int, *keys: str):
    """Rows grouped by tile, with partitions for as many tiles: they are small beside their work, and would be coalesced by size."""
    ship_package(rows.sparkSession)
    if tiles > 1:
        rows = rows.repartition(min(tiles, MAX_TILE_PARTITIONS), *keys)
    return rows.groupBy(*keys)


def block_tiles(rows: DataFrame, num_blocks: int, *columns: str):
    """Every row in each pair of blocks (lo, hi) that its own block ``blk`` belongs to, grouped by the pair."""
    blocks = max(int(num_blocks), 1)
    sent = (rows.withColumn("blk", F.pmod(F.xxhash64("domain"), F.lit(blocks)).cast("int"))
            .withColumn("_other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
            .select(F.least("blk", "_other").alias("lo"), F.greatest("blk", "_other").alias("hi"), "blk", *columns))
    return spread(sent, blocks * (blocks + 1) // 2, "lo", "hi")


def block_products(prep: DataFrame, cfg: Settings, num_blocks: int, edge_floor: float | None = None,
                   plain: bool = False, top_k: int = 0, pairs: bool = True, sums: bool = True) -> DataFrame:
    """Blocked exact all-pairs pass; returns the mixed 'pair'/'part' rows. It is run by each reader:
    callers that read it more than once store it."""
    task = block_task(cfg, cfg.sim_edge_threshold if edge_floor is None else edge_floor, plain=plain, top_k=top_k, pairs=pairs, sums=sums)
    return block_tiles(prep, num_blocks, "domain", "parent", "u", "auth", "synd").applyInArrow(task, BLOCK_OUT)


def blocks_for(n_rows: int, block_rows: int | None = None) -> int:
    if block_rows is None:
        block_rows = min(MOST_BLOCK_ROWS, max(BLOCK_ROWS, math.ceil(n_rows / FEW_BLOCKS)))
    return max(1, math.ceil(n_rows / block_rows))


def similarity_scores(domains: DataFrame, blocks: DataFrame, cfg: Settings) -> DataFrame:
    """Per domain: avg_similarity, max_similarity, similarity_flag,
    similar_domain_count (D3; 0 when the domain has no comparable partner)."""
    parts = blocks.filter(F.col("kind") == "part")
    agg = parts.groupBy(F.col("domain_a").alias("domain")).agg(
        F.sum("n").alias("n"), F.sum("sum_eff").alias("s"), F.max("max_eff").alias("mx"),
        F.sum("n_over").alias("k"))
    j = domains.select("domain").join(agg, "domain", "left")
    avg = F.when(F.col("n") > 0, F.col("s") / F.col("n")).otherwise(F.lit(0.0))
    mx = F.coalesce(F.col("mx"), F.lit(0.0))
    return j.select(
        "domain",
        F.round(avg, 4).alias("avg_similarity"),
        F.round(mx, 4).alias("max_similarity"),
        (mx >= cfg.sim_threshold).cast("int").alias("similarity_flag"),
        F.coalesce(F.col("k"), F.lit(0)).cast("int").alias("similar_domain_count"),
    )


def edge_features(domains: DataFrame, edges: DataFrame | VectorEdges, flag_at: float) -> DataFrame:
    """Legacy similarity features from edges (D2): avg, max, count over the
    edges touching a domain (both directions), flag = max >= ``flag_at``;
    0 when the domain has no edge. Of ``VectorEdges`` tiles add them up."""
    from .neighbours import VectorEdges, edge_totals
    if isinstance(edges, VectorEdges):
        g = edge_totals(edges)
    else:
        u = edges.select(F.explode(F.array("domain_a", "domain_b")).alias("domain"), "raw")
        g = u.groupBy("domain").agg(F.avg("raw").alias("a"), F.max("raw").alias("m"), F.count(F.lit(1)).alias("c"))
    j = domains.select("domain").join(g, "domain", "left")
    return j.select("domain", F.round(F.coalesce("a", F.lit(0.0)), 4).alias("avg_similarity"),
                    F.round(F.coalesce("m", F.lit(0.0)), 4).alias("max_similarity"),
                    F.coalesce("c", F.lit(0)).cast("int").alias("similar_count"),
                    (F.coalesce("m", F.lit(0.0)) >= flag_at).cast("int").alias("similarity_flag"))


def pairs_or_top(blocks: DataFrame, k: int = 100) -> DataFrame:
    """the pairs over the edge threshold; when there are none, the ``k``
    best pairs overall.  Each block task already kept its own best ``k``
    (``top_k``), so the global top-k reads at most k × block pairs rows; the
    "none over threshold" test is a scalar subquery, not a driver branch."""
    over = blocks.filter(F.col("kind") == "pair").select(
        F.least("domain_a", "domain_b").alias("domain_a"), F.greatest("domain_a", "domain_b").alias("domain_b"), "raw")
    n_over = over.agg(F.count(F.lit(1)).alias("n")).scalar()
    top = (blocks.filter(F.col("kind") == "top")
           .select(F.least("domain_a", "domain_b").alias("domain_a"),
                   F.greatest("domain_a", "domain_b").alias("domain_b"), "raw")
           .orderBy(F.desc("raw"), "domain_a", "domain_b").limit(k))
    return over.unionByName(top.filter(n_over == 0))


def similarity_pairs(blocks: DataFrame, min_effective_over: bool = True) -> DataFrame:
    """Pairs (domain_a < domain_b) whose effective similarity reaches the pair
    threshold (C3/C4)."""
    p = blocks.filter(F.col("kind") == "pair")
    if min_effective_over:
        p = p.filter(F.col("n_over") == 1)
    return p.select(F.least("domain_a", "domain_b").alias("domain_a"),
                    F.greatest("domain_a", "domain_b").alias("domain_b"),
                    F.col("raw"), F.col("eff"))


#: From this raw score on, an edge's type depends on shared authors.
OVERLAP_FROM = 0.75


def classify_pairs(pairs: DataFrame, vecs: DataFrame, bylines: DataFrame | None, cfg: Settings,
                   text_col: str = "text") -> DataFrame:
    """Edge record (B21, B22): score, effective, authority_discounted,
    syndicated, similarity_type.

    Author overlap per pair is a join on (domain, author) memberships — never
    a collected author list — and is null when either side has no bylines. Only
    pairs from ``OVERLAP_FROM`` on meet the authors: below it no rule asks.
    ``pairs`` are read twice. A domain's facts are a few bits each, stored, so
    that they are broadcast as long as they are small.
    """
    nav = nav_phrase_flags(F.substring(F.coalesce(F.col(text_col), F.lit("")), 1, 1000))
    attrs = stored(vecs.select("domain", is_authority("domain").alias("auth"), is_syndicated(text_col, cfg.excerpt_chars).alias("synd"),
                               F.aggregate(nav, F.lit(0), lambda s, x: s * 2 + x).alias("nav")))
    e = (pairs
         .join(attrs.select(F.col("domain").alias("domain_a"), F.col("auth").alias("auth_a"),
                            F.col("synd").alias("synd_a"), F.col("nav").alias("nav_a")), "domain_a")
         .join(attrs.select(F.col("domain").alias("domain_b"), F.col("auth").alias("auth_b"),
                            F.col("synd").alias("synd_b"), F.col("nav").alias("nav_b")), "domain_b"))
    if bylines is not None:
        a = (bylines.select("domain", author_norm("author").alias("an"))
             .filter(F.length("an") > 0).distinct())
        has = a.select("domain").distinct()
        close = pairs.filter(F.col("raw") >= OVERLAP_FROM).select("domain_a", "domain_b").distinct()
        ends = stored(close.select(F.explode(F.array("domain_a", "domain_b")).alias("domain")).distinct())
        a = stored(bylines.join(ends, "domain", "left_semi").select("domain", author_norm("author").alias("an"))
                   .filter(F.length("an") > 0).distinct())
        has = a.select("domain").distinct()
        met = (close.join(a.select(F.col("domain").alias("domain_a"), "an"), "domain_a")
               .join(a.select(F.col("domain").alias("domain_b"), "an"), ["domain_b", "an"], "left_semi")
               .select("domain_a", "domain_b").distinct().withColumn("ov", F.lit(True)))
        known = (close.join(has.select(F.col("domain").alias("domain_a")), "domain_a", "left_semi")
                 .join(has.select(F.col("domain").alias("domain_b")), "domain_b", "left_semi")
                 .join(met, ["domain_a", "domain_b"], "left").withColumn("ov", F.coalesce("ov", F.lit(False))))
        e = e.join(stored(known.select("domain_a", "domain_b", "ov")), ["domain_a", "domain_b"], "left")
        overlap = F.col("ov")
    else:
        overlap = F.lit(None).cast("boolean")
    nav_matches = F.bit_count(F.col("nav_a").bitwiseAND(F.col("nav_b")))
    raw = F.col("raw")
    synd = F.col("synd_a") | F.col("synd_b")
    stype = (F.when(synd, "shared_journalistic")
             .when((raw >= 0.90) & F.coalesce(overlap, F.lit(False)), "structural_clone")
             .when((raw >= OVERLAP_FROM) & (overlap == F.lit(False)), "shared_journalistic")
             .when((raw >= 0.80) & (nav_matches >= 5), "structural_clone")
             .when(raw >= 0.65, "shared_journalistic")
             .otherwise("topic_overlap"))
    return e.select(
        "domain_a", "domain_b",
        F.round(raw, 4).alias("score"),
        F.round("eff", 4).alias("effective"),
        (F.col("auth_a") | F.col("auth_b")).alias("authority_discounted"),
        synd.alias("syndicated"),
        stype.alias("similarity_type"),
    )


def average_similarity_linear(prep: DataFrame) -> DataFrame:
    """Plain average cosine of each domain to all others in linear time (R2,
    D4 retrain form: no site, authority or syndication terms):
    avg_i = (x̂_i·Σx̂ − x̂_i·x̂_i) / (n − 1).

    Σx̂ is one MLlib ``Summarizer`` sum: a per-task vector buffer merged
    across tasks, with no per-dimension rows."""
    total = prep.agg(vector_to_array(Summarizer.sum(array_to_vector("u"))).alias("tot"))
    n = prep.agg(F.count(F.lit(1)).alias("n"))
    j = one_row_join(one_row_join(prep, total), n)
    dot_tot = F.aggregate(F.zip_with("u", "tot", lambda a, b: a * b), F.lit(0.0), lambda acc, x: acc + x)
    self_dot = F.aggregate("u", F.lit(0.0), lambda acc, x: acc + x * x)
    return j.select("domain", F.when(F.col("n") > 1, (dot_tot - self_dot) / (F.col("n") - 1))
                    .otherwise(F.lit(0.0)).alias("avg_cosine"))


def _lsh_task(threshold: float, radius: float):
    """Pairs of a tile that share a bucket of any table, at or over ``threshold``: most pairs share one, so the product decides first.

    The rows of each side are sorted into boxes; only boxes whose bound reaches the threshold are multiplied."""
    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(list(batches))
        lo_block, hi_block = (k.as_py() for k in key)
        site = pc.dictionary_encode(rows["parent"].combine_chunks()).indices.to_numpy()
        blk = rows["blk"].to_numpy()
        names = pc.dictionary_encode(rows["domain"].combine_chunks())
        order = pc.sort_indices(names.dictionary).to_numpy()
        code, place = names.indices.to_numpy(), np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        by_name = np.argsort(place[code], kind="stable")  # products do not depend on the order in which rows arrive
        at = [by_name[blk[by_name] == b] for b in dict.fromkeys((lo_block, hi_block))]
        if not all(map(len, at)):
            return
        u, sig = pc.list_flatten(rows["u"]).to_numpy().reshape(len(rows), -1), matrix_of(rows["sig"]).T
        del rows
        some = np.concatenate([x[::max(1, len(x) // (SAMPLE_ROWS // 4))] for x in at])
        along = directions(u[some].astype(np.float64))
        sorted_sides = []
        for x in at:
            boxed = Boxed(np.concatenate([parts(u[x[lo:lo + STEP_ROWS]], along) for lo in range(0, len(x), STEP_ROWS)]), LEAF_ROWS)
            sorted_sides.append((boxed, x[boxed.order]))
        size = np.concatenate([np.einsum("ij,ij->i", w, w) for w in (u[lo:lo + STEP_ROWS].astype(np.float64, copy=False) for lo in range(0, len(u), STEP_ROWS))])
        (left, of), (right, to) = sorted_sides[0], sorted_sides[-1]
        itself = len(at) == 1
        close = ~(most(left.least, left.largest, right.least, right.largest) < threshold)
        waiting, n_waiting = [], 0

        def flushed() -> pa.RecordBatch:
            x, y, raw = (np.concatenate(c) for c in zip(*waiting))
            first = place[code[x]] < place[code[y]]
            ends = [names.dictionary.take(pa.array(code[np.where(first, *e)])) for e in ((x, y), (y, x))]
            return pa.RecordBatch.from_arrays([*ends, pa.array(raw)], names=["domain_a", "domain_b", "raw"])

        for k in range(len(left.starts)):
            xs = of[left.starts[k]:left.ends[k]]
            for m in np.flatnonzero(close[k]):
                if itself and m < k:
                    continue
                ys = to[right.starts[m]:right.ends[m]]
                for start in range(0, len(ys), step := max(1, STEP_CELLS // len(xs))):
                    y_at = ys[start:start + step]
                    a, b = u[xs], u[y_at]
                    # a product of floats is only a sieve
                    room = 1e-9 if u.dtype == np.float64 else 1e-9 + 4e-7 * u.shape[1] * math.sqrt(size[xs].max() * size[y_at].max())
                    i, j = np.divmod(np.flatnonzero(a @ b.T >= threshold - room), len(b))
                    if not len(i):
                        continue
                    x, y = xs[i], y_at[j]
                    good = (site[x] != site[y]) & (code[x] != code[y])
                    if itself and m == k:
                        good &= j + start > i
                    shared = np.zeros(len(x), dtype=bool)
                    for s in sig:
                        shared |= s[x] == s[y]
                    i, j = i[good & shared], j[good & shared]
                    a, b = a.astype(np.float64, copy=False), b.astype(np.float64, copy=False)
                    if len(i) * MANY > len(a) * len(b):
                        raw = (a @ b.T)[i, j]
                    else:
                        raw = np.concatenate([np.zeros(0), *(np.einsum("ij,ij->i", a[i[p:p + PAIR_STEP]], b[j[p:p + PAIR_STEP]]) for p in range(0, len(i), PAIR_STEP))])
                    x, y = xs[i], y_at[j]
                    good = (raw >= threshold) & (np.sqrt(np.maximum(size[x] + size[y] - 2 * raw, 0.0)) < radius)
                    if good.any():
                        waiting.append((x[good], y[good], raw[good]))
                        n_waiting += len(waiting[-1][0])
                    if n_waiting >= BATCH_PAIRS:
                        yield flushed()
                        waiting, n_waiting = [], 0
        if n_waiting:
            yield flushed()
    return run


def _placed(along: np.ndarray, cuts: tuple | int):
    """Rows with their box and their parts along the directions (``boxes``)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                p = parts(matrix_of(pa.chunked_array([batch.column("u")])), along)
                flat = pa.ListArray.from_arrays(np.arange(0, p.size + 1, p.shape[1], dtype=np.int32), pa.array(p.ravel()))
                yield batch.append_column("box", pa.array(dealt(p, cuts))).append_column("parts", flat)
    return run


def lsh_pairs(prep: DataFrame, threshold: float, bucket_length: float = 1.0, tables: int = 6,
              seed: int = 42) -> DataFrame:
    """Candidate pairs by random-projection LSH, re-checked exactly (C3 scale mode).

    A bucket of unit vectors holds up to half of them, so candidates are never written:
    vectors meet in tiles with their bucket numbers, and only pairs that hold leave a tile.
    A block of rows is a box of vectors (``boxes``) or a part of it, and goes only to the blocks
    whose bound reaches the threshold. Each pair of rows meets once, so only names of several rows
    can give a pair twice."""
    from pyspark.ml.feature import BucketedRandomProjectionLSH
    spark = prep.sparkSession
    v = prep.filter("domain IS NOT NULL AND parent IS NOT NULL AND u IS NOT NULL").select("domain", "parent", "u", array_to_vector("u").alias("vec"))
    if v.isEmpty():
        return spark.createDataFrame([], "domain_a string, domain_b string, raw double")
    ship_package(spark)
    model = BucketedRandomProjectionLSH(inputCol="vec", outputCol="h", bucketLength=bucket_length,
                                        numHashTables=tables, seed=seed).fit(v)
    buckets = F.array(*[F.get(vector_to_array(F.get("h", F.lit(i))), F.lit(0)) for i in range(tables)])
    rows = stored(model.transform(v).select("domain", "parent", "u", buckets.alias("sig")))
    n = rows.count()
    # about so many by their hash, and no more than twice as many; it decides what bounds exclude, not what is found
    sample = rows.filter(F.pmod(F.xxhash64("domain", "u"), F.lit(n)) < SAMPLE_ROWS).select("u").limit(2 * SAMPLE_ROWS).collect() or [rows.select("u").first()]
    sample = np.array([r["u"] for r in sample], dtype=np.float64)
    along, wanted = directions(sample), blocks_for(n, min(MOST_BOX_ROWS, max(BLOCK_ROWS, math.ceil(n / FEW_BOXES))))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    rows = rows.mapInArrow(_placed(along, grown(parts(sample, along), wanted)), f"{schema}, box int, parts array<double>")
    part = [F.get("parts", F.lit(i)) for i in range(along.shape[1] + 1)]
    boxes = rows.groupBy("box").agg(F.count(F.lit(1)).alias("n"), F.array(*map(F.min, part)).alias("least"), F.array(*map(F.max, part)).alias("largest")).orderBy("box").collect()
    least, largest = (np.array([r[c] for r in boxes]) for c in ("least", "largest"))
    close = ~(most(least, largest, least, largest) < threshold)
    most_rows = max(BLOCK_ROWS, 2 * math.ceil(sum(r["n"] for r in boxes) / wanted))
    cut = [math.ceil(r["n"] / most_rows) for r in boxes]  # a box of too many rows is several blocks
    start = np.cumsum(cut) - cut
    of = [[int(start[j]) + c for j in np.flatnonzero(close[i]) for c in range(cut[j])] for i in range(len(boxes))]
    by_box = lambda values: F.get(F.from_json(F.lit(json.dumps(values)), "array<int>" if isinstance(values[0], int) else "array<array<int>>"),
                                  F.col("box"))
    number = {r["box"]: i for i, r in enumerate(boxes)}
    spot = [number.get(b, 0) for b in range(max(number) + 1)]  # by the box's number, which may have gaps
    sent = (rows.withColumn("blk", by_box([int(start[i]) for i in spot]) + F.pmod(F.xxhash64("domain"), by_box([cut[i] for i in spot])).cast("int"))
            .withColumn("_other", F.explode(by_box([of[i] for i in spot])))
            .select(F.least("blk", "_other").alias("lo"), F.greatest("blk", "_other").alias("hi"), "blk", "domain", "parent", "u", "sig"))
    radius = math.sqrt(max(2.0 - 2.0 * threshold, 0.0)) + 1e-9
    tiles = sum(cut[i] * len(of[i]) for i in range(len(boxes))) // 2 + sum(cut)  # few and long: rarely two in one partition
    pairs = spread(sent, 4 * tiles, "lo", "hi").applyInArrow(_lsh_task(threshold, radius), "domain_a string, domain_b string, raw double")
    once = rows.groupBy("domain").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty()
    return pairs if once else pairs.distinct()


def _class_sums(prep: DataFrame, by: list[str], dim_col: str = "u") -> DataFrame:
    """Per-dimension sums of unit vectors of non-syndicated rows, split by
    authority class, grouped by ``by``: one ``Summarizer`` vector sum per
    group (partial aggregation, so a hot site is combined map-side; output
    arrays have the vector dimension, so they are bounded)."""
    x = prep.filter(~F.col("synd")).select(*by, "auth", array_to_vector(dim_col).alias("vv"))
    g = x.groupBy(*by, "auth").agg(vector_to_array(Summarizer.sum(F.col("vv"))).alias("v"))
    vec = F.col("v")
    return g.groupBy(*by).agg(
        F.max(F.when(F.col("auth"), vec)).alias("sum_auth"),
        F.max(F.when(~F.col("auth"), vec)).alias("sum_non"))


def average_effective_linear(prep: DataFrame, cfg: Settings) -> DataFrame:
    """Exact average effective similarity in linear time (R2, full form):
    Σ_j eff_ij = x̂_i·(w_i,non·(T_non − P_non(site_i)) + w_i,auth·(T_auth − P_auth(site_i)))
    over non-syndicated j of other sites; syndicated j stay in the count
    (their effective score is 0) and a syndicated i scores 0."""
    dim = F.size("u")
    zero = lambda: F.array_repeat(F.lit(0.0), dim)
    tot = _class_sums(prep, [])
    n_all = prep.agg(F.count(F.lit(1)).alias("n")).select("n").scalar()
    per_site = _class_sums(prep, ["parent"])
    site_n = prep.groupBy("parent").agg(F.count(F.lit(1)).alias("n_site"))
    site = site_n.join(per_site, "parent", "left")
    j = salted_join(prep, site, ["parent"], "left", ["domain"], size_col="n_site")
    j = j.withColumn("t_auth", tot.select(F.coalesce("sum_auth", F.array().cast("array<double>"))).scalar()) \
         .withColumn("t_non", tot.select(F.coalesce("sum_non", F.array().cast("array<double>"))).scalar())

    def diff(a, b):
        a2 = F.when(F.size(a) > 0, a).otherwise(zero())
        b2 = F.coalesce(b, zero())
        return F.zip_with(a2, b2, lambda x, y: x - y)

    def dot(a, b):
        return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)

    w_non = F.when(F.col("auth"), F.lit(cfg.authority_mixed_weight)).otherwise(F.lit(1.0))
    w_auth = F.when(F.col("auth"), F.lit(cfg.authority_pair_weight)).otherwise(F.lit(cfg.authority_mixed_weight))
    s = dot("u", diff(F.col("t_non"), F.col("sum_non"))) * w_non + dot("u", diff(F.col("t_auth"), F.col("sum_auth"))) * w_auth
    n_valid = n_all - F.col("n_site")
    avg = F.when(F.col("synd") | (n_valid <= 0), F.lit(0.0)).otherwise(s / n_valid)
    return j.select("domain", avg.alias("avg_similarity"), n_valid.alias("n_valid"))


def similarity_scores_scalable(domains: DataFrame, prep: DataFrame, cfg: Settings,
                               bucket_length: float = 1.0, tables: int = 6) -> DataFrame:
    """Scale path for D3 (no all-pairs work): exact average by the linear
    identity; maximum, flag and over-threshold count from LSH candidates
    re-checked exactly.  Every pair whose effective score can reach a pair
    threshold has raw cosine >= the base threshold, so candidates at the base
    threshold cover all of them (up to LSH recall); a domain without a
    candidate reports max 0, which is below every flag threshold."""
    avg = average_effective_linear(prep, cfg)
    cand = lsh_pairs(prep, cfg.sim_threshold, bucket_length, tables)
    a = prep.select("domain", "auth", "synd")
    e = (cand.join(a.select(F.col("domain").alias("domain_a"), F.col("auth").alias("aa"), F.col("synd").alias("sa")),
                   "domain_a")
         .join(a.select(F.col("domain").alias("domain_b"), F.col("auth").alias("ab"), F.col("synd").alias("sb")),
               "domain_b"))
    both, one = F.col("aa") & F.col("ab"), F.col("aa") | F.col("ab")
    eff = F.when(F.col("sa") | F.col("sb"), F.lit(0.0)).when(both, F.col("raw") * cfg.authority_pair_weight) \
           .when(one, F.col("raw") * cfg.authority_mixed_weight).otherwise(F.col("raw"))
    thr = F.when(both, cfg.sim_threshold * cfg.authority_pair_mult).when(one, cfg.sim_threshold * cfg.authority_mixed_mult) \
           .otherwise(F.lit(cfg.sim_threshold))
    e = e.select("domain_a", "domain_b", eff.alias("eff"), (eff >= thr).cast("int").alias("over"))
    per = (e.select(F.explode(F.array("domain_a", "domain_b")).alias("domain"), "eff", "over")
           .groupBy("domain").agg(F.max("eff").alias("mx"), F.sum("over").alias("k")))
    j = domains.select("domain").join(avg, "domain", "left").join(per, "domain", "left")
    mx = F.coalesce(F.col("mx"), F.lit(0.0))
    return j.select("domain", F.round(F.coalesce("avg_similarity", F.lit(0.0)), 4).alias("avg_similarity"),
                    F.round(mx, 4).alias("max_similarity"),
                    (mx >= cfg.sim_threshold).cast("int").alias("similarity_flag"),
                    F.coalesce(F.col("k"), F.lit(0)).cast("int").alias("similar_domain_count"))


def similarity_scores_of(vecs: DataFrame, cfg: Settings, n_rows: int, approximate: bool = False) -> DataFrame:
    """D3 by the exact pruned passes (``simjoin``) at every size;
    ``approximate=True`` asks for LSH candidates instead."""
    from .simjoin import exact_scores, pinned
    prep = prepare_vectors(vecs, cfg)
    if approximate:
        return similarity_scores_scalable(vecs, prep, cfg)
    return exact_scores(pinned(prep), cfg, n_rows)
