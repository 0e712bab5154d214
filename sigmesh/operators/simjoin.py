"""Exact pruned similarity join.

Pivots come from a bounded sample; each vector belongs to the cell of its
nearest pivot. Angles obey the triangle inequality: a vector at angle a from a
pivot is at least a - r from every member of a cell of radius r, so no cosine
there exceeds cos(a - r).

1. Home pass: every cell is compared with itself, in tiles of ``BLOCK_ROWS``.
   It gives each vector a best partner to beat.
2. Probe pass: a vector goes only to the other cells whose bound reaches the
   pair threshold or the best it has; there it meets the cell's blocks.

A pair at or over the threshold passes the bound from both of its sides, so
pairs, maxima and counts are exact at every size; averages need no pairs at all
(``average_effective_linear``). How much is pruned depends on the data: vectors
in groups leave few candidates, vectors without any structure leave all (then
the work is that of all pairs). ``pairs_compared`` reports it.

Where the bounds leave more than half of all cells to the vectors, every pair of
blocks is compared once instead: a probe pass meets its pairs from both sides.

Vectors and what the home pass finds are written once; the last pass runs in its
reader. Tiles work in steps (``tile_products``).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from ..config import Settings
from ..session import ensure_checkpoint_dir, ship_package, stored, tidy
from .similarity import (BLOCK_OUT, BLOCK_ROWS, average_effective_linear, block_products, block_task, blocks_for, sides, similarity_scores, spread,
                         tile_products)

#: Vectors per pivot (a cell below a block would save nothing), and most pivots.
ROWS_PER_PIVOT = BLOCK_ROWS
MAX_PIVOTS = 64
#: Rows that pivots are chosen from (those with the smallest hash of their key).
SAMPLE_ROWS = 2048
#: Room for rounding in the bounds.
SLACK = 1e-9
#: Share of cells left to probe from which on all blocks meet once.
MOST_PROBES = 0.5
_CELL_BLOCKS = 1 << 20  # blocks of a cell have numbers of their own below this


def pinned(prep: DataFrame) -> DataFrame:
    """The columns of ``prepare_vectors``, written once: every pass and the averages read them."""
    ensure_checkpoint_dir(prep.sparkSession)
    tidy(prep.sparkSession)
    return prep.select("domain", "parent", "u", "auth", "synd").checkpoint()


def choose_pivots(prep: DataFrame, count: int, sample: int = SAMPLE_ROWS) -> np.ndarray:
    """Farthest-first among a bounded sample: each next pivot is the row least similar to those chosen."""
    rows = (prep.select(F.xxhash64("domain").alias("h"), "domain", "u").orderBy("h", "domain").limit(sample).collect())
    if not rows:
        return np.zeros((0, 0))
    x = np.array([r["u"] for r in rows], dtype=np.float64)
    x = x[np.abs(x).sum(1) > 0] if np.abs(x).any() else x[:1]  # a zero vector is far from all and near to none
    chosen, near = [0], x @ x[0]
    while len(chosen) < min(count, len(x)):
        near[chosen] = np.inf
        chosen.append(int(near.argmin()))
        near = np.maximum(near, x @ x[chosen[-1]])
    return x[chosen]


def _angles(u: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(u @ pivots.T, -1.0, 1.0))


def _with_home(prep: DataFrame, pivots: np.ndarray) -> DataFrame:
    """``prep`` with the cell of the nearest pivot and the angle to it."""
    def assign(frames):
        for pdf in frames:
            if not len(pdf):
                continue
            a = _angles(np.vstack(pdf["u"].to_numpy()), pivots)
            home = a.argmin(1)
            yield pdf.assign(home=home.astype(np.int32), angle=a[np.arange(len(a)), home])
    schema = StructType([*prep.schema.fields, StructField("home", IntegerType()), StructField("angle", DoubleType())])
    return prep.mapInPandas(assign, schema)


def _probes(rows: DataFrame, pivots: np.ndarray, radius: np.ndarray, least: float, out: StructType) -> DataFrame:
    """A row for each vector and other cell that may hold a partner over ``least`` or over its ``best`` so far."""
    def send(frames):
        for pdf in frames:
            if not len(pdf):
                continue
            bound = np.cos(np.maximum(_angles(np.vstack(pdf["u"].to_numpy()), pivots) - radius[None, :], 0.0)) + SLACK
            best = pdf["best"].fillna(-np.inf).to_numpy(float)
            # a syndicated or discounted partner can lift a negative score towards 0
            may = (bound >= least) | (np.maximum(bound, 0.0) >= best[:, None])
            may &= radius[None, :] >= 0.0  # a cell without members
            may[np.arange(len(pdf)), pdf["home"].to_numpy()] = False
            i, c = np.nonzero(may)
            if len(i):
                yield pdf.iloc[i].assign(cell=c.astype(np.int32))[[f.name for f in out.fields]]
    return rows.mapInPandas(send, out)


def _probe_share(rows: DataFrame, pivots: np.ndarray, radius: np.ndarray, least: float) -> float:
    """The share of other cells that the bound for ``least`` alone leaves to the vectors."""
    def count(frames):
        for pdf in frames:
            if not len(pdf):
                continue
            may = np.cos(np.maximum(_angles(np.vstack(pdf["u"].to_numpy()), pivots) - radius[None, :], 0.0)) + SLACK >= least
            may &= radius[None, :] >= 0.0
            may[np.arange(len(pdf)), pdf["home"].to_numpy()] = False
            yield pd.DataFrame({"n": [len(pdf)], "may": [int(may.sum())]})
    r = rows.select("u", "home").mapInPandas(count, "n long, may long").agg(F.sum("n").alias("n"), F.sum("may").alias("may")).first()
    others = max(1, int((radius >= 0.0).sum()) - 1)
    return (r["may"] or 0) / max(1, (r["n"] or 0) * others)


def _probe_task(cfg: Settings, edge_floor: float, pairs: bool):
    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(list(batches))
        who, them = sides(rows, rows["probe"], pc.invert(rows["probe"]))
        # both sides probe each other's cell: the smaller name reports the pair
        yield from tile_products(who, them, cfg, edge_floor, one_way=True, pairs=pairs, sums=False)
    return run


def _number(of: dict) -> F.Column:
    """A number per cell, as an expression."""
    return F.element_at(F.create_map(*[F.lit(int(x)) for c in sorted(of) for x in (c, of[c])]), F.col("cell"))


def _own_block() -> F.Column:
    return F.pmod(F.xxhash64("domain"), F.col("_blocks")).cast("int")


def _home_pass(rows: DataFrame, blocks: dict, cfg: Settings, floor: float, pairs: bool) -> DataFrame:
    """Every cell (``home``) against itself; ``blocks`` has the number of blocks of each."""
    home = rows.withColumn("cell", F.col("home")).withColumn("_blocks", _number(blocks)).withColumn("_own", _own_block())
    start = F.col("cell") * _CELL_BLOCKS
    home = (home.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
            .select((start + F.least("_own", "_other")).alias("lo"), (start + F.greatest("_own", "_other")).alias("hi"),
                    (start + F.col("_own")).alias("blk"), "domain", "parent", "u", "auth", "synd"))
    tiles = sum(b * (b + 1) // 2 for b in blocks.values())
    return stored(spread(home, tiles, "lo", "hi").applyInArrow(block_task(cfg, floor, pairs=pairs, sums=False), BLOCK_OUT))


def pruned_products(prep: DataFrame, cfg: Settings, n_rows: int, edge_floor: float | None = None, pivots: int | None = None,
                    block_rows: int | None = None, pairs: bool = True) -> DataFrame:
    """'pair' and 'part' rows as of ``block_products`` for vectors that are ``pinned``; a part's ``n`` counts compared partners, its ``sum_eff`` means
    nothing. ``pairs=False``: 'part' rows alone. The last pass is run by each reader; callers that read it more than once store it."""
    floor = cfg.sim_edge_threshold if edge_floor is None else edge_floor
    if not n_rows:
        return prep.sparkSession.createDataFrame([], BLOCK_OUT)
    ship_package(prep.sparkSession)  # for the cells and probes; tiles see to it themselves
    want = min(MAX_PIVOTS, max(1, math.ceil(n_rows / ROWS_PER_PIVOT))) if pivots is None else pivots
    if want == 1:  # one cell needs no pivot
        return block_products(prep, cfg, blocks_for(n_rows, block_rows), floor, pairs=pairs)
    points = choose_pivots(prep, want)
    if len(points) == 1:
        return block_products(prep, cfg, blocks_for(n_rows, block_rows), floor, pairs=pairs, sums=False)
    rows = _with_home(prep.filter("u IS NOT NULL"), points).checkpoint()
    cells = {r["home"]: r for r in rows.groupBy("home").agg(F.count(F.lit(1)).alias("n"), F.max("angle").alias("r")).collect()}  # a row a pivot
    radius = np.array([cells[c]["r"] if c in cells else -1.0 for c in range(len(points))])
    least = min(floor, cfg.sim_threshold)
    if _probe_share(rows, points, radius, least) > MOST_PROBES:
        return block_products(prep, cfg, blocks_for(n_rows, block_rows), floor, pairs=pairs, sums=False)
    blocks = {c: blocks_for(cells[c]["n"], block_rows or BLOCK_ROWS) for c in cells}

    found = _home_pass(rows, blocks, cfg, floor, pairs)
    best = found.filter("kind = 'part'").groupBy(F.col("domain_a").alias("domain")).agg(F.max("max_eff").alias("best"))
    schema = StructType([*prep.schema.fields, StructField("cell", IntegerType())])
    probes = _probes(rows.join(best, "domain", "left"), points, radius, least, schema)
    sent = {r["cell"]: r["n"] for r in probes.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row a pivot
    if not sent:
        return found
    groups = {c: blocks_for(sent[c], block_rows or BLOCK_ROWS) for c in sent}
    key = F.xxhash64("domain", F.lit(1))
    who = (probes.withColumn("a", F.pmod(key, _number(groups)).cast("int"))
           .withColumn("b", F.explode(F.sequence(F.lit(0), _number(blocks) - 1))).withColumn("probe", F.lit(True)))
    them = (rows.withColumn("cell", F.col("home")).filter(F.col("cell").isin([int(c) for c in groups]))
            .withColumn("_blocks", _number(blocks)).withColumn("b", _own_block())
            .withColumn("a", F.explode(F.sequence(F.lit(0), _number(groups) - 1))).withColumn("probe", F.lit(False)))
    cols = ["cell", "a", "b", "probe", "domain", "parent", "u", "auth", "synd"]
    tiles = sum(groups[c] * blocks[c] for c in groups)
    outer = spread(who.select(*cols).unionByName(them.select(*cols)), tiles, "cell", "a", "b").applyInArrow(_probe_task(cfg, floor, pairs), BLOCK_OUT)
    return found.unionByName(outer)


def exact_scores(prep: DataFrame, cfg: Settings, n_rows: int) -> DataFrame:
    """D3 for ``pinned`` vectors, without pairs. A single cell has compared all pairs, so its sums give the averages as well."""
    products = pruned_products(prep, cfg, n_rows, pairs=False)
    if n_rows <= ROWS_PER_PIVOT:
        return similarity_scores(prep, products, cfg)
    return pruned_scores(prep, prep, products, cfg)


def pairs_compared(products: DataFrame) -> DataFrame:
    """One row: ordered comparisons of different sites that the passes made."""
    return products.filter("kind = 'part'").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("compared"))


def pruned_scores(domains: DataFrame, prep: DataFrame, products: DataFrame, cfg: Settings) -> DataFrame:
    """D3 from the pruned passes: maxima and counts from them, the average from sums of vectors."""
    parts = (products.filter("kind = 'part'").groupBy(F.col("domain_a").alias("domain"))
             .agg(F.max("max_eff").alias("mx"), F.sum("n_over").alias("k")))
    rows = domains.select("domain").join(average_effective_linear(prep, cfg), "domain", "left").join(parts, "domain", "left")
    mx = F.coalesce(F.col("mx"), F.lit(0.0))
    return rows.select("domain", F.round(F.coalesce("avg_similarity", F.lit(0.0)), 4).alias("avg_similarity"),
                       F.round(mx, 4).alias("max_similarity"), (mx >= cfg.sim_threshold).cast("int").alias("similarity_flag"),
                       F.coalesce(F.col("k"), F.lit(0)).cast("int").alias("similar_domain_count"))
