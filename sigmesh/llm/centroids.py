"""Centroid clustering of vectors over zone maps.

Vectors are put into the order of a Hilbert curve through their leading
directions and cut into blocks of ``BLOCK`` neighbours. Each block is one row of
a table in the shared folder: its integer vectors and, along every direction,
the least and the largest coordinate (the block's box). In each round a task
reads blocks, bounds the distance from the box to every centroid from below and
from above, keeps as candidates the centroids whose lower bound does not exceed
the smallest upper bound, and compares the vectors with those alone, exactly, in
integers. A block with one candidate is not compared at all: its stored sum
counts whole. Spark adds up the sums, one row a task and cluster.

Directions are the eigenvectors of the covariance of all vectors (one 64 x 64
matrix a task, added up), so that boxes are narrow where vectors differ most.
They decide the order and the boxes, never a result: bounds leave room for
rounding, and every distance, sum and floor is an integer.

Defined cases: rows whose vector is null, has another number of components, or
a null or non-finite component are left out; integers beyond 2**27 in size count
as that (their squared distances would not fit a long); ties of the starting
order go by the components, of the nearest centroid to the smaller number;
repeated rows count each; with fewer rows than centroids each row starts one; a
null vec_id is hashed as an empty one; no vectors give an empty result. Columns
other than vec_id and embedding are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch

DIM = 64
CLUSTERS = 40
ROUNDS = 5
SEED = 2
SCALE = 256
LIMIT = 1 << 27
BLOCK = 256
#: Directions and bits of each in the curve: together one 64-bit key.
AXES, BITS = 8, 7
#: Room that bounds leave for rounding, as a share of the numbers compared.
SLACK = 1e-9


def integers(vectors: DataFrame, dim: int = DIM, scale: int = SCALE) -> DataFrame:
    """Rows that count: vec_id and v (array of long, floor(scale * x))."""
    e = F.col("embedding").cast("array<double>")
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), e.alias("e")).filter(F.size("e") == dim)
    bad = F.exists("e", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = F.transform("e", lambda x: F.floor(F.least(F.greatest(x * scale, F.lit(float(-LIMIT))), F.lit(float(LIMIT)))))
    return v.filter(~bad).select("vec_id", whole.alias("v"))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dim)


def curve_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place of each row of ``cells`` (integers below 2**bits) on the Hilbert curve of that many dimensions."""
    x = cells.astype(np.uint64).T.copy()
    dims = len(x)
    top = np.uint64(1 << (bits - 1))
    q = top
    while q > 1:  # undo the turns of each level, coarse to fine
        p = q - np.uint64(1)
        for d in range(dims):
            turn = (x[d] & q) != 0
            swap = np.where(turn, np.uint64(0), (x[0] ^ x[d]) & p)
            x[0] = np.where(turn, x[0] ^ p, x[0] ^ swap)
            x[d] ^= swap
        q >>= np.uint64(1)
    for d in range(1, dims):  # Gray code
        x[d] ^= x[d - 1]
    t = np.zeros(x.shape[1], dtype=np.uint64)
    q = top
    while q > 1:
        t ^= np.where((x[dims - 1] & q) != 0, q - np.uint64(1), np.uint64(0))
        q >>= np.uint64(1)
    x ^= t
    key = np.zeros(x.shape[1], dtype=np.uint64)
    for b in range(bits - 1, -1, -1):
        for d in range(dims):
            key = (key << np.uint64(1)) | ((x[d] >> np.uint64(b)) & np.uint64(1))
    return key


def _directions(rows: DataFrame, dim: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Mean, directions (columns, widest first) and spread along them, of all vectors."""
    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, first, second = 0, np.zeros(dim), np.zeros((dim, dim))
        for b in batches:
            m = _matrix(b.column("v"), dim).astype(np.float64)
            n, first, second = n + len(m), first + m.sum(0), second + m.T @ m
        if n:
            yield pa.record_batch([[float(n)], [first.tolist()], [second.ravel().tolist()]], ["n", "a", "b"])
    parts = rows.mapInArrow(moments, "n double, a array<double>, b array<double>")
    # one row a task comes in, one goes out: elements are added by their place
    sums = (parts.select("n", F.posexplode(F.concat("a", "b")).alias("at", "x")).groupBy("at").agg(F.sum("x").alias("x"), F.sum("n").alias("n"))
            .orderBy("at").collect())
    if not sums:
        return np.zeros(dim), np.eye(dim), np.ones(dim)
    n, flat = sums[0]["n"], np.array([r["x"] for r in sums])
    mean = flat[:dim] / n
    value, vector = np.linalg.eigh(flat[dim:].reshape(dim, dim) / n - np.outer(mean, mean))
    return mean, vector[:, ::-1].copy(), np.sqrt(np.maximum(value[::-1], 1e-12))


def _with_keys(rows: DataFrame, dim: int, mean: np.ndarray, turn: np.ndarray, spread: np.ndarray) -> DataFrame:
    axes = min(AXES, dim)

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            m = _matrix(b.column("v"), dim)
            at = ((m - mean) @ turn[:, :axes]) / (4 * spread[:axes])  # two standard deviations to each side, clipped beyond
            cells = np.clip((at + 0.5) * (1 << BITS), 0, (1 << BITS) - 1)
            key = curve_keys(cells.astype(np.int64), BITS).astype(np.int64)
            yield pa.record_batch([b.column("vec_id"), b.column("v"), pa.array(key)], ["vec_id", "v", "key"])
    return rows.mapInArrow(keys, "vec_id long, v array<long>, key long")


_BLOCKS = "ids array<long>, vectors binary, low binary, high binary, total array<long>"


def _blocks(rows: DataFrame, dim: int, turn: np.ndarray, size: int) -> DataFrame:
    """Blocks of neighbours on the curve; equal keys are told apart by vec_id, so many copies spread over partitions."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            m = _matrix(b.column("v"), dim)
            at = m @ turn
            for lo in range(0, len(m), size):
                x, y = m[lo:lo + size], at[lo:lo + size]
                yield pa.record_batch([pa.array([b.column("vec_id")[lo:lo + size].to_pylist()], pa.list_(pa.int64())),
                                       [x.astype("<i4").tobytes()], [y.min(0).tobytes()], [y.max(0).tobytes()], [x.sum(0).tolist()]],
                                      ["ids", "vectors", "low", "high", "total"])
    ordered = rows.repartitionByRange("key", "vec_id").sortWithinPartitions("key", "vec_id").select("vec_id", "v")
    return ordered.mapInArrow(cut, _BLOCKS)


def candidates(low: np.ndarray, high: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Numbers of the centroids that may be nearest to a point of the box, all in turned coordinates."""
    gap = np.maximum(np.maximum(low - centres, centres - high), 0.0)
    far = np.maximum(np.abs(centres - low), np.abs(centres - high))
    least, most = (gap * gap).sum(1), (far * far).sum(1)
    room = SLACK * (1.0 + most.max() + (centres * centres).sum(1).max())
    return np.flatnonzero(least <= most.min() + room)


def nearest(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest of ``centres`` for each row of ``x`` (first on ties) and the squared distance, in integers."""
    widest = max(int(np.abs(x).max(initial=0)), int(np.abs(centres).max(initial=0)))
    if 4 * x.shape[1] * widest * widest < 1 << 53:  # products and sums of doubles are exact
        a, c = x.astype(np.float64), centres.astype(np.float64)
        d = ((a * a).sum(1)[:, None] - 2 * (a @ c.T) + (c * c).sum(1)[None, :]).astype(np.int64)
    else:
        d = np.stack([((x - c) ** 2).sum(1) for c in centres], axis=1)
    best = d.argmin(1)
    return best, d[np.arange(len(x)), best]


def _assigned(low: bytes, high: bytes, vectors: bytes, dim: int, centres: np.ndarray, turned: np.ndarray):
    x = np.frombuffer(vectors, "<i4").reshape(-1, dim).astype(np.int64)
    may = candidates(np.frombuffer(low), np.frombuffer(high), turned)
    return x, may, nearest(x, centres[may])


def _round(blocks: DataFrame, dim: int, centres: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, dict]:
    """The next centroids, and how many distances of all were computed."""
    k, turned = len(centres), centres @ turn

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count, compared, all_ = np.zeros((k, dim), dtype=np.int64), np.zeros(k, dtype=np.int64), 0, 0
        for b in batches:
            for r in b.to_pylist():
                n = len(r["ids"])
                may = candidates(np.frombuffer(r["low"]), np.frombuffer(r["high"]), turned)
                all_ += n * k
                if len(may) == 1:
                    total[may[0]] += np.array(r["total"], dtype=np.int64)
                    count[may[0]] += n
                    continue
                compared += n * len(may)
                x = np.frombuffer(r["vectors"], "<i4").reshape(-1, dim).astype(np.int64)
                mine = may[nearest(x, centres[may])[0]]
                np.add.at(total, mine, x)
                count += np.bincount(mine, minlength=k)
        has = np.flatnonzero(count)
        # the numbers of a task travel as one row a cluster, its count and work first
        yield pa.record_batch([has.astype(np.int32), pa.array([[int(count[c]), *total[c].tolist()] for c in has], pa.list_(pa.int64())),
                               pa.array([compared if i == 0 else 0 for i in range(len(has))], pa.int64()),
                               pa.array([all_ if i == 0 else 0 for i in range(len(has))], pa.int64())],
                              ["cluster", "sums", "compared", "all"])
    parts = blocks.mapInArrow(sums, "cluster int, sums array<long>, compared long, all long")
    added = [F.sum(F.get("sums", F.lit(i)).cast("decimal(38,0)")).alias(f"s{i}") for i in range(dim + 1)]
    new, work = centres.copy(), {"compared": 0, "all": 0}
    for r in parts.groupBy("cluster").agg(*added, F.sum("compared").alias("compared"), F.sum("all").alias("all")).collect():  # a row a cluster
        new[r["cluster"]] = [int(r[f"s{i + 1}"]) // int(r["s0"]) for i in range(dim)]
        work = {w: work[w] + r[w] for w in work}
    return new, work


def _final(blocks: DataFrame, dim: int, centres: np.ndarray, turn: np.ndarray) -> DataFrame:
    turned = centres @ turn

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                _, may, (best, distance) = _assigned(r["low"], r["high"], r["vectors"], dim, centres, turned)
                yield pa.record_batch([pa.array(r["ids"], pa.int64()), may[best].astype(np.int32), distance], ["vec_id", "cluster", "distance"])
    return blocks.mapInArrow(rows, "vec_id long, cluster int, distance long")


def clusters(spark: SparkSession, vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED, dim: int = DIM,
             block: int = BLOCK, work: list | None = None) -> DataFrame:
    """One row per vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    ``work``, if given, gets one dict a round: distances compared, and of all.
    """
    scratch = Scratch(spark, "centroids")
    kept = scratch.table(integers(vectors, dim), "integers")
    place = F.sha2(F.encode(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), "UTF-8"), 256)
    start = kept.select(place.alias("place"), "v").orderBy("place", "v").limit(k).collect()  # k rows
    if not start:
        return kept.select("vec_id", *[F.lit(None).cast(t).alias(c) for c, t in (
            ("cluster", "int"), ("distance", "long"), ("cluster_inertia", "long"), ("inertia", "long"), ("centroid_sha256", "string"))])
    centres = np.array([r["v"] for r in start], dtype=np.int64)
    mean, turn, spread = _directions(kept, dim)
    blocks = scratch.table(_blocks(_with_keys(kept, dim, mean, turn, spread), dim, turn, block), "blocks")
    for _ in range(rounds):
        centres, done = _round(blocks, dim, centres, turn)
        if work is not None:
            work.append(done)
    out = scratch.table(_final(blocks, dim, centres, turn), "assigned")
    wide = F.sum(F.col("distance").cast("decimal(38,0)"))
    sums = {r["cluster"]: int(r["s"]) for r in out.groupBy("cluster").agg(wide.alias("s")).collect()}  # a row a cluster
    inertia = sum(sums.values())
    named = [(c, s, inertia, hashlib.sha256(",".join(map(str, centres[c].tolist())).encode()).hexdigest()) for c, s in sorted(sums.items())]
    facts = spark.createDataFrame(named, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return out.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
