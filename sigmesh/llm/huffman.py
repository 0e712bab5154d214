"""Token ids in a compact binary format: canonical length-limited Huffman codes.

1. Texts are encoded once; the ids are staged as a table in the shared folder.
2. Spark sums global counts per id; the driver builds one code of at most
   ``MAX_BITS`` bits by package-merge. Counts, lengths and tables have one
   entry per vocabulary id, so their size is bounded by the vocabulary.
3. Rows are range-partitioned and sorted by doc_id. Each task writes
   containers of about ``CONTAINER_IDS`` ids: a header, an index of the
   documents, a bit offset for every block of ``BLOCK_IDS`` ids, and the codes.
4. Blocks decode independently of each other: a table maps the next
   ``MAX_BITS`` bits to an id and its code length, and all blocks of a
   container advance together.

A container is one binary value of a Parquet row, so Spark's commit protocol
makes retried tasks safe. The codebook is a file of the same kind.

Layout (little-endian): magic "HTOK", u32 version, u64 ids, u32 documents,
u32 ids per block, u32 blocks, u64 words; then per document u64 doc_id and
u64 ids; per block u64 bit offset; then big-endian-in-word codes as u32.

Defined cases: null text counts as empty and yields the end id only; a null
doc_id sorts first; repeated rows are kept, in the order of id, then of a hash of their ids;
an empty table gives no container. Other columns are not read.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import tokens
from .common import Scratch, documents

MAX_BITS = 20
BLOCK_IDS = 256
CONTAINER_IDS = 1 << 18
MAGIC, VERSION = b"HTOK", 1
HEAD = struct.Struct("<4sIQIIIQ")
NO_ID = -(1 << 63)  # a null doc_id in the index


def code_lengths(counts: np.ndarray, limit: int = MAX_BITS) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits for the ids that occur (package-merge)."""
    used = np.flatnonzero(counts)
    out = np.zeros(len(counts), dtype=np.uint8)
    if len(used) < 2:
        out[used] = 1
        return out
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} symbols need more than {limit} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    weights = counts[order].astype(np.int64)
    n = len(order)
    # each level holds (weight, leaf or -1) in order; packages refer to the level below by position
    levels, below = [], None
    for _ in range(limit):
        if below is None:
            w, leaf = weights, np.arange(n)
        else:
            pairs = below[: len(below) // 2 * 2].reshape(-1, 2).sum(axis=1)
            w = np.concatenate([weights, pairs])
            leaf = np.concatenate([np.arange(n), np.full(len(pairs), -1)])
            by = np.argsort(w, kind="stable")
            w, leaf = w[by], leaf[by]
        levels.append(leaf)
        below = w
    lengths = np.zeros(n, dtype=np.int64)
    take = 2 * n - 2
    for leaf in reversed(levels):
        head = leaf[:take]
        lengths[head[head >= 0]] += 1
        take = 2 * int((head < 0).sum())
    out[order] = lengths
    return out


def canonical(lengths: np.ndarray) -> np.ndarray:
    """Codes that the lengths alone determine: by length, then by id."""
    codes = np.zeros(len(lengths), dtype=np.uint32)
    code, last = 0, 0
    order = [i for i in np.lexsort((np.arange(len(lengths)), lengths)) if lengths[i]]
    for i in order:
        code <<= int(lengths[i]) - last
        last = int(lengths[i])
        codes[i] = code
        code += 1
    return codes


def decode_table(lengths: np.ndarray, limit: int = MAX_BITS) -> tuple[np.ndarray, np.ndarray]:
    """For every possible next ``limit`` bits, the id and its code length."""
    used = np.flatnonzero(lengths)
    by = used[np.lexsort((used, lengths[used]))]
    spans = np.int64(1) << (limit - lengths[by].astype(np.int64))
    ids = np.zeros(1 << limit, dtype=np.uint32)
    size = np.ones(1 << limit, dtype=np.uint8)
    total = int(spans.sum())
    ids[:total] = np.repeat(by, spans)
    size[:total] = np.repeat(lengths[by], spans)
    return ids, size


def pack_bits(ids: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The codes of ``ids`` end to end as u32 words (first bit highest), and each id's bit offset."""
    size = lengths[ids].astype(np.int64)
    ends = np.cumsum(size)
    at = ends - size
    total = int(ends[-1]) if len(ends) else 0
    words = np.zeros(total // 32 + 2, dtype=np.uint32)
    if len(ids):
        word = at >> 5
        wide = codes[ids].astype(np.uint64) << (64 - size - (at & 31)).astype(np.uint64)
        head = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        words[word[head]] |= np.bitwise_or.reduceat((wide >> np.uint64(32)).astype(np.uint32), head)
        words[word[head] + 1] |= np.bitwise_or.reduceat(wide.astype(np.uint32), head)
    return words, at


def pack_container(docs: list[tuple[int | None, np.ndarray]], lengths: np.ndarray, codes: np.ndarray, block_ids: int = BLOCK_IDS) -> bytes:
    ids = np.concatenate([d for _, d in docs])
    words, at = pack_bits(ids, lengths, codes)
    marks = at[::block_ids].astype("<u8")
    index = np.array([[NO_ID if k is None else k, len(d)] for k, d in docs], dtype="<i8")
    head = HEAD.pack(MAGIC, VERSION, len(ids), len(docs), block_ids, len(marks), len(words))
    return head + index.tobytes() + marks.tobytes() + words.astype("<u4").tobytes()


def unpack_container(blob: bytes, table: tuple[np.ndarray, np.ndarray], limit: int = MAX_BITS) -> tuple[np.ndarray, np.ndarray]:
    """The document index (doc_id, ids) and all ids of a container; its blocks decode side by side."""
    magic, version, n, n_docs, block, n_blocks, n_words = HEAD.unpack_from(blob)
    if magic != MAGIC or version != VERSION:
        raise ValueError("not a token container")
    at = HEAD.size
    index = np.frombuffer(blob, "<i8", 2 * n_docs, at).reshape(-1, 2)
    at += index.nbytes
    pos = np.frombuffer(blob, "<u8", n_blocks, at).astype(np.int64)
    at += 8 * n_blocks
    words = np.zeros(n_words + 2, dtype=np.uint64)
    words[:n_words] = np.frombuffer(blob, "<u4", n_words, at)
    ids, size = table
    out = np.zeros((n_blocks, block), dtype=np.uint32)
    last = n - (n_blocks - 1) * block if n_blocks else 0
    mask = np.uint64((1 << limit) - 1)
    for step in range(block if n_blocks else 0):
        if step == last:  # the last block is shorter
            pos = pos[:-1]
        if not len(pos):
            break
        w = pos >> 5
        window = (words[w] << np.uint64(32)) | words[w + 1]
        key = (window >> (64 - limit - (pos & 31)).astype(np.uint64)) & mask
        out[:len(pos), step] = ids[key]
        pos = pos + size[key]
    return index, out.reshape(-1)[:n]


def stage_ids(spark: SparkSession, scratch: Scratch, docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """doc_id and ids (binary, uint32 or, below 65536 ids, uint16) of every document, in the shared folder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, blobs, held = [], [], 0
        schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary())])
        for b, i, ids in tokens.encoded(batches, tokenizer, end_id):
            keys.append(b.column("doc_id")[i].as_py())
            blobs.append(ids.astype("<u2").tobytes() if narrow else ids.astype("<u4").tobytes())
            held += len(blobs[-1])
            if held > 1 << 22:
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(blobs, pa.binary())], schema=schema)
                keys, blobs, held = [], [], 0
        if keys:
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(blobs, pa.binary())], schema=schema)

    narrow = vocabulary(tokenizer, end_id) <= 1 << 16
    return scratch.table(documents(docs).mapInArrow(run, "doc_id long, ids binary"), "ids")


def vocabulary(tokenizer: str, end_id: int) -> int:
    return max(tokens.load(tokenizer).size(), end_id + 1)


def write_tokens(spark: SparkSession, docs: DataFrame, tokenizer: str, end_id: int, path: str | None = None) -> str:
    """Encode ``docs`` and write the containers and the codebook under ``path``; returns the path."""
    scratch = Scratch(spark, "tokens")
    path = path or scratch.path("files")
    size = vocabulary(tokenizer, end_id)
    kind = "<u2" if size <= 1 << 16 else "<u4"
    staged = stage_ids(spark, scratch, docs, tokenizer, end_id)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, dtype=np.int64)
        for b in batches:
            col = b.column("ids").cast(pa.large_binary())
            _, offs, data = col.buffers()
            off = np.frombuffer(offs, np.int64)[col.offset:col.offset + len(col) + 1]
            if len(col) and off[-1] > off[0]:
                total += np.bincount(np.frombuffer(data, np.uint8)[off[0]:off[-1]].view(kind), minlength=size)
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total[ids])], names=["id", "n"])

    # at most one row per vocabulary id reaches the driver
    rows = staged.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(size, dtype=np.int64)
    for r in rows:
        counts[r["id"]] = r["n"]
    lengths = code_lengths(counts)
    codes = canonical(lengths)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        held, n, before = [], 0, 0

        def flush():
            blob = pack_container(held, lengths, codes)
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int64()), pa.array([before], pa.int64()), pa.array([n], pa.int64()), pa.array([blob], pa.binary())],
                names=["part", "before", "n_ids", "container"])

        for b in batches:
            for k, x in zip(b.column("doc_id").to_pylist(), b.column("ids")):
                ids = np.frombuffer(x.as_buffer(), kind)
                held.append((k, ids))
                n += len(ids)
                if n >= CONTAINER_IDS:
                    yield flush()
                    held, n, before = [], 0, before + n
        if held:
            yield flush()

    ordered = staged.withColumn("tie", F.xxhash64("ids")).repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    (ordered.mapInArrow(write, "part long, before long, n_ids long, container binary")
     .write.option("compression", "none").parquet(f"{path}/containers"))
    spark.createDataFrame([(bytearray(lengths.tobytes()),)], "lengths binary").coalesce(1).write.parquet(f"{path}/codebook")
    scratch.drop(staged)
    return path


def read_tokens(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """Documents of a folder of containers: doc_id, start, n_tokens, ids_crc32 (and ids as little-endian uint32)."""
    boxes = spark.read.schema("part long, before long, n_ids long, container binary").parquet(f"{path}/containers")
    # one row per writing task: a prefix sum of few numbers
    sums = sorted((r["part"], r["n"]) for r in boxes.groupBy("part").agg(F.sum("n_ids").alias("n")).collect())
    base, so_far = {}, 0
    for part, n in sums:
        base[part] = so_far
        so_far += n
    lengths = np.frombuffer(bytes(spark.read.parquet(f"{path}/codebook").first()["lengths"]), dtype=np.uint8)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = decode_table(lengths)
        for b in batches:
            for part, before, box in zip(b.column("part").to_pylist(), b.column("before").to_pylist(), b.column("container")):
                index, ids = unpack_container(box.as_buffer().to_pybytes(), table)
                ends = np.cumsum(index[:, 1])
                starts = ends - index[:, 1]
                pieces = [ids[s:e] for s, e in zip(starts, ends)]
                cols = [pa.array([None if k == NO_ID else int(k) for k in index[:, 0]], pa.int64()),
                        pa.array(starts + (base[part] + before)), pa.array(index[:, 1].astype(np.int64)),
                        pa.array([tokens.crc(p) for p in pieces], pa.int64())]
                names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                if with_ids:
                    cols.append(pa.array([p.astype("<u4").tobytes() for p in pieces], pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names=names)

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids binary" if with_ids else "")
    return boxes.select("part", "before", "container").mapInArrow(run, schema)
