"""Packing documents into sequences of a fixed number of tokens.

Texts are encoded once. A document longer than a sequence is cut into full
pieces and a rest. Pieces are dealt into random groups of bounded token
count; in each group first-fit decreasing places them, with a tournament tree
over bin capacities that finds the first bin with room in logarithmic time.
Unopened bins stand in the tree with full capacity, so a piece that fits
nowhere opens the next bin by itself. Only (id, start, length, crc) rows
move; groups are independent tasks.

Defined cases: null text counts as empty and packs its end id only; repeated
rows are packed each; a null doc_id packs like any other; an empty table
gives no piece. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import tokens
from .common import Scratch, documents

SEQUENCE = 2048
GROUP_TOKENS = 1 << 21
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, deal long"
PLACED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class CapacityTree:
    """Leftmost of ``n`` bins with enough room."""

    def __init__(self, n: int, capacity: int):
        self.size = 1 << max(0, (n - 1).bit_length())
        self.best = [capacity] * (2 * self.size)

    def place(self, need: int) -> tuple[int, int]:
        """Put ``need`` into the first bin with room: the bin, and the room it had."""
        best, i = self.best, 1
        while i < self.size:
            i *= 2
            if best[i] < need:
                i += 1
        room = best[i]
        best[i] = room - need
        at, i = i - self.size, i >> 1
        while i:
            top = max(best[2 * i], best[2 * i + 1])
            if best[i] == top:
                break
            best[i] = top
            i >>= 1
        return at, room


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length; ``lengths`` must be in descending order."""
    bins = np.empty(len(lengths), dtype=np.int64)
    offs = np.zeros(len(lengths), dtype=np.int64)
    full = int(np.searchsorted(-lengths, -capacity, side="right"))
    bins[:full] = np.arange(full)
    rest = lengths[full:].tolist()
    if rest:
        tree = CapacityTree(len(rest), capacity)
        for i, n in enumerate(rest, full):
            at, room = tree.place(n)
            bins[i], offs[i] = full + at, capacity - room
    return bins, offs


def pieces(spark: SparkSession, docs: DataFrame, tokenizer: str, end_id: int, capacity: int = SEQUENCE, with_ids: bool = False) -> DataFrame:
    """Pieces of at most ``capacity`` ids of every document, staged in the shared folder."""
    schema = PIECES + (", ids binary" if with_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        seed = TaskContext.get().partitionId()
        cols: list[list] = [[] for _ in range(7)]
        n_rows = 0

        def flush():
            nonlocal cols
            arrays = [pa.array(c, pa.int64()) for c in cols[:6]] + ([pa.array(cols[6], pa.binary())] if with_ids else [])
            names = [x.split()[0] for x in schema.split(", ")]
            cols = [[] for _ in range(7)]
            return pa.RecordBatch.from_arrays(arrays, names=names)

        for b, i, ids in tokens.encoded(batches, tokenizer, end_id):
            key = b.column("doc_id")[i].as_py()
            for s in range(0, len(ids), capacity):
                part = ids[s:s + capacity]
                n_rows += 1
                row = (key, s, len(part), tokens.crc(part), len(ids), seed << 33 | n_rows)
                for c, v in zip(cols, row):
                    c.append(v)
                if with_ids:
                    cols[6].append(part.tobytes())
            if len(cols[0]) >= 4096 or with_ids and len(cols[0]) >= 256:
                yield flush()
        if cols[0]:
            yield flush()

    return Scratch(spark, "packing").table(documents(docs).mapInArrow(run, schema), "pieces")


def place(parts: DataFrame, capacity: int = SEQUENCE, group_tokens: int = GROUP_TOKENS) -> DataFrame:
    """Sequence and offset of every piece."""
    total = parts.agg(F.sum("length")).first()[0] or 0
    groups = max(1, -(-int(total) // group_tokens))

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "doc_id", "start", "ids_crc32"], ascending=[False, True, True, True], kind="stable")
        bins, offs = first_fit_decreasing(pdf["length"].to_numpy(), capacity)
        pdf["sequence_id"] = pdf["grp"].to_numpy() * (1 << 32) + bins
        pdf["offset"] = offs
        return pdf[["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]]

    dealt = parts.select("doc_id", "start", "length", "ids_crc32", "doc_tokens",
                         F.pmod(F.xxhash64("deal"), F.lit(groups)).alias("grp"))
    return dealt.groupBy("grp").applyInPandas(pack, PLACED)


def pack_documents(spark: SparkSession, docs: DataFrame, tokenizer: str, end_id: int, capacity: int = SEQUENCE) -> DataFrame:
    """One row per piece: where its ids stand in which sequence."""
    return place(pieces(spark, docs, tokenizer, end_id, capacity), capacity)


def sequences(spark: SparkSession, docs: DataFrame, tokenizer: str, end_id: int, pad_id: int = 0, capacity: int = SEQUENCE) -> DataFrame:
    """The packed sequences themselves: sequence_id, length, ids (binary, little-endian uint32, padded).

    A sequence is padded to ``capacity`` unless its length is a power of two.
    """
    parts = pieces(spark, docs, tokenizer, end_id, capacity, with_ids=True)
    key = ["doc_id", "start", "ids_crc32"]
    own = parts.select(*key, "ids").groupBy(*key).agg(F.first("ids").alias("ids"))
    placed = place(parts, capacity)
    same = [placed[k].eqNullSafe(own[k]) for k in key]
    rows = placed.join(own, same[0] & same[1] & same[2]).select("sequence_id", "offset", "length", "ids")
    one = rows.groupBy("sequence_id").agg(F.sum("length").alias("length"), F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("p"))
    whole = F.aggregate("p", F.lit(b"").cast("binary"), lambda a, x: F.concat(a, x["ids"]))
    pad = F.when(F.bit_count("length") == 1, F.lit(0)).otherwise(F.lit(capacity) - F.col("length")).cast("int")
    zero = F.unhex(F.lit(int(pad_id).to_bytes(4, "little").hex()))
    return one.select("sequence_id", "length", F.concat(whole, F.unhex(F.repeat(F.hex(zero), pad))).alias("ids"))
