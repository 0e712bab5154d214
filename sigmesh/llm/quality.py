"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger keeps the raw
measurements and one failure bit per rule; a policy is a named, versioned
mask of bits. Verdicts and ablations (what a policy would reject without one
of its rules) need only bitwise arithmetic on the ledger, never the texts.

Defined cases: null text counts as empty (0 words, fails ``few_words``); an
empty table gives an empty ledger; rows are treated one by one, so repeated
rows repeat; columns other than doc_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textkit
from .common import Scratch, documents

WINDOW = 8
SYMBOLS = b"#*$%&|<>"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
            "n_lines", "n_upper", "n_letters", "n_marks", "n_same_words", "longest_word")
LEDGER_SCHEMA = "doc_id long, " + ", ".join(f"{m} long" for m in MEASURES) + ", failed long"

#: Rule of bit i: a name and a test on the measurements (integer arithmetic only).
RULES = (
    ("few_words", lambda m: m["n_words"] < 20),
    ("repeated_words", lambda m: 100 * m["n_repeat_words"] > 30 * m["n_words"]),
    ("symbols", lambda m: 100 * m["n_symbols"] > 10 * m["n_words"]),
    ("duplicate_lines", lambda m: (100 * m["n_dup_lines"] > 50 * m["n_lines"]) & (m["n_dup_lines"] >= 3)),
    ("upper_case", lambda m: 100 * m["n_upper"] > 40 * m["n_letters"]),
    ("exclamations", lambda m: 100 * m["n_marks"] > 50 * m["n_words"]),
    ("same_word_runs", lambda m: 100 * m["n_same_words"] > 50 * m["n_words"]),
    ("long_words", lambda m: 100 * m["word_chars"] > 2500 * m["n_words"]),
)
BIT = {name: 1 << i for i, (name, _) in enumerate(RULES)}
#: Versioned policies: the rules that reject a document.
POLICIES = {
    "base-1": ("few_words", "repeated_words"),
    "strict-1": ("few_words", "repeated_words", "symbols", "duplicate_lines", "upper_case", "exclamations", "same_word_runs", "long_words"),
}


def policy_mask(policy: str) -> int:
    return sum(BIT[r] for r in POLICIES[policy])


_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(SYMBOLS)] = True
_HEAD = np.ones(256, dtype=bool)  # bytes that begin a code point
_HEAD[128:192] = False


def _per_text(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def _repeated(h: np.ndarray, text: np.ndarray) -> np.ndarray:
    """For each item: is its hash found twice or more in its text?"""
    order = np.lexsort((h, text))
    a, t = h[order], text[order]
    same = np.zeros(len(a) + 1, dtype=bool)
    same[1:-1] = (a[1:] == a[:-1]) & (t[1:] == t[:-1])
    out = np.zeros(len(a), dtype=bool)
    out[order] = same[1:] | same[:-1]
    return out


def _later_equal(h: np.ndarray, text: np.ndarray) -> np.ndarray:
    """For each item: is it equal to an earlier item of its text?"""
    order = np.lexsort((h, text))  # stable, so the first of equals comes first
    a, t = h[order], text[order]
    out = np.zeros(len(a), dtype=bool)
    if len(a):
        out[order[1:]] = (a[1:] == a[:-1]) & (t[1:] == t[:-1])
    return out


def measure(chunk: textkit.Chunk) -> dict[str, np.ndarray]:
    """All measurements of the texts of a chunk."""
    buf, off = chunk.buf, chunk.off
    n = len(off) - 1
    starts, ends, first = chunk.words()
    sums = chunk.sums()
    m = {"n_words": np.diff(first)}
    heads = np.concatenate([[0], np.cumsum(_HEAD[buf], dtype=np.int64)])
    chars = heads[ends] - heads[starts]
    m["word_chars"] = _per_text(chars, first)
    m["n_symbols"] = _per_text(_SYMBOL[buf], off)
    m["n_marks"] = _per_text(buf == 33, off)
    # letters of the ASCII and Latin-1 ranges: enough to tell capitals from small letters
    lead = np.zeros(len(buf), dtype=bool)
    lead[1:] = buf[:-1] == 0xC3
    upper = ((buf >= 65) & (buf <= 90)) | (lead & (buf >= 0x80) & (buf <= 0x9E) & (buf != 0x97))
    lower = ((buf >= 97) & (buf <= 122)) | (lead & (buf >= 0x9F) & (buf != 0xB7))
    m["n_upper"], m["n_letters"] = _per_text(upper, off), _per_text(upper | lower, off)
    m["longest_word"] = np.array([int(chars[a:b].max()) if b > a else 0 for a, b in zip(first[:-1], first[1:])], dtype=np.int64)

    h = chunk.spans(sums, starts, ends)
    text = np.repeat(np.arange(n), np.diff(first))
    again = np.zeros(len(h), dtype=bool)
    again[1:] = (h[1:] == h[:-1]) & (text[1:] == text[:-1])
    m["n_same_words"] = _per_text(again, first)

    pos, begin = textkit.windows(first, WINDOW)
    twice = _repeated(textkit.combine(h, pos, WINDOW), np.repeat(np.arange(n), np.diff(begin)))
    cover = np.zeros(len(h) + 1, dtype=np.int64)
    np.add.at(cover, pos[twice], 1)
    np.add.at(cover, pos[twice] + WINDOW, -1)
    m["n_repeat_words"] = _per_text(np.cumsum(cover[:-1]) > 0, first)

    # lines: between line feeds, and at both ends of a text
    feed = np.flatnonzero(buf == 10)
    begins = np.sort(np.concatenate([off[:-1], feed + 1]), kind="stable")
    line_text = np.repeat(np.arange(n), 1 + _per_text(buf == 10, off))
    stops = np.sort(np.concatenate([off[1:], feed]), kind="stable")
    m["n_lines"] = 1 + _per_text(buf == 10, off)
    worded = np.searchsorted(starts, stops) > np.searchsorted(starts, begins)
    lh = chunk.spans(sums, begins, stops)[worded]
    lt = line_text[worded]
    m["n_dup_lines"] = np.bincount(lt[_later_equal(lh, lt)], minlength=n).astype(np.int64)
    return m


def _ledger_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), *[(x, pa.int64()) for x in MEASURES], ("failed", pa.int64())])
    for b in batches:
        for c in textkit.chunks(b.column("text")):
            m = measure(c)
            bits = np.zeros(c.hi - c.lo, dtype=np.int64)
            for i, (_, fails) in enumerate(RULES):
                bits |= fails(m).astype(np.int64) << i
            ids = b.column("doc_id").slice(c.lo, c.hi - c.lo)
            yield pa.RecordBatch.from_arrays([ids, *[pa.array(m[x].astype(np.int64)) for x in MEASURES], pa.array(bits)], schema=schema)


def ledger(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One row per document: measurements and failure bits, written once to the shared folder."""
    rows = documents(docs).mapInArrow(_ledger_batches, LEDGER_SCHEMA)
    return Scratch(spark, "quality").table(rows, "ledger")


def verdicts(rows: DataFrame, policy: str = "strict-1") -> DataFrame:
    """The ledger with base_failed and kept under a policy."""
    base, mask = policy_mask("base-1"), policy_mask(policy)
    return (rows.withColumn("base_failed", F.col("failed").bitwiseAND(F.lit(base)) != 0)
            .withColumn("kept", F.col("failed").bitwiseAND(F.lit(base | mask)) == 0))


def ablations(rows: DataFrame, policy: str = "strict-1") -> DataFrame:
    """Per rule of a policy: documents it fails, rejects alone, and rejects left without it.

    The ledger shrinks to one row per pattern of bits (at most 2^rules) before anything else.
    """
    mask = policy_mask(policy)
    patterns = rows.groupBy("failed").agg(F.count(F.lit(1)).alias("n"))
    names = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(BIT[r]).cast("long").alias("bit")) for r in POLICIES[policy]]))
    x = patterns.select("failed", "n", names.alias("r")).select("failed", "n", "r.rule", "r.bit")
    hit = F.col("failed").bitwiseAND(F.col("bit")) != 0
    inside = F.col("failed").bitwiseAND(F.lit(mask))
    rest = inside.bitwiseAND(F.bitwise_not(F.col("bit")))
    count = lambda c, name: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0)).alias(name)
    return x.groupBy("rule").agg(count(hit, "failing"), count(hit & (rest == 0), "only_by_it"), count(rest != 0, "rejected_without_it"))
