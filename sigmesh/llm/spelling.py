"""Spelling variants: words that differ by one inserted, deleted or replaced code point.

Words are counted by Spark over all texts. Near words are found by dense tiles:
padded matrices of code points, one row a word, compare every word of one block
with every word of another, position by position from the left and from the
right. Two different words are near exactly when their common prefix and suffix
together reach the longer length minus one.

Blocks come from the same fact: prefix or suffix reaches half of that, so a word
of m letters joins, as the longer word (n = m) and as the shorter one or one of
equal length (n = m + 1), the buckets of its first and of its last
ceil((n - 1) / 2) letters; a pair met in both buckets counts in the first only.
A bucket of more than ``BLOCK`` words is cut into blocks, and each pair of its
blocks is a tile of its own, so no task holds more than a few blocks. Work is
quadratic inside a bucket only. A tile returns, for each word, how many near
words it met and the best of them, never the pairs; Spark adds these up.

Each word's form is its near word of largest count (ties: smallest in code-point
order) if that count is at least twice its own; ``root`` follows forms to the
last one. Counts at least double along the way, so there are no cycles and
pointer doubling ends after a few rounds.

Defined cases: a null text has no words; a null doc_id counts as an empty one in
the hash of a run; repeated rows count each; an empty table, or one without
words, gives an empty result. A text is split whole inside one row. Columns
other than doc_id and text are not read.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, documents

#: Fixed value: what stands between runs of letters.
NOT_RUN = r"[^A-Za-z\u00C0-\u00FF]+"
MIN_LETTERS = 5
MIN_COUNT = 3
FAULT = 97
TIMES = 2
#: Words of one block of a bucket.
BLOCK = 4096
#: Rows (a word in one of its buckets) of a task, on average.
TASK_ROWS = 25_000
#: Cells (pairs of words) of one step of a tile.
CELLS = 1 << 21


def words(docs: DataFrame, min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT, fault: int = FAULT) -> DataFrame:
    """Counted words of all texts: word, n.

    Runs of letters with A-Z lower-cased; where ``fault`` divides the CRC-32 h of
    ``<doc_id>:<run>``, the run's code point h % length is left out.
    """
    d = documents(docs)
    runs = d.select("doc_id", F.explode(F.split(F.translate("text", string.ascii_uppercase, string.ascii_lowercase), NOT_RUN)).alias("run"))
    runs = runs.filter(F.col("run") != "")
    runs = runs.withColumn("h", F.crc32(F.encode(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "run"), "UTF-8")))
    at = F.pmod("h", F.length("run").cast("long")).cast("int")
    cut = F.concat(F.left("run", at), F.substring("run", at + 2, F.length("run")))
    word = F.when(F.pmod("h", F.lit(fault)) == 0, cut).otherwise(F.col("run"))
    runs = runs.select(word.alias("word")).filter(F.length("word") >= min_letters)
    return runs.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_count)


def _keyed(vocabulary: DataFrame) -> DataFrame:
    """A row for each bucket of a word: longer (the longer length), back (0: by prefix, 1: by suffix), affix."""
    size = F.length("word")

    def bucket(longer, back: int):
        half = F.ceil((longer - 1) / 2).cast("int")
        affix = F.left("word", half) if not back else F.right("word", half)
        return F.struct(longer.alias("longer"), F.lit(back).alias("back"), affix.alias("affix"))
    keys = F.array(*[bucket(size + one, back) for one in (0, 1) for back in (0, 1)])
    return vocabulary.select("word", "n", F.explode(keys).alias("k")).select("word", "n", "k.*")


def _tiles(vocabulary: DataFrame, block: int) -> DataFrame:
    """Words with the tile they go to (i <= j: blocks of the bucket) and the block that they are in."""
    keyed = _keyed(vocabulary)
    key = ["longer", "back", "affix"]
    sizes = keyed.groupBy(*key).agg(F.count(F.lit(1)).alias("size"))
    # a bucket without a second word has no pair
    rows = keyed.join(sizes.filter("size > 1"), key)
    rows = rows.withColumn("blocks", F.ceil(F.col("size") / F.lit(block)).cast("int"))
    rows = rows.withColumn("b", F.pmod(F.xxhash64("word"), F.col("blocks").cast("long")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return rows.select(*key, F.least("b", "other").alias("i"), F.greatest("b", "other").alias("j"), "b", "word", "n")


def _matrix(texts: list[str], back: bool) -> np.ndarray:
    """Code points of each text in a row, padded with zeros; read from the end where ``back``."""
    lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    points = np.frombuffer("".join(texts).encode("utf-32-le"), dtype="<u4")
    first = np.concatenate([[0], np.cumsum(lengths)])
    row = np.repeat(np.arange(len(texts)), lengths)
    col = np.arange(len(points)) - first[row]
    if back:
        col = lengths[row] - 1 - col
    out = np.zeros((len(texts), int(lengths.max(initial=0))), dtype=np.uint8 if points.max(initial=0) < 256 else np.uint32)
    out[row, col] = points
    return out


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common start of each row of ``a`` with each row of ``b`` (rows padded with zeros)."""
    out = np.zeros((len(a), len(b)), dtype=np.uint8 if a.shape[1] < 256 else np.int32)
    alive = np.ones((len(a), len(b)), dtype=bool)
    for k in range(min(a.shape[1], b.shape[1])):
        alive &= (a[:, k, None] == b[None, :, k]) & (a[:, k] != 0)[:, None]
        if not alive.any():
            break
        out += alive
    return out


def _near(ahead: np.ndarray, behind: np.ndarray, size: np.ndarray, rows: np.ndarray, cols: np.ndarray, longer: int, back: int) -> np.ndarray:
    """Which of ``rows`` are near which of ``cols``: words of length ``longer`` or one less, of one bucket."""
    half = -(-(longer - 1) // 2)
    # the bucket's own affix is common to all: only what lies beyond it is compared
    start = _common(ahead[rows, 0 if back else half:], ahead[cols, 0 if back else half:]).astype(np.int32) + (0 if back else half)
    end = _common(behind[rows, half if back else 0:], behind[cols, half if back else 0:]).astype(np.int32) + (half if back else 0)
    one = size[rows][:, None] + size[cols][None, :] >= 2 * longer - 1  # one at least has the longer length
    found = (start + end >= longer - 1) & one
    if back:
        found &= start < half  # else it counts in the bucket of the prefix
    same = size[rows][:, None] == size[cols][None, :]
    whole = np.minimum(size[rows][:, None], size[cols][None, :])
    return found & ~(same & (start >= whole))  # a word is not near itself


class _Best:
    """For each word of a tile: near words met, and the best of them (largest n, then smallest word)."""

    def __init__(self, n: np.ndarray, order: np.ndarray):
        self.n, self.order = n, order
        self.count = np.zeros(len(n), dtype=np.int64)
        self.best = np.full(len(n), -1, dtype=np.int64)

    def add(self, found: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> None:
        r, c = np.nonzero(found)
        r, c = rows[r], cols[c]
        np.add.at(self.count, r, 1)
        by = np.lexsort((self.order[c], -self.n[c], r))
        r, c = r[by], c[by]
        first = np.flatnonzero(np.diff(r, prepend=-1))
        for w, x in zip(r[first], c[first]):
            y = self.best[w]
            if y < 0 or (-self.n[x], self.order[x]) < (-self.n[y], self.order[y]):
                self.best[w] = x


def tile(texts: list[str], n: np.ndarray, block: np.ndarray, longer: int, back: int, i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
    """Near words of each word of a tile: how many, and the index of the best (-1: none).

    Tile (i, i) compares a block with itself, (i, j) each word of the one with each of the other.
    """
    size = np.fromiter(map(len, texts), dtype=np.int32, count=len(texts))
    ahead, behind = _matrix(texts, False), _matrix(texts, True)
    order = np.empty(len(texts), dtype=np.int64)
    order[np.argsort(np.array(texts, dtype=object), kind="stable")] = np.arange(len(texts))
    best = _Best(n, order)
    left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
    step = max(1, CELLS // max(1, len(right)))
    for k in range(0, len(left), step):
        rows = left[k:k + step]
        found = _near(ahead, behind, size, rows, right, longer, back)
        best.add(found, rows, right)
        if i != j:
            best.add(found.T, right, rows)
    return best.count, best.best


_KEY = ["longer", "back", "affix", "i", "j"]
_FOUND = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("near", pa.string()), ("near_n", pa.int64())])


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, pa.Table]]:
    """Runs of rows of one tile; rows come sorted by tile, and one may span batches."""
    held: list[pa.RecordBatch] = []
    held_key = None
    for batch in batches:
        if not batch.num_rows:
            continue
        change = np.zeros(batch.num_rows, dtype=bool)
        for c in _KEY:
            col = batch.column(c)
            codes = col.dictionary_encode().indices.to_numpy() if pa.types.is_string(col.type) else col.to_numpy()
            change[1:] |= codes[1:] != codes[:-1]
        edges = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for a, b in zip(edges, edges[1:]):
            key = tuple(batch.column(c)[a].as_py() for c in _KEY)
            if key != held_key and held:
                yield held_key, pa.Table.from_batches(held)
                held = []
            held_key = key
            held.append(batch.slice(a, b - a))
    if held:
        yield held_key, pa.Table.from_batches(held)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out: list[list] = [[], [], [], []]
    for (longer, back, _, i, j), t in _groups(batches):
        texts = t.column("word").to_pylist()
        n = t.column("n").to_numpy()
        counts, best = tile(texts, n, t.column("b").to_numpy(), longer, back, i, j)
        for w in np.flatnonzero(counts).tolist():
            x = int(best[w])
            for col, v in zip(out, (texts[w], int(counts[w]), texts[x], int(n[x]))):
                col.append(v)
        if len(out[0]) >= 10_000:
            yield pa.record_batch(out, schema=_FOUND)
            out = [[], [], [], []]
    yield pa.record_batch(out, schema=_FOUND)


def near_words(vocabulary: DataFrame, block: int = BLOCK) -> DataFrame:
    """Words with near words: word, n_near, near (the best one) and near_n."""
    # a number of its own: the rows are small but dear, and would be coalesced by their size
    parts = max(1, -(-4 * vocabulary.count() // TASK_ROWS))
    tiles = _tiles(vocabulary, block).repartition(parts, *_KEY).sortWithinPartitions(*_KEY)
    met = tiles.mapInArrow(_compare, "word string, n_near long, near string, near_n long")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near")))
    return (met.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
            .select("word", "n_near", F.col("best.near").alias("near"), (-F.col("best.less")).alias("near_n")))


def variants(spark: SparkSession, docs: DataFrame, times: int = TIMES, block: int = BLOCK, **options) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n."""
    scratch = Scratch(spark, "spelling")
    vocabulary = scratch.table(words(docs, **options), "words")
    near = near_words(vocabulary, block)
    joined = vocabulary.join(near, "word", "left")
    has = F.col("near_n") >= times * F.col("n")
    out = scratch.table(joined.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                                      F.when(has, F.col("near")).alias("form"), F.when(has, F.col("near_n")).alias("form_n")), "forms")
    # pointer doubling over the words that have a form
    up = out.filter("form IS NOT NULL").select("word", F.col("form").alias("root"))
    step = 0
    while True:
        step += 1
        nxt = up.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        moved = up.join(nxt, "root", "left")
        new = scratch.table(moved.select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved")), f"roots-{step}")
        if new.filter("moved").isEmpty():
            break
        up = new.select("word", "root")
    return (out.join(up, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
