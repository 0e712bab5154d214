"""Toxicity: a small convolutional text classifier in numpy.

A word's embedding is the sum of the hashed embeddings of the word, three of
its prefixes and a suffix. Filters of width 1, 2 and 3 slide over the words,
the largest response of every filter over the whole text feeds a logistic
layer.

Training reads the whole text of every labelled row whose id is not held out,
in passes over a stored table. The first counts the texts of each label that
have a bucket; embeddings begin at its log-odds. Each of ``ROUNDS`` further
passes adds up the gradient over all rows (a task sends the sums of the buckets
that its texts touch, Spark adds them up) for one step of Adam. Sums are whole
numbers of 2**-GRADIENT_BITS, so their order does not matter. The driver holds
the model alone, of at most ``BUCKETS`` embeddings.

A fifth of these rows is not trained on; on all of it decision thresholds are
calibrated by language (``thresholds``). The language is guessed from the text by
common words, so that neither labels, lang, source nor doc_id enter a score; the
score is shifted so that the threshold of every language stands at ``DECISION``.

Defined cases: null and empty texts get the score of no words; a null doc_id
counts as not held out; labels null in either column are left out, and of
several labels of one id the largest is used, of several texts the smallest;
without labels of both kinds every score is the base rate; repeated rows score
alike; an empty table gives no rows. Other columns are not read (``reject``
passes them through).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.order import with_running
from . import textkit
from .common import Scratch, documents, ship_package

BUCKETS = 1 << 20
DIM = 8
FILTERS = 6
WIDTHS = (1, 2, 3)
MIN_COUNT = 4
ROUNDS = 8
RATE = 0.05
GRADIENT_BITS = 40
EPSILON = 1e-5
#: Rows of each label from which on they can decide a threshold.
FEWEST = 8
#: Longest text that takes a place where a caller bounds the rows.
BOUNDED_BYTES = 8192
DECISION = 0.7
FEATURES = 5
PREFIXES = (4, 5, 6)
SUFFIX = 4

# Common words by which a text's language is guessed.
COMMON_WORDS = {
    "en": ("the", "of", "and", "to", "in", "is", "that", "for", "with", "on"),
    "de": ("der", "die", "und", "das", "den", "ist", "nicht", "ein", "eine", "von"),
    "fr": ("le", "la", "les", "et", "des", "un", "une", "est", "dans", "pour"),
    "es": ("el", "los", "las", "y", "que", "en", "del", "una", "con", "por"),
}
LANGUAGES = tuple(COMMON_WORDS)

_EDGE = np.zeros(256, dtype=bool)
_EDGE[[i for i in range(33, 127) if not chr(i).isalnum()]] = True


def _buckets(h: np.ndarray, seed: int) -> np.ndarray:
    return (textkit.mix(h, seed) >> np.uint64(44)).astype(np.int32)


def _word_hash(word: str) -> int:
    c = next(textkit.chunks(pa.array([word])))
    s, e, _ = c.words()
    return int(_buckets(c.spans(c.sums(textkit.LOWER), s, e), 1)[0])


def language_table() -> np.ndarray:
    out = np.zeros(BUCKETS, dtype=np.int8)
    for i, lang in enumerate(LANGUAGES, 1):
        for w in COMMON_WORDS[lang]:
            out[_word_hash(w)] = i
    return out


def features(chunk: textkit.Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of every word (words x FEATURES), and the first word of each text."""
    starts, ends, first = chunk.words()
    sums = chunk.sums(textkit.LOWER)
    for _ in range(3):  # punctuation at the ends; a word of nothing else keeps its last sign
        ends = ends - ((ends - starts > 1) & _EDGE[chunk.buf[ends - 1]])
        starts = starts + ((ends - starts > 1) & _EDGE[chunk.buf[starts]])
    out = np.empty((len(starts), FEATURES), dtype=np.int32)
    out[:, 0] = _buckets(chunk.spans(sums, starts, ends), 1)
    for j, n in enumerate(PREFIXES, 1):
        out[:, j] = _buckets(chunk.spans(sums, starts, np.minimum(starts + n, ends)), 1 + j)
    out[:, FEATURES - 1] = _buckets(chunk.spans(sums, np.maximum(ends - SUFFIX, starts), ends), 1 + FEATURES)
    return out, first


class Network:
    """Embeddings of the buckets that occur often enough, filters, and the logistic layer."""

    def __init__(self, kept: np.ndarray, emb: np.ndarray, filters: list[np.ndarray], bias: np.ndarray, out: np.ndarray, base: float):
        self.kept, self.emb, self.filters, self.bias, self.out, self.base = kept, emb, filters, bias, out, base
        self._place = None

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_place"} | {"_place": None}

    def rows(self, feats: np.ndarray) -> np.ndarray:
        if self._place is None:  # bucket to row; row 0 is the embedding of nothing
            self._place = np.zeros(BUCKETS, dtype=np.int32)
            self._place[self.kept] = np.arange(1, len(self.kept) + 1)
        return self._place[feats]

    def embed(self, rows: np.ndarray) -> np.ndarray:
        x = self.emb[rows[:, 0]]
        for j in range(1, rows.shape[1]):
            x = x + self.emb[rows[:, j]]
        return x

    def responses(self, x: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per text the largest response of every filter, and the word where it begins."""
        n = len(first) - 1
        counts = np.diff(first)
        gap = max(WIDTHS) - 1
        at = np.arange(len(x)) + gap * np.repeat(np.arange(n), counts)
        padded = np.zeros((len(x) + gap * n + gap + 1, x.shape[1]), dtype=np.float32)
        padded[at] = x
        top = np.zeros((n, FILTERS * len(WIDTHS)), dtype=np.float32)
        where = np.zeros((n, FILTERS * len(WIDTHS)), dtype=np.int64)
        full = np.flatnonzero(counts)
        for k, w in enumerate(WIDTHS):
            r = padded[at] @ self.filters[k][0]
            for j in range(1, w):
                r = r + padded[at + j] @ self.filters[k][j]
            cols = slice(k * FILTERS, (k + 1) * FILTERS)
            if len(full):
                best = np.maximum.reduceat(r, first[full], axis=0)
                top[full, cols] = best
                if self._want_places:
                    own = np.repeat(np.arange(len(full)), counts[full])
                    for f in range(FILTERS):
                        hit = np.flatnonzero(r[:, f] == best[own, f])
                        texts = own[hit]
                        new = np.diff(texts, prepend=-1) > 0  # the first of a text
                        where[full[texts[new]], k * FILTERS + f] = hit[new]
        return top, where

    _want_places = False

    def parameters(self) -> np.ndarray:
        """All weights as rows of ``DIM`` numbers: the embeddings, then the rest, filled up with zeros."""
        rest = np.concatenate([self.out, self.bias, *[f.ravel() for f in self.filters]]).astype(np.float64)
        return np.concatenate([self.emb, np.pad(rest, (0, -len(rest) % DIM)).reshape(-1, DIM)])

    def with_parameters(self, values: np.ndarray) -> "Network":
        values = values.astype(np.float32)
        rest, at, parts = values[len(self.emb):].ravel(), 0, []
        for like in (self.out, self.bias, *self.filters):
            parts.append(rest[at:at + like.size].reshape(like.shape))
            at += like.size
        return Network(self.kept, values[:len(self.emb)], parts[2:], parts[1], parts[0], self.base)

    def gradient(self, feats: np.ndarray, first: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of ``parameters`` and their gradients of the weighted loss of some texts."""
        r = self.rows(feats)
        x = self.embed(r)
        self._want_places = True
        top, where = self.responses(x, first)
        self._want_places = False
        act = np.maximum(top + self.bias, 0)
        z = act @ self.out[:-1] + self.out[-1]
        g = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - labels) * weight
        g_act = np.outer(g, self.out[:-1]) * (act > 0) * (np.diff(first) > 0)[:, None]
        words, g_words = [np.zeros(0, np.int64)], [np.zeros((0, DIM))]
        g_filters = [np.zeros(f.shape) for f in self.filters]
        for k, w in enumerate(WIDTHS):
            for f in range(FILTERS):
                c = k * FILTERS + f
                on = np.flatnonzero(g_act[:, c])
                for j in range(w):
                    at = where[on, c] + j
                    inside = at < first[on + 1]
                    a, d = at[inside], on[inside]
                    g_filters[k][j, :, f] += g_act[d, c] @ x[a]
                    words.append(a)
                    g_words.append(g_act[d, c][:, None] * self.filters[k][j, :, f][None, :])
        a, inv = np.unique(np.concatenate(words), return_inverse=True)
        by_word = np.zeros((len(a), DIM))
        np.add.at(by_word, inv, np.concatenate(g_words))
        rows, inv = np.unique(r[a].ravel(), return_inverse=True)
        by_row = np.zeros((len(rows), DIM))
        np.add.at(by_row, inv, np.repeat(by_word, FEATURES, axis=0))
        seen = rows > 0  # row 0 is the embedding of nothing
        rest = np.concatenate([act.T @ g, [g.sum()], g_act.sum(axis=0), *[f.ravel() for f in g_filters]])
        rest = np.pad(rest, (0, -len(rest) % DIM)).reshape(-1, DIM)
        return np.concatenate([rows[seen], len(self.emb) + np.arange(len(rest))]), np.concatenate([by_row[seen], rest])

    def logits(self, feats: np.ndarray, first: np.ndarray) -> np.ndarray:
        top, _ = self.responses(self.embed(self.rows(feats)), first)
        return np.maximum(top + self.bias, 0) @ self.out[:-1] + self.out[-1]


def count_buckets(rows: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets that occur in ``MIN_COUNT`` texts or more, in how many texts, and in how many of label 1."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, bad = np.zeros(BUCKETS, dtype=np.int64), np.zeros(BUCKETS, dtype=np.int64)
        for b in batches:
            labels = b.column("label").to_numpy()
            for c in textkit.chunks(b.column("text")):
                feats, first = features(c)
                own = np.repeat(np.arange(c.lo, c.hi), np.diff(first))
                for j in range(FEATURES):
                    pairs = np.unique(own * BUCKETS + feats[:, j])
                    seen += np.bincount(pairs % BUCKETS, minlength=BUCKETS)
                    bad += np.bincount(pairs[labels[pairs // BUCKETS] == 1] % BUCKETS, minlength=BUCKETS)
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen[at]), pa.array(bad[at])], names=["bucket", "seen", "bad"])

    sums = rows.select("text", "label").mapInArrow(run, "bucket long, seen long, bad long")
    sums = sums.groupBy("bucket").agg(F.sum("seen").alias("seen"), F.sum("bad").alias("bad")).filter(F.col("seen") >= MIN_COUNT)
    got = sums.orderBy("bucket").toArrow()  # at most BUCKETS rows
    return tuple(got[c].to_numpy() for c in ("bucket", "seen", "bad"))


def start(kept: np.ndarray, seen: np.ndarray, bad: np.ndarray, p: int, q: int, seed: int = 7) -> Network:
    """A network whose embeddings begin at the smoothed log-odds of their bucket; ``p`` and ``q`` texts of labels 1 and 0."""
    rng = np.random.default_rng(seed)
    odds = np.log((bad + 0.5) / (p + 1)) - np.log((seen - bad + 0.5) / (q + 1))
    odds *= seen / (seen + 4.0)
    emb = np.zeros((len(kept) + 1, DIM), dtype=np.float32)
    emb[1:] = rng.normal(0, 0.02, (len(kept), DIM))
    emb[1:, 0] = np.clip(odds, -1, 3) / 3
    filters = [rng.normal(0, 0.1, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
    for f in filters:
        f[0, 0] += 1.0
    return Network(kept, emb, filters, np.full(FILTERS * len(WIDTHS), -1.0, dtype=np.float32),
                   np.concatenate([np.full(FILTERS * len(WIDTHS), 0.3), [-2.0]]).astype(np.float32), p / (p + q))


def gradient_sums(rows: DataFrame, net: Network, p: int, q: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``parameters`` and the gradients of the mean loss over all of ``rows``, both labels of equal weight."""
    sc = rows.sparkSession.sparkContext
    model = sc.broadcast(net)
    scale = float(1 << GRADIENT_BITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(model.value.parameters()), DIM), dtype=np.int64)
        for b in batches:
            labels = b.column("label").to_numpy()
            for c in textkit.chunks(b.column("text")):
                y = labels[c.lo:c.hi]
                at, g = model.value.gradient(*features(c), y, np.where(y == 1, 0.5 / max(p, 1), 0.5 / max(q, 1)))
                total[at] += np.rint(g * scale).astype(np.int64)
        at = np.flatnonzero(total.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(at), *[pa.array(total[at, i]) for i in range(DIM)]], names=["at", *[f"g{i}" for i in range(DIM)]])

    names = [f"g{i}" for i in range(DIM)]
    sums = rows.select("text", "label").mapInArrow(run, "at long, " + ", ".join(f"{c} long" for c in names))
    got = sums.groupBy("at").agg(*[F.sum(c).alias(c) for c in names]).toArrow()  # at most a row per embedding
    model.destroy()
    return got["at"].to_numpy(), np.stack([got[c].to_numpy() for c in names], axis=1) / scale


def train(rows: DataFrame, p: int, q: int, rounds: int = ROUNDS) -> Network:
    """Fit the network on all ``rows`` (text, label), of which ``p`` have label 1 and ``q`` label 0."""
    net = start(*count_buckets(rows), p, q)
    x = net.parameters()
    step, square = np.zeros_like(x), np.zeros_like(x)
    for t in range(1, rounds + 1):
        g = np.zeros_like(x)
        at, sums = gradient_sums(rows, net, p, q)
        g[at] = sums
        step, square = 0.9 * step + 0.1 * g, 0.99 * square + 0.01 * g * g
        rate = RATE * (1 - (t - 1) / rounds)
        x = x - rate * (step / (1 - 0.9 ** t)) / (np.sqrt(square / (1 - 0.99 ** t)) + EPSILON)
        net = net.with_parameters(x)
    return net


class Classifier:
    """A network with a threshold (as a logit) for each language of the text, and one for the rest."""

    def __init__(self, net: Network, thresholds: dict[str, float], default: float):
        self.net, self.default = net, default
        self.shift = np.array([default, *[thresholds.get(lang, default) for lang in LANGUAGES]])
        self._languages = None

    def __getstate__(self):
        return self.__dict__ | {"_languages": None}

    def languages(self, feats: np.ndarray, first: np.ndarray) -> np.ndarray:
        """0, or 1 + the place in LANGUAGES whose common words are most frequent."""
        if self._languages is None:
            self._languages = language_table()
        lang = self._languages[feats[:, 0]]
        n = len(first) - 1
        own = np.repeat(np.arange(n), np.diff(first))
        width = len(LANGUAGES) + 1
        counts = np.bincount(own * width + lang, minlength=n * width).reshape(n, width)
        counts[:, 0] = 0
        return counts.argmax(axis=1)

    def scores(self, chunk: textkit.Chunk) -> tuple[np.ndarray, np.ndarray]:
        feats, first = features(chunk)
        lang = self.languages(feats, first)
        z = self.net.logits(feats, first) - self.shift[lang] + np.log(DECISION / (1 - DECISION))
        return 1 / (1 + np.exp(-np.clip(z, -40, 40))), lang


def _constant(p: int, q: int) -> Classifier:
    base = p / (p + q) if p + q else 0.0
    z = np.log(max(base, 1e-6) / max(1 - base, 1e-6))
    net = Network(np.zeros(0, np.int64), np.zeros((1, DIM), np.float32), [np.zeros((w, DIM, FILTERS), np.float32) for w in WIDTHS],
                  np.zeros(FILTERS * len(WIDTHS), np.float32), np.concatenate([np.zeros(FILTERS * len(WIDTHS)), [z]]).astype(np.float32), base)
    return Classifier(net, {}, float(np.log(DECISION / (1 - DECISION))))


def held_out(doc_id):
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 3 == 1


def labelled(docs: DataFrame, labels: DataFrame, rows: int | None = None) -> DataFrame:
    """doc_id, label, text, calibrate: a row per labelled id that is not held out and has a document, with its whole text."""
    own = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("label"))
           .filter(F.col("label").isNotNull() & F.col("doc_id").isNotNull()).filter(~held_out(F.col("doc_id")))
           .groupBy("doc_id").agg((F.max("label") == 1).cast("int").alias("label")))
    if rows is not None:
        h = F.xxhash64("doc_id")
        docs = documents(docs).filter(F.octet_length("text") <= BOUNDED_BYTES)
        own = own.join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
        own = (own.filter("label = 1").orderBy(h, "doc_id").limit(rows // 4)
               .unionByName(own.filter("label = 0").orderBy(h, "doc_id").limit(rows - rows // 4)))
    return (documents(docs).join(own, "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
            .withColumn("calibrate", F.pmod(F.xxhash64("doc_id"), F.lit(5)) == 4))


def thresholds(logits: DataFrame) -> dict[str, float]:
    """For each language (and "" for all rows) of ``logits`` (language, z, label): midway in the gap of logits below which
    F1 is best over all its rows; none with too few of either label."""
    every = logits.select(F.coalesce("language", F.lit("-")).alias("lang"), "z", "label")
    every = every.unionByName(every.withColumn("lang", F.lit("")))
    steps = every.groupBy("lang", "z").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("hits"))
    sizes = steps.groupBy("lang").agg(F.sum("n").alias("all"), F.sum("hits").alias("hit")).orderBy("lang").collect()  # a row a language
    good = [r for r in sizes if r["lang"] != "-" and r["hit"] >= FEWEST and r["all"] - r["hit"] >= FEWEST]
    if not good:
        return {}
    before, n, hits = {}, 0, 0
    for r in sizes:
        before[r["lang"]] = (n, hits)
        n, hits = n + r["all"], hits + r["hit"]
    so_far = with_running(steps, ["lang", F.desc("z")], {"n_above": "n", "hits_above": "hits"}, "place")
    facts = F.broadcast(logits.sparkSession.createDataFrame([(r["lang"], *before[r["lang"]], r["hit"]) for r in good],
                                                            "lang string, n_before long, hits_before long, hit long"))
    f1 = 2 * (F.col("hits_above") - F.col("hits_before")) / (F.col("n_above") - F.col("n_before") + F.col("hit"))
    ranked = so_far.join(facts, "lang").select("lang", "z", "place", f1.alias("f1")).checkpoint()
    best = ranked.groupBy("lang").agg(F.max(F.struct("f1", (-F.col("place")).alias("first"), "z")).alias("best"))
    best = {r["lang"]: (r["best"]["z"], -r["best"]["first"]) for r in best.collect()}
    after = F.lit(False)
    for lang, (_, place) in best.items():
        after = after | ((F.col("lang") == lang) & (F.col("place") == place + 1))
    below = {r["lang"]: r["z"] for r in ranked.filter(after).collect()}
    return {lang: (z + below.get(lang, z - 2.0)) / 2 for lang, (z, _) in best.items()}


def logits_of(rows: DataFrame, clf: Classifier) -> DataFrame:
    """language (guessed from the text), z, label of ``rows`` (text, label), before any threshold."""
    model = rows.sparkSession.sparkContext.broadcast(clf)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for c in textkit.chunks(b.column("text")):
                feats, first = features(c)
                lang = model.value.languages(feats, first)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([None if i == 0 else LANGUAGES[i - 1] for i in lang], pa.string()),
                     pa.array(model.value.net.logits(feats, first).astype(np.float64)), b.column("label").slice(c.lo, c.hi - c.lo)],
                    names=["language", "z", "label"])

    return rows.select("text", "label").mapInArrow(run, "language string, z double, label int")


def fit(docs: DataFrame, labels: DataFrame, rows: int | None = None) -> Classifier:
    """Train and calibrate on all labelled texts whose ids are not held out; no query bounds them
    (``rows``: at most so many, of at most ``BOUNDED_BYTES`` bytes, for callers that ask for it)."""
    scratch = Scratch(docs.sparkSession, "toxicity")
    table = scratch.table(labelled(docs, labels, rows), "labelled")
    sizes = {(r["calibrate"], r["label"]): r["n"] for r in table.groupBy("calibrate", "label").agg(F.count(F.lit(1)).alias("n")).collect()}
    p, q = (sum(n for (_, y), n in sizes.items() if y == label) for label in (1, 0))
    if p < 4 or q < 4:
        return _constant(p, q)
    net = train(table.filter("NOT calibrate"), *(sizes.get((False, label), 0) for label in (1, 0)))
    found = thresholds(scratch.table(logits_of(table.filter("calibrate"), Classifier(net, {}, 0.0)), "logits"))
    scratch.drop(table)
    default = found.pop("", 0.0)
    return Classifier(net, found, default)


def score(spark: SparkSession, docs: DataFrame, clf: Classifier) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted, language (guessed from the text)."""
    ship_package(spark)
    model = spark.sparkContext.broadcast(clf)  # at most BUCKETS embeddings

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for c in textkit.chunks(b.column("text")):
                s, lang = model.value.scores(c)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(c.lo, c.hi - c.lo), pa.array(s.astype(np.float64)),
                     pa.array([None if i == 0 else LANGUAGES[i - 1] for i in lang], pa.string())], names=["doc_id", "score", "language"])

    out = documents(docs).mapInArrow(run, "doc_id long, score double, language string")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                      (F.col("score") >= DECISION).cast("int").alias("predicted"), "language")


def reject(spark: SparkSession, docs: DataFrame, clf: Classifier) -> DataFrame:
    """``docs`` without the rows predicted toxic; all columns stay."""
    ship_package(spark)
    model = spark.sparkContext.broadcast(clf)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for c in textkit.chunks(b.column(at)):
                s, _ = model.value.scores(c)
                yield b.slice(c.lo, c.hi - c.lo).filter(pa.array(s < DECISION))

    return docs.mapInArrow(run, docs.schema)
