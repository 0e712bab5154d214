"""Mixing sources to target weights by soft membership (DataFrame functions only).

A labelled table (doc_id, domain) teaches a naive Bayes classifier on binned
text statistics and on marker words per domain; it is fitted on a bounded
sample of ``FIT_ROWS`` labelled rows (smallest hashes of doc_id). Every
document then has a posterior over the domains, and its words (tokens) count
for each domain by that share.

Rates per document, not negative, are fitted by projected least squares so
that the expected domain totals match the targets. The gradient is
preconditioned by the document length, so a document's rate is the common
start less the product of its posterior with one multiplier per domain, cut
off at 0. Newton steps (the domains' Gram matrix over the documents not cut
off, with step halving) find the multipliers. A round is one aggregation of a
handful of sums over the distinct posteriors, whose number the bins bound.
Rounds end when every domain is within ``CLOSE`` of its own target, or when
the residuals prove that no rates come closer; what then remains is warned
of and stands in the metadata of the column ``rate``.

Defined cases: null text counts as empty; a text without words has no tokens
and keeps the rate of its posterior (a null doc_id likewise); label rows with
null id or domain are left out; domains that no sampled label names are left
out and the other targets rescaled; without any label, or without tokens,
every rate is 1; repeated rows are rated each; an empty table gives no rows.
Other columns are not read (``thin`` passes them through).
"""

from __future__ import annotations

import math
import warnings

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch

FIT_ROWS = 6000
MARKERS = 64
MARKER_DOCS = 4
ROUNDS = 200
CLOSE = 1e-4
BEST = 1e-3
RIDGE = 1e-7
PREFIX = 5
SMOOTH = 0.5

#: Edges of the bins of each text statistic.
BINS = {
    "symbols": (0.01, 0.1, 0.3, 1.0, 2.0),
    "marks": (0.01, 0.1, 0.5, 1.5),
    "capitals": (0.01, 0.03, 0.08, 0.2, 0.5),
    "distinct": (0.1, 0.25, 0.4, 0.6, 0.8),
    "word_length": (4.0, 5.0, 6.0, 7.0, 8.0),
}


def _bin(value: Column, edges) -> Column:
    return F.size(F.filter(_array(edges), lambda edge: value >= edge))


def _statistics(df: DataFrame) -> DataFrame:
    """Adds ``_w`` (lower-case word prefixes, distinct) and the statistics to a frame with ``_t`` (text)."""
    t = F.col("_t")
    count = lambda chars: F.length(F.regexp_replace(t, f"[^{chars}]+", ""))
    word = r"[^\x20\x09-\x0D]"
    df = df.withColumn("_tok", F.regexp_extract_all(F.lower(t), F.lit(f"({word}{{1,{PREFIX}}}){word}*"), 1))
    df = df.withColumn("_w", F.array_distinct("_tok")).withColumn("n_tokens", F.size("_tok").cast("long"))
    # every value is a column of its own before the bins compare it several times
    df = df.select("*", F.greatest(F.length(t), F.lit(1)).cast("double").alias("_chars"),
                   F.greatest(F.col("n_tokens"), F.lit(1)).cast("double").alias("_n"), count("#*$%&|<>").alias("_symbols"),
                   (F.length(t) - F.length(F.replace(t, F.lit("!"), F.lit("")))).alias("_marks"),
                   count("A-ZÄÖÜÉÈÊÀÂÇÎÔÛÑÁÍÓÚ").alias("_capitals"))
    stats = {"symbols": F.col("_symbols") / F.col("_n"), "marks": F.col("_marks") / F.col("_n"),
             "capitals": F.col("_capitals") / F.col("_chars"),
             "distinct": F.size("_w") / F.greatest(F.size("_tok"), F.lit(1)), "word_length": F.col("_chars") / F.col("_n")}
    for name, value in stats.items():
        df = df.withColumn(f"_b_{name}", _bin(value, BINS[name]))
    return df.drop("_tok", "_chars", "_n", "_symbols", "_marks", "_capitals")


def _array(values) -> F.Column:
    return F.array(*[F.lit(v) for v in values])


class SoftDomains:
    """The fitted classifier: domains, priors, marker words, and bin log-probabilities (all of bounded size)."""

    def __init__(self, domains: list[str], prior: list[float], markers: dict[str, list[str]], table: dict[tuple[str, str, int], float]):
        self.domains, self.prior, self.markers, self.table = domains, prior, markers, table

    def names(self) -> list[tuple[str, int]]:
        """All features and their numbers of bins."""
        return [(k, len(v) + 1) for k, v in BINS.items()] + [(f"marker{i}", 4) for i in range(len(self.domains))]

    def binned(self, scratch: Scratch, df: DataFrame, *keep: str) -> DataFrame:
        """``keep``, n_tokens and the bin of every feature of a frame with ``_t``, as a table: texts are read once."""
        df = _statistics(df)
        for i, d in enumerate(self.domains):
            hits = F.size(F.array_intersect("_w", _array(self.markers[d]))) if self.markers.get(d) else F.lit(0)
            df = df.withColumn(f"_b_marker{i}", F.least(hits, F.lit(3)))
        return scratch.table(df.select(*keep, "n_tokens", *[f"_b_{n}" for n, _ in self.names()]), "bins")

    def posterior(self, bins: DataFrame) -> DataFrame:
        """Adds the posterior of the k-th domain as column ``p<k>``."""
        logs = []
        for d, prior in zip(self.domains, self.prior):
            z = F.lit(prior)
            for name, n in self.names():
                z = z + F.element_at(_array([self.table[d, name, b] for b in range(n)]), F.col(f"_b_{name}") + 1)
            logs.append(z)
        k = range(len(logs))
        df = bins.select("*", *[z.alias(f"_z{i}") for i, z in zip(k, logs)])
        top = F.greatest(*[F.col(f"_z{i}") for i in k]) if len(logs) > 1 else F.col("_z0")
        df = df.select("*", *[F.exp(F.col(f"_z{i}") - top).alias(f"_e{i}") for i in k])
        total = sum((F.col(f"_e{i}") for i in k), F.lit(0.0))
        df = df.select("*", *[(F.col(f"_e{i}") / total).alias(f"p{i}") for i in k])
        return df.drop(*[f"_{c}{i}" for c in "ze" for i in k], *[f"_b_{n}" for n, _ in self.names()])


def _markers(scratch: Scratch, sample: DataFrame, domains: list[str], sizes: dict[str, int]) -> dict[str, list[str]]:
    """Per domain, the word prefixes most over-represented in it among the sampled texts."""
    words = _statistics(sample).select("domain", F.explode("_w").alias("w"))
    per = words.groupBy("w").agg(*[F.sum(F.when(F.col("domain") == d, 1).otherwise(0)).alias(f"n{i}") for i, d in enumerate(domains)])
    per = scratch.table(per.filter(F.greatest(F.lit(0), *[F.col(f"n{i}") for i in range(len(domains))]) >= MARKER_DOCS), "words")
    total = sum(sizes.values())
    out = {}
    for i, d in enumerate(domains):
        rest = sum((F.col(f"n{j}") for j in range(len(domains)) if j != i), F.lit(0))
        odds = (F.log((F.col(f"n{i}") + SMOOTH) / (sizes[d] + 1.0)) - F.log((rest + SMOOTH) / (total - sizes[d] + 1.0)))
        top = (per.filter(F.col(f"n{i}") >= MARKER_DOCS).withColumn("odds", odds).filter("odds > 1.5")
               .orderBy(F.desc(F.col(f"n{i}") * F.col("odds")), "w").limit(MARKERS).select("w").collect())
        out[d] = [r["w"] for r in top]
    return out


def fit_domains(spark: SparkSession, docs: DataFrame, labelled: DataFrame, rows: int = FIT_ROWS) -> SoftDomains | None:
    """Fit on at most ``rows`` rows of (doc_id, domain); None without any."""
    own = (labelled.select(F.col("doc_id").cast("long").alias("_id"), F.col("domain").cast("string").alias("domain"))
           .filter("_id is not null and domain is not null").groupBy("_id").agg(F.min("domain").alias("domain"))
           .orderBy(F.xxhash64("_id"), "_id").limit(rows))
    texts = docs.select(F.col("doc_id").cast("long").alias("_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_t"))
    sample = texts.join(F.broadcast(own), "_id")  # at most ``rows`` ids, one text each
    scratch = Scratch(spark, "mixing")
    sample = scratch.table(sample.groupBy("_id", "domain").agg(F.min("_t").alias("_t")).select("domain", "_t"), "sample")
    sizes = {r["domain"]: r["n"] for r in sample.groupBy("domain").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return None
    domains = sorted(sizes)
    model = SoftDomains(domains, [math.log(sizes[d] / sum(sizes.values())) for d in domains], _markers(scratch, sample, domains, sizes), {})
    binned, names = model.binned(scratch, sample, "domain"), model.names()
    pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("f"), F.col(f"_b_{n}").alias("b")) for n, _ in names]))
    counts = {(r["domain"], r["f"], r["b"]): r["n"] for r in
              binned.select("domain", pairs.alias("x")).groupBy("domain", "x.f", "x.b").agg(F.count(F.lit(1)).alias("n")).collect()}
    model.table = {(d, n, b): math.log((counts.get((d, n, b), 0) + SMOOTH) / (sizes[d] + SMOOTH * k))
                   for d in domains for n, k in names for b in range(k)}
    return model


def _dot(values):
    return sum((F.col(f"p{k}") * F.lit(float(v)) for k, v in enumerate(values)), F.lit(0.0))


def _rate(start: float, multipliers) -> Column:
    return F.greatest(F.lit(0.0), F.lit(float(start)) - _dot(multipliers))


def solve(measure, goal: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Multipliers whose rates bring the domain totals to ``goal``, and the residuals that remain.

    ``measure(multipliers, e)`` gives half the sum of squared rates, the domain totals and their Gram matrix over the
    rates above 0 (all by tokens), and the smallest product of ``e`` with a posterior.
    """
    close = CLOSE * np.where(goal > 0, goal, goal.max())
    at = np.zeros(len(goal))
    half, got, gram, _ = measure(at, np.zeros(len(goal)))
    e, step, share = got - goal, None, 1.0
    for _ in range(rounds):
        if (np.abs(e) <= close).all():
            break
        if step is None:
            ridge = RIDGE * max(np.trace(gram) / len(goal), RIDGE)
            step, share = np.linalg.solve(gram + ridge * np.eye(len(goal)), e), 1.0
        new = at + share * step
        new_half, new_got, new_gram, least = measure(new, e)
        # no rates lower half the squared residual by more than this
        if e @ got - min(0.0, least) * max(got.sum(), goal.sum()) <= BEST * (e @ e):
            break
        if new_half + goal @ new <= half + goal @ at - 1e-4 * share * (e @ step) + 1e-13 * abs(goal @ at):
            at, half, got, gram, e, step = new, new_half, new_got, new_gram, new_got - goal, None
        else:
            share /= 2
    return at, e


def fit_rates(rows: DataFrame, domains: list[str], targets: dict[str, float], total: float | None = None):
    """Rate as a column of the posteriors, and the expected domain totals at the fitted rates.

    ``rows`` has n_tokens and p0, p1 ...; ``total`` is the number of tokens the mixture should have (as many as there are, if None).
    The metadata of the rate hold what each domain's share lacks or has too much, where targets can't be met.
    """
    k = len(domains)
    names = [f"p{i}" for i in range(k)]
    alike = rows.filter("n_tokens > 0").groupBy(*names).agg(F.sum("n_tokens").alias("n_tokens"))
    alike = Scratch(rows.sparkSession, "mixing").table(alike, "alike")
    base = alike.agg(F.sum("n_tokens").alias("n"), *[F.sum(F.col("n_tokens") * F.col(p)).alias(p) for p in names]).first()
    n = float(base["n"] or 0)
    weight = sum(targets.get(d, 0.0) for d in domains)
    if not n or weight <= 0:
        return F.lit(1.0).alias("rate"), {d: float(base[p] or 0) for d, p in zip(domains, names)}
    start = (total or n) / n
    goal = np.array([targets.get(d, 0.0) / weight * start for d in domains])
    pairs = [(i, j) for i in range(k) for j in range(i, k)]

    def measure(multipliers, e):
        r = alike.select("*", _rate(start, multipliers).alias("r"), (F.col("n_tokens") / F.lit(n)).alias("w"))
        r = r.select(*names, "r", (F.col("w") * F.col("r")).alias("wr"), F.when(F.col("r") > 0, F.col("w")).otherwise(0.0).alias("w"))
        got = r.agg(F.sum(F.col("wr") * F.col("r")).alias("rr"), F.min(_dot(e)).alias("least"),
                    *[F.sum(F.col("wr") * F.col(p)).alias(p) for p in names],
                    *[F.sum(F.col("w") * F.col(names[i]) * F.col(names[j])).alias(f"h{i}_{j}") for i, j in pairs]).first()
        gram = np.zeros((k, k))
        for i, j in pairs:
            gram[i, j] = gram[j, i] = got[f"h{i}_{j}"]
        return got["rr"] / 2, np.array([got[p] for p in names]), gram, got["least"]

    multipliers, e = solve(measure, goal)
    off = {d: float(x / start) for d, x, g in zip(domains, e, goal) if abs(x) > CLOSE * (g or goal.max())}
    if off:
        warnings.warn("mixing: targets not met, shares off by " + ", ".join(f"{d} {x:+.2%}" for d, x in off.items()), stacklevel=2)
    rate = _rate(start, multipliers)
    return rate.alias("rate", metadata={"off_target": off}), {d: float(x + t) * n for d, x, t in zip(domains, e, goal)}


def uniform(key, seed: int = 11):
    """A number in [0, 1) that depends on the key alone."""
    return F.shiftrightunsigned(F.xxhash64(key, F.lit(seed)), 11) / F.lit(float(1 << 53))


def mixture(spark: SparkSession, docs: DataFrame, labelled: DataFrame, targets: dict[str, float], total: float | None = None) -> DataFrame:
    """One row per input row: doc_id, n_tokens, p (map of domain to posterior), rate, copies (whole, right on average)."""
    model = fit_domains(spark, docs, labelled)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_t"))
    if model is None:
        rows = _statistics(texts).select("doc_id", "n_tokens")
        return rows.select("doc_id", "n_tokens", F.create_map().cast("map<string,double>").alias("p"), F.lit(1.0).alias("rate"), F.lit(1).cast("long").alias("copies"))
    rows = _posteriors(spark, model, texts)
    rate, _ = fit_rates(rows, model.domains, targets, total)
    rows = rows.select("*", rate)
    p = F.map_from_arrays(_array(model.domains), F.array(*[F.col(f"p{i}") for i in range(len(model.domains))]))
    return rows.select("doc_id", "n_tokens", p.alias("p"), "rate",
                       F.floor(F.col("rate") + uniform(F.col("doc_id"))).cast("long").alias("copies"))


def _posteriors(spark: SparkSession, model: SoftDomains, texts: DataFrame) -> DataFrame:
    scratch = Scratch(spark, "mixing")
    return scratch.table(model.posterior(model.binned(scratch, texts, "doc_id")), "posteriors")


def thin(spark: SparkSession, docs: DataFrame, labelled: DataFrame, targets: dict[str, float]) -> DataFrame:
    """``docs`` thinned to the target weights; all columns stay.

    The rates are scaled so that the largest rate of a document with tokens
    is certain to stay and every other stays with its share of it, so the
    tokens kept have the weights on average, whichever domain prevails.
    Rows of one doc_id stay or go together, by the largest of their rates.
    """
    model = fit_domains(spark, docs, labelled)
    if model is None:
        return docs
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_t"))
    rows = _posteriors(spark, model, texts)
    rate, _ = fit_rates(rows, model.domains, targets)
    rows = rows.select("doc_id", "n_tokens", rate)
    largest = rows.filter("n_tokens > 0").agg(F.max("rate")).first()[0]
    if not largest:
        return docs
    stays = uniform(F.coalesce("doc_id", F.lit(-1))) < F.col("rate") / F.lit(float(largest)) * (1 + 1e-6)
    kept = rows.filter(stays).select(F.col("doc_id").alias("_mx_id")).distinct()
    return docs.join(kept, docs["doc_id"].cast("long").eqNullSafe(kept["_mx_id"]), "left_semi")
