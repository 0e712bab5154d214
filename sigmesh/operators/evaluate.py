"""Detection-quality metrics.

All metrics are grouped aggregations over a prediction log; nothing is
collected to the driver.  Global orders are only taken on tables whose size
is bounded by construction (distinct scores for AUC, 13 thresholds, 8 masks).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .order import with_running
from .skew import one_row_join

SIGNALS7 = ("signal_1_similarity", "signal_2_cadence", "signal_3_whois", "signal_4_hosting",
            "signal_5_link_network", "signal_6_wayback", "signal_7_authors")


def _div(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def confusion_aggs(y: str = "label", p: str = "predicted_label") -> list[Column]:
    yc, pc = F.col(y), F.col(p)
    return [F.sum(((yc == 1) & (pc == 1)).cast("long")).alias("tp"),
            F.sum(((yc == 0) & (pc == 0)).cast("long")).alias("tn"),
            F.sum(((yc == 0) & (pc == 1)).cast("long")).alias("fp"),
            F.sum(((yc == 1) & (pc == 0)).cast("long")).alias("fn")]


def metric_cols() -> list[Column]:
    tp, tn, fp, fn = (F.col(c).cast("double") for c in ("tp", "tn", "fp", "fn"))
    prec = _div(tp, tp + fp)
    rec = _div(tp, tp + fn)
    f1 = _div(2 * prec * rec, prec + rec)
    return [F.round(prec, 4).alias("precision"), F.round(rec, 4).alias("recall"),
            F.round(f1, 4).alias("f1"), F.round(_div(tp + tn, tp + tn + fp + fn), 4).alias("accuracy"),
            F.round(_div(fp, fp + tn), 4).alias("fpr")]


def binary_metrics(log: DataFrame, y: str = "label", p: str = "predicted_label",
                   by: list[str] | None = None) -> DataFrame:
    """Confusion counts and P/R/F1/accuracy/FPR, 0 on empty denominators."""
    g = log.groupBy(*(by or [])).agg(*confusion_aggs(y, p))
    return g.select(*(by or []), "tp", "tn", "fp", "fn", *metric_cols())


def to_binary(verdict_col: str = "verdict") -> Column:
    """REVIEW counts as positive."""
    return F.col(verdict_col).isin("SYNTHETIC", "REVIEW").cast("int")


def per_signal_metrics(log: DataFrame, y: str = "label") -> DataFrame:
    """One metrics row per signal (D16): the signal flag used as the prediction."""
    stack = "stack(7, " + ", ".join(f"'{s}', {s}" for s in SIGNALS7) + ") as (signal, fired)"
    long = log.selectExpr(y, stack)
    return binary_metrics(long, y, "fired", ["signal"])


def ablation(log: DataFrame, y: str = "label", flag_at: int = 2) -> DataFrame:
    """Leave-one-out (D17): drop one signal, flag when >= ``flag_at`` remain,
    ΔF1 against the stored prediction.  The 8 mask rows (none + 7) are a
    fixed list, so each log row is expanded 8× in place (no join)."""
    masks = ["none", *SIGNALS7]
    n_all = reduce(lambda a, b: a + b, [F.col(s) for s in SIGNALS7])
    x = log.withColumn("masked", F.explode(F.array(*[F.lit(m) for m in masks]))).withColumn(
        "remaining", n_all - F.when(F.col("masked") == "none", F.lit(0)).otherwise(
            reduce(lambda acc, s: acc.when(F.col("masked") == s, F.col(s)), SIGNALS7[1:],
                   F.when(F.col("masked") == SIGNALS7[0], F.col(SIGNALS7[0])))))
    x = x.withColumn("pred", (F.col("remaining") >= flag_at).cast("int"))
    m = binary_metrics(x, y, "pred", ["masked"])
    base = binary_metrics(log, y, "predicted_label").select(F.col("f1").alias("base_f1"))
    out = one_row_join(m, base)
    return out.withColumn("delta_f1", F.round(F.col("f1") - F.col("base_f1"), 4)).drop("base_f1")


def threshold_sweep(log: DataFrame, y: str = "label", score: str = "score",
                    lo: float = 0.30, hi: float = 0.90, step: float = 0.05) -> DataFrame:
    """Weighted P/R/F1 per threshold (D23); one-class predictions are skipped.
    The threshold list is fixed (13 values), exploded per row; one grouped
    pass counts all thresholds."""
    n = int(round((hi - lo) / step)) + 1
    ts = F.array(*[F.lit(round(lo + i * step, 2)) for i in range(n)])
    x = log.select(y, score).withColumn("t", F.explode(ts)) \
        .withColumn("pred", (F.col(score) >= F.col("t")).cast("int"))
    c = x.groupBy("t").agg(*confusion_aggs(y, "pred"))
    tp, tn, fp, fn = (F.col(k).cast("double") for k in ("tp", "tn", "fp", "fn"))
    pos, neg = tp + fn, tn + fp
    p1, r1 = _div(tp, tp + fp), _div(tp, pos)
    p0, r0 = _div(tn, tn + fn), _div(tn, neg)
    f1_1, f1_0 = _div(2 * p1 * r1, p1 + r1), _div(2 * p0 * r0, p0 + r0)
    tot = pos + neg
    wavg = lambda a, b: _div(a * pos + b * neg, tot)
    return c.filter(((tp + fp) > 0) & ((tn + fn) > 0)).select(
        "t", F.round(wavg(f1_1, f1_0), 4).alias("weighted_f1"),
        F.round(wavg(p1, p0), 4).alias("weighted_precision"), F.round(wavg(r1, r0), 4).alias("weighted_recall"))


def best_threshold(sweep: DataFrame, default: float = 0.5) -> DataFrame:
    """Highest weighted F1, first (lowest) threshold on ties; default when empty."""
    b = sweep.agg(F.min_by("t", F.struct(-F.col("weighted_f1"), F.col("t"))).alias("best_t"))
    return b.select(F.coalesce("best_t", F.lit(default)).alias("best_threshold"))


def roc_points(log: DataFrame, y: str = "label", score: str = "score") -> DataFrame:
    """ROC points (D24): distinct scores from the highest down with counts and
    running totals of both classes, and the totals P and N.  Running totals
    come from range partitions and prefix offsets, so any number of distinct
    scores is fine."""
    g = log.groupBy(score).agg(F.sum((F.col(y) == 1).cast("long")).alias("pos"),
                               F.sum((F.col(y) == 0).cast("long")).alias("neg"))
    r = with_running(g, [F.desc(score)], {"cum_pos": "pos", "cum_neg": "neg"}, "_place").drop("_place")
    total = r.agg(F.max("cum_pos").alias("P"), F.max("cum_neg").alias("N"))
    return one_row_join(r, total)


def auc(log: DataFrame, y: str = "label", score: str = "score") -> DataFrame:
    """Exact AUC with ties (trapezoids over distinct scores)."""
    r = roc_points(log, y, score)
    prev_neg = F.col("cum_neg") - F.col("neg")
    prev_pos = F.col("cum_pos") - F.col("pos")
    area = F.col("neg") * (F.col("cum_pos") + prev_pos) / 2.0
    a = r.agg(F.sum(area).alias("a"), F.max("P").alias("P"), F.max("N").alias("N"))
    return a.select(F.round(_div(F.col("a"), F.col("P") * F.col("N")), 4).alias("auc"))


def prob_by_class(log: DataFrame, y: str = "label", score: str = "score") -> DataFrame:
    """Mean / max / min score per class."""
    return log.groupBy(y).agg(F.round(F.avg(score), 4).alias("mean_score"),
                              F.round(F.max(score), 4).alias("max_score"),
                              F.round(F.min(score), 4).alias("min_score"), F.count(F.lit(1)).alias("n"))


def model_verdict(prob: str, n: str, t: float) -> Column:
    """Prob >= t & >= 2 signals SYNTHETIC; prob >= t & 1 REVIEW;
    prob >= .4 & >= 1 REVIEW; else ORGANIC."""
    p, s = F.col(prob), F.col(n)
    return (F.when((p >= t) & (s >= 2), "SYNTHETIC").when((p >= t) & (s == 1), "REVIEW")
            .when((p >= 0.4) & (s >= 1), "REVIEW").otherwise("ORGANIC"))


def pseudo_label(truth: str, n: str, at: int = 2) -> Column:
    """Truth when known, else >= at -> 1, 0 -> 0, else unknown (null)."""
    t, s = F.col(truth), F.col(n)
    return (F.when(t.isin(0, 1), t).when(s >= at, 1).when(s == 0, 0)
            .otherwise(F.lit(None).cast("int")))


def fold_of(key: str, k: int, seed: int = 42) -> Column:
    """Deterministic fold id without a global sort (I4)."""
    return F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(k)).cast("int")


def stratified_split(df: DataFrame, key: str, test_pct: int = 20, seed: int = 42) -> DataFrame:
    """Test when the first 32 bits of md5("seed:key"), mod 100, are below
    pct; hashing is per row, so the share holds within each label.  A null
    key counts as an empty one."""
    mark = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("")))
    part = F.conv(F.substring(F.md5(mark.cast("binary")), 1, 8), 16, 10).cast("long")
    return df.withColumn("is_test", F.pmod(part, F.lit(100)) < test_pct)


def evaluation_source(log: DataFrame) -> DataFrame:
    """D27: 'log' where at least three distinct signals fire in it and some rows
    are predicted positive, else 'features'; with both numbers."""
    firing = sum(((F.sum(s) > 0).cast("int") for s in SIGNALS7[1:]), (F.sum(SIGNALS7[0]) > 0).cast("int"))
    a = log.agg(firing.alias("signals_firing"), F.sum("predicted_label").cast("long").alias("positives"))
    return a.select(F.when((F.col("signals_firing") >= 3) & (F.col("positives") > 0), "log").otherwise("features").alias("source"),
                    "signals_firing", "positives")


def cluster_runs(verdicts: DataFrame, truth: DataFrame, flags: list[str]) -> DataFrame:
    """A row for each of the two clusters (all positive domains, all negative
    ones) and one overall. Per cluster: domains, flagged, flagged rate and how
    many domains each of ``flags`` fires on; a domain without a verdict counts
    as ORGANIC. Overall: TP, FN, FP, TN, precision, recall and F1."""
    j = truth.select("domain", "label").join(verdicts.select("domain", "verdict", *flags), "domain", "left")
    j = j.withColumn("verdict", F.coalesce("verdict", F.lit("ORGANIC"))).withColumn("_hit", to_binary("verdict"))
    g = j.groupBy("label").agg(F.count(F.lit(1)).alias("n_domains"), F.sum("_hit").cast("long").alias("n_flagged"),
                               *[F.sum(F.coalesce(F.col(c), F.lit(0))).cast("long").alias(c) for c in flags])
    g = g.select(F.when(F.col("label") == 1, "synthetic_cluster").otherwise("organic_cluster").alias("cluster"), "n_domains", "n_flagged",
                 F.round(F.col("n_flagged") / F.col("n_domains"), 4).alias("flagged_rate"), *flags)
    of = {n: F.coalesce(F.max(F.when(F.col("cluster") == c, x)), F.lit(0).cast("long")) for n, c, x in (
        ("tp", "synthetic_cluster", F.col("n_flagged")), ("fn", "synthetic_cluster", F.col("n_domains") - F.col("n_flagged")),
        ("fp", "organic_cluster", F.col("n_flagged")), ("tn", "organic_cluster", F.col("n_domains") - F.col("n_flagged")))}
    total = g.agg(*[v.alias(n) for n, v in of.items()])
    tp, fn, fp = F.col("tp"), F.col("fn"), F.col("fp")
    total = total.select(F.lit("overall").alias("cluster"), "tp", "fn", "fp", "tn", F.round(_div(tp, tp + fp), 4).alias("precision"),
                         F.round(_div(tp, tp + fn), 4).alias("recall"), F.round(_div(2 * tp, 2 * tp + fp + fn), 4).alias("f1"))
    return g.unionByName(total, allowMissingColumns=True)


def signal_matrix(verdicts: DataFrame, flags: list[str]) -> DataFrame:
    """One row per domain and signal, fired 0 or 1."""
    long = F.explode(F.array(*[F.struct(F.lit(c).alias("signal"), F.coalesce(F.col(c), F.lit(0)).cast("int").alias("fired")) for c in flags]))
    return verdicts.select("domain", long.alias("m")).select("domain", "m.signal", "m.fired")


def silent_failure(probs: DataFrame, t: float, outlets=None) -> DataFrame:
    """Listed wire/local outlets whose probability reaches ``t`` (must be
    empty for a safe model).  The outlet list is a fixed literal list, so it
    is compiled into ``isin`` rather than joined."""
    from ..config import AUTHORITY_DOMAINS
    lst = list(outlets or AUTHORITY_DOMAINS)
    return probs.filter(F.col("domain").isin(*lst) & (F.col("prob") >= t))
