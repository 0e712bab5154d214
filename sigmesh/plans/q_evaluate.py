"""Evaluation queries.

The labelled log is ``labels ⋈ documents``: positive = low quality
(``quality = 0``); seven document-level predicates stand in for the seven
signals; prediction = the current verdict rule with REVIEW as positive.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import clean_text, english_hits, is_syndicated
from ..operators.evaluate import (SIGNALS7, ablation, auc, best_threshold, binary_metrics, model_verdict,
                                  per_signal_metrics, prob_by_class, pseudo_label, stratified_split,
                                  threshold_sweep, to_binary)
from ..operators.skew import with_group_size
from ..operators.verdict import verdict_col
from ..sources.tables import Tables
from . import sql_mapping as S
from .q_text import sql_clean_text, sql_english_hits
from .registry import register

JUNK_RE = r"(###|%%%|\$\$\$|\*\*\*)"
BYLINE_RE = r"[Bb]y\s+[A-Z][a-z]+\s+[A-Z][a-z]+"


def eval_log(spark, sf_dir):
    t = Tables(spark, sf_dir)
    d = (t.documents.select("doc_id", "text", "n_chars")
         .join(t.labels.select("doc_id", "quality"), "doc_id")
         .withColumn("h", F.md5(F.coalesce("text", F.lit("")))))
    ct = clean_text("text")
    sig = {
        "signal_2_cadence": F.col("n_chars") < 200,
        "signal_3_whois": ~F.coalesce((F.length(ct) >= 50) & (english_hits(ct) >= 3), F.lit(False)),
        "signal_4_hosting": F.coalesce(F.col("text").rlike(JUNK_RE), F.lit(False)),
        "signal_5_link_network": F.coalesce(F.locate("http", F.col("text")) > 0, F.lit(False)),
        "signal_6_wayback": is_syndicated("text"),
        "signal_7_authors": F.coalesce(F.col("text").rlike(BYLINE_RE), F.lit(False)),
    }
    d = d.select("doc_id", "h", (1 - F.col("quality")).cast("int").alias("label"),
                 *[c.cast("int").alias(k) for k, c in sig.items()])
    d = with_group_size(d, ["h"], "copies", ["doc_id"])  # texts stay behind: keys and flags move
    log = d.withColumn("signal_1_similarity", (F.col("copies") > 1).cast("int")).select("doc_id", "label", *SIGNALS7)
    n = sum((F.col(s) for s in SIGNALS7[1:]), F.col(SIGNALS7[0]))
    log = log.withColumn("signals_triggered", n.cast("int"))
    log = log.withColumn("predicted_verdict", verdict_col("signals_triggered", "current"))
    log = log.withColumn("predicted_label", to_binary("predicted_verdict"))
    return log.withColumn("score", F.round(F.col("signals_triggered") / 7.0, 4))


def _sig_sql() -> str:
    ct = sql_clean_text("text")
    return f"""
with d as (select doc_id, text, n_chars, quality, count(*) over (partition by md5(coalesce(text, ''))) as copies
           from documents join labels using (doc_id)),
s as (select doc_id, cast(1 - quality as integer) as label,
        cast(copies > 1 as integer) as signal_1_similarity,
        cast(n_chars < 200 as integer) as signal_2_cadence,
        cast(not coalesce(length({ct}) >= 50 and {sql_english_hits(ct)} >= 3, false) as integer) as signal_3_whois,
        cast(coalesce(regexp_matches(text, '{JUNK_RE}'), false) as integer) as signal_4_hosting,
        cast(coalesce(contains(text, 'http'), false) as integer) as signal_5_link_network,
        cast({S.sql_syndicated('text')} as integer) as signal_6_wayback,
        cast(coalesce(regexp_matches(text, '{BYLINE_RE}'), false) as integer) as signal_7_authors
      from d),
n as (select *, cast({' + '.join(SIGNALS7)} as integer) as signals_triggered from s),
log as (select *, case when signals_triggered >= 3 then 'SYNTHETIC' when signals_triggered = 2 then 'REVIEW'
                       else 'ORGANIC' end as predicted_verdict,
               cast(signals_triggered >= 2 as integer) as predicted_label,
               round(signals_triggered / 7.0, 4) as score from n)
"""


LOG_SQL = _sig_sql()


def _metrics_sql(src: str, y: str, p: str, by: str = "") -> str:
    g = f"{by}, " if by else ""
    grp = f"group by {by}" if by else ""
    return f"""
c as (select {g}cast(sum(case when {y} = 1 and {p} = 1 then 1 else 0 end) as bigint) as tp,
             cast(sum(case when {y} = 0 and {p} = 0 then 1 else 0 end) as bigint) as tn,
             cast(sum(case when {y} = 0 and {p} = 1 then 1 else 0 end) as bigint) as fp,
             cast(sum(case when {y} = 1 and {p} = 0 then 1 else 0 end) as bigint) as fn from {src} {grp}),
m as (select *, case when tp + fp > 0 then tp / (tp + fp) else 0.0 end as pr,
                case when tp + fn > 0 then tp / (tp + fn) else 0.0 end as rc from c)
select {g}tp, tn, fp, fn, round(pr, 4) as precision, round(rc, 4) as recall,
  round(case when pr + rc > 0 then 2 * pr * rc / (pr + rc) else 0.0 end, 4) as f1,
  round(case when tp + tn + fp + fn > 0 then (tp + tn) / (tp + tn + fp + fn) else 0.0 end, 4) as accuracy,
  round(case when fp + tn > 0 then fp / (fp + tn) else 0.0 end, 4) as fpr
from m"""


@register("evaluation_log", ops=("B31", "B11", "B12"), sql=LOG_SQL + "select * from log")
def q_evaluation_log(spark, sf_dir):
    return eval_log(spark, sf_dir)


@register("evaluation_confusion", ops=("D15", "B31", "Q6"),
          sql=LOG_SQL + "," + _metrics_sql("log", "label", "predicted_label"))
def q_evaluation_confusion(spark, sf_dir):
    return binary_metrics(eval_log(spark, sf_dir))


PER_SIGNAL_SQL = LOG_SQL + f""", u as (unpivot (select label, {', '.join(SIGNALS7)} from log)
    on {', '.join(SIGNALS7)} into name signal value fired),""" + _metrics_sql("u", "label", "fired", "signal")


@register("evaluation_per_signal", ops=("D16",), sql=PER_SIGNAL_SQL)
def q_evaluation_per_signal(spark, sf_dir):
    return per_signal_metrics(eval_log(spark, sf_dir))


def _ablation_sql() -> str:
    masks = ", ".join(S.q(m) for m in ["none", *SIGNALS7])
    removed = "case " + " ".join(f"when masked = {S.q(s)} then {s}" for s in SIGNALS7) + " else 0 end"
    return LOG_SQL + f""", x as (select *, cast(signals_triggered - ({removed}) >= 2 as integer) as pred
              from log, (select unnest([{masks}]) as masked) mk),
""" + _metrics_sql("x", "label", "pred", "masked").replace("select masked, tp,", "select masked, tp,") + ""


ABLATION_SQL = f"""
with a as ({_ablation_sql()}),
b as ({LOG_SQL + "," + _metrics_sql("log", "label", "predicted_label")})
select a.*, round(a.f1 - b.f1, 4) as delta_f1 from a, b
"""


@register("evaluation_ablation", ops=("D17",), sql=ABLATION_SQL)
def q_evaluation_ablation(spark, sf_dir):
    return ablation(eval_log(spark, sf_dir))


def _sweep_sql() -> str:
    ts = ", ".join(f"{round(0.30 + i * 0.05, 2)}" for i in range(13))
    w = "case when pos + neg > 0 then ({a} * pos + {b} * neg) / (pos + neg) else 0.0 end"
    return LOG_SQL + f""", x as (select label, score, t, cast(score >= t as integer) as pred
         from log, (select cast(unnest([{ts}]) as double) as t) tt),
c as (select t, sum(case when label = 1 and pred = 1 then 1 else 0 end)::double as tp,
             sum(case when label = 0 and pred = 0 then 1 else 0 end)::double as tn,
             sum(case when label = 0 and pred = 1 then 1 else 0 end)::double as fp,
             sum(case when label = 1 and pred = 0 then 1 else 0 end)::double as fn from x group by t),
m as (select t, tp + fn as pos, tn + fp as neg,
        case when tp + fp > 0 then tp / (tp + fp) else 0.0 end as p1,
        case when tp + fn > 0 then tp / (tp + fn) else 0.0 end as r1,
        case when tn + fn > 0 then tn / (tn + fn) else 0.0 end as p0,
        case when tn + fp > 0 then tn / (tn + fp) else 0.0 end as r0
      from c where tp + fp > 0 and tn + fn > 0),
f as (select *, case when p1 + r1 > 0 then 2 * p1 * r1 / (p1 + r1) else 0.0 end as f11,
                case when p0 + r0 > 0 then 2 * p0 * r0 / (p0 + r0) else 0.0 end as f10 from m)
select t, round({w.format(a='f11', b='f10')}, 4) as weighted_f1,
  round({w.format(a='p1', b='p0')}, 4) as weighted_precision,
  round({w.format(a='r1', b='r0')}, 4) as weighted_recall
from f"""


SWEEP_SQL = _sweep_sql()


@register("evaluation_sweep", ops=("D23",), sql=SWEEP_SQL)
def q_evaluation_sweep(spark, sf_dir):
    return threshold_sweep(eval_log(spark, sf_dir))


@register("evaluation_best_threshold", ops=("D23",), sql=f"""
select coalesce(arg_min(t, (-weighted_f1, t)), 0.5) as best_threshold from ({SWEEP_SQL}) s
""")
def q_evaluation_best_threshold(spark, sf_dir):
    return best_threshold(threshold_sweep(eval_log(spark, sf_dir)))


@register("evaluation_auc", ops=("D24",), sql=LOG_SQL + """,
g as (select score, sum(case when label = 1 then 1 else 0 end) as pos, sum(case when label = 0 then 1 else 0 end) as neg
      from log group by score),
r as (select *, sum(pos) over (order by score desc rows between unbounded preceding and current row) as cum_pos,
             sum(pos) over () as p_all, sum(neg) over () as n_all from g)
select round(case when max(p_all) * max(n_all) > 0
                  then sum(neg * (cum_pos + (cum_pos - pos)) / 2.0) / (max(p_all) * max(n_all)) else 0.0 end, 4) as auc
from r
""")
def q_evaluation_auc(spark, sf_dir):
    return auc(eval_log(spark, sf_dir))


@register("evaluation_prob_by_class", ops=("D26",), sql=LOG_SQL + """
select label, round(avg(score), 4) as mean_score, round(max(score), 4) as max_score,
       round(min(score), 4) as min_score, count(*) as n from log group by label
""")
def q_evaluation_prob_by_class(spark, sf_dir):
    return prob_by_class(eval_log(spark, sf_dir))


@register("evaluation_model_verdicts", ops=("B29", "B30", "D19"), sql=LOG_SQL + """
select case when score >= 0.5 and signals_triggered >= 2 then 'SYNTHETIC'
            when score >= 0.5 and signals_triggered = 1 then 'REVIEW'
            when score >= 0.4 and signals_triggered >= 1 then 'REVIEW' else 'ORGANIC' end as model_verdict,
       case when label in (0, 1) then label when signals_triggered >= 2 then 1
            when signals_triggered = 0 then 0 end as pseudo_label,
       count(*) as n
from log group by all
""")
def q_evaluation_model_verdicts(spark, sf_dir):
    log = eval_log(spark, sf_dir)
    return log.groupBy(model_verdict("score", "signals_triggered", 0.5).alias("model_verdict"),
                       pseudo_label("label", "signals_triggered").alias("pseudo_label")) \
              .agg(F.count(F.lit(1)).alias("n"))


@register("evaluation_split", ops=("I5", "G7"), sql=LOG_SQL + """
select label, cast('0x' || substr(md5('42:' || cast(doc_id as varchar)), 1, 8) as bigint) % 100 < 20 as is_test,
       count(*) as n from log group by all
""")
def q_evaluation_split(spark, sf_dir):
    log = stratified_split(eval_log(spark, sf_dir), "doc_id")
    return log.groupBy("label", "is_test").agg(F.count(F.lit(1)).alias("n"))
