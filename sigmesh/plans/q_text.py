"""Text, URL and domain-name queries on ``documents`` and ``pages``."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import ENGLISH_WORDS, NOISE_DOMAINS, RETRAIN_KEYWORDS, SUSPICIOUS_TLDS
from ..functions.domains import (is_authority, normalize_domain, normalize_seed, not_noise, parent_domain,
                                 suspicious_name, suspicious_name_retrain, url_domain, url_domain_any)
from ..functions.text import clean_text, english_hits, is_english, is_syndicated
from ..operators.pages import clean_pages, html_text
from ..operators.skew import one_row_join
from ..sources.tables import Tables
from . import sql_mapping as S
from .q_signals import CFG
from .registry import register


def sql_clean_text(c: str) -> str:
    t = f"coalesce({c}, '')"
    for pat, rep in (("&[a-zA-Z]+;", " "), ("[^\\x00-\\x7F]", ""), ("http\\S+", ""),
                     ("[^\\w\\s.,!?\\-]", " "), ("\\s+", " ")):
        t = f"regexp_replace({t}, '{pat}', '{rep}', 'g')"
    return f"trim({t})"


def sql_english_hits(c: str) -> str:
    return "(" + " + ".join(f"cast(contains(lower({c}), ' {w} ') as integer)" for w in ENGLISH_WORDS) + ")"


def sql_url_domain(c: str) -> str:
    host = f"regexp_replace(lower(regexp_extract({c}, '^[A-Za-z][A-Za-z0-9+.\\-]*://([^/?#]*)', 1)), '^www\\.', '')"
    return f"(case when contains({host}, '.') then {host} end)"


def sql_url_domain_any(c: str) -> str:
    host = f"replace(lower(regexp_extract({c}, '^[A-Za-z][A-Za-z0-9+.\\-]*://([^/?#]*)', 1)), 'www.', '')"
    return f"(case when contains({host}, '.') then {host} end)"


def sql_normalize(c: str) -> str:
    d = S.sql_strip(f"lower({c})")
    d = f"regexp_replace({d}, '^www\\.', '')"
    d = S.sql_strip(f"regexp_replace({d}, '[./]+$', '')")
    return f"(case when contains({d}, '.') and length({d}) between 4 and 100 then {d} end)"


def sql_seed(c: str) -> str:
    d = f"lower({S.sql_strip(c)})"
    d = f"replace(replace({d}, 'https://', ''), 'http://', '')"
    return S.sql_strip(f"split_part({d}, '/', 1)")


def sql_suspicious_kw(c: str, kws) -> str:
    tld = " or ".join(f"ends_with({c}, {S.q(t)})" for t in SUSPICIOUS_TLDS)
    kw = " or ".join(f"contains({c}, {S.q(k)})" for k in kws)
    return f"(({tld}) or ({kw}) or (length({c}) - length(replace({c}, '-', ''))) >= 2)"


@register("text_clean_english", ops=("H6", "B3", "B2"), sql=f"""
select doc_id, length(ct) as clean_len, {sql_english_hits('ct')} as english_hits,
       coalesce(length(ct) >= 50 and {sql_english_hits('ct')} >= 3, false) as is_english,
       length(coalesce(text, '')) > {CFG.min_embed_text} as embeddable
from (select doc_id, text, {sql_clean_text('text')} as ct from documents) d
""")
def q_text_clean_english(spark, sf_dir):
    d = Tables(spark, sf_dir).documents.select("doc_id", "text").withColumn("ct", clean_text("text"))
    return d.select("doc_id", F.length("ct").alias("clean_len"), english_hits("ct").alias("english_hits"),
                    is_english("ct").alias("is_english"),
                    (F.length(F.coalesce("text", F.lit(""))) > CFG.min_embed_text).alias("embeddable"))


@register("english_vs_lang", ops=("B3", "H6", "D19"), sql=f"""
select lang, coalesce(length(ct) >= 50 and {sql_english_hits('ct')} >= 3, false) as is_english, count(*) as docs
from (select lang, {sql_clean_text('text')} as ct from documents) d group by all
""")
def q_english_vs_lang(spark, sf_dir):
    d = Tables(spark, sf_dir).documents.select("lang", clean_text("text").alias("ct"))
    return d.groupBy("lang", is_english("ct").alias("is_english")).agg(F.count(F.lit(1)).alias("docs"))


@register("page_domains", ops=("H1", "H2", "H3", "H4", "H5", "B4", "B5", "B6", "B7"), sql=f"""
with p as (select page_id, url, {sql_url_domain('url')} as domain from pages)
select page_id, domain, {sql_url_domain_any('url')} as domain_any, {sql_normalize('domain')} as normalized,
  {sql_seed('url')} as seed, {S.sql_parent('domain')} as parent,
  coalesce({S.sql_suspicious('domain')}, false) as suspicious,
  coalesce({sql_suspicious_kw('domain', RETRAIN_KEYWORDS)}, false) as suspicious_retrain,
  coalesce(domain not in {S.in_list(NOISE_DOMAINS)}, false) as not_noise,
  coalesce({S.sql_authority('domain')}, false) as authority
from p
""")
def q_page_domains(spark, sf_dir):
    p = Tables(spark, sf_dir).pages.select("page_id", "url").withColumn("domain", url_domain("url"))
    return p.select("page_id", "domain", url_domain_any("url").alias("domain_any"),
                    normalize_domain("domain").alias("normalized"), normalize_seed("url").alias("seed"),
                    parent_domain("domain").alias("parent"),
                    F.coalesce(suspicious_name("domain"), F.lit(False)).alias("suspicious"),
                    F.coalesce(suspicious_name_retrain("domain"), F.lit(False)).alias("suspicious_retrain"),
                    F.coalesce(not_noise("domain"), F.lit(False)).alias("not_noise"),
                    F.coalesce(is_authority("domain"), F.lit(False)).alias("authority"))


def _html_sql(c: str) -> str:
    t = f"coalesce({c}, '')"
    for pat, rep in (("(?is)<script[^>]*>.*?</script>", " "), ("(?is)<style[^>]*>.*?</style>", " "),
                     ("(?s)<!--.*?-->", " "), ("<[^>]*>", " ")):
        t = f"regexp_replace({t}, '{pat}', '{rep}', 'g')"
    return f"trim(regexp_replace({t}, '\\s+', ' ', 'g'))"


CLEAN_PAGES_SQL = f"""
with p as (select page_id, {sql_normalize(sql_url_domain('url'))} as domain, html from pages),
f as (select domain, arg_min(page_id, page_id) as page_id, arg_min(html, page_id) as html
      from p where domain is not null group by domain),
c as (select domain, page_id, {sql_clean_text(_html_sql('html'))} as text from f)
select domain, page_id, length(text) as text_len from c
where length(text) >= {CFG.min_text_len} and coalesce(length(text) >= 50 and {sql_english_hits('text')} >= 3, false)
"""


@register("clean_pages", ops=("B1", "E1", "H1", "H3", "H6", "B3", "I8"), sql=CLEAN_PAGES_SQL)
def q_clean_pages(spark, sf_dir):
    p = Tables(spark, sf_dir).pages
    raw = p.select(url_domain("url").alias("domain"), F.col("page_id").alias("ord"),
                   html_text("html").alias("text"))
    c = clean_pages(raw, CFG, "ord")
    return c.select("domain", F.col("ord").cast("long").alias("page_id"), F.length("text").alias("text_len"))


@register("document_profile", ops=("D20", "B2", "C15", "G7"), sql=f"""
select min(length(text)) as min_len, max(length(text)) as max_len, round(avg(length(text)), 4) as avg_len,
       count(distinct source) as sources, count(distinct lang) as langs,
       (select count(*) from labels where quality in (0, 1)) as labelled,
       sum(case when length(text) > {CFG.min_embed_text} then 1 else 0 end) as embeddable
from documents
""")
def q_document_profile(spark, sf_dir):
    t = Tables(spark, sf_dir)
    d = t.documents.agg(F.min(F.length("text")).alias("min_len"), F.max(F.length("text")).alias("max_len"),
                        F.round(F.avg(F.length("text")), 4).alias("avg_len"),
                        F.count_distinct("source").alias("sources"), F.count_distinct("lang").alias("langs"),
                        F.sum((F.length("text") > CFG.min_embed_text).cast("long")).alias("embeddable"))
    lab = t.labels.filter(F.col("quality").isin(0, 1)).agg(F.count(F.lit(1)).alias("labelled"))
    return one_row_join(d, lab).select("min_len", "max_len", "avg_len", "sources", "langs", "labelled",
                                           "embeddable")


@register("syndication_by_source", ops=("B8", "H18"), sql=f"""
select source, count(*) as docs, cast(sum(case when {S.sql_syndicated('text')} then 1 else 0 end) as bigint) as syndicated
from documents group by source
""")
def q_syndication_by_source(spark, sf_dir):
    d = Tables(spark, sf_dir).documents
    return d.groupBy("source").agg(F.count(F.lit(1)).alias("docs"),
                                   F.sum(is_syndicated("text").cast("long")).alias("syndicated"))
