"""Page queries: structural parse, article URLs, bylines, tolerant corpus
(I8, I9, I10, A3, E1, F9, H22)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import ARTICLE_URL_PATTERNS, BYLINE_PATTERNS, NOISE_AUTHORS
from ..functions.domains import url_domain
from ..operators.pages import article_urls, bylines_col, html_text, outlinks_from_hrefs, parse_pages
from ..sources.files import tolerant_corpus
from ..sources.tables import Tables
from . import sql_mapping as S
from .q_text import _html_sql, sql_url_domain
from .registry import register

HREF_RE = r'href="([^"]*)"'


@register("page_parse", ops=("I8", "F9", "H22", "K10"))
def q_page_parse(spark, sf_dir):
    """Structural parse (stdlib parser in mapInPandas): lengths and link counts."""
    p = parse_pages(Tables(spark, sf_dir).pages, max_chars=None)  # whole texts
    links = outlinks_from_hrefs(p, keep=(F.length("text").alias("text_len"), F.length("body_text").alias("body_len"),
                                         F.size("hrefs").alias("n_hrefs")))
    return links.select("page_id", "text_len", "body_len", F.col("n_hrefs").alias("hrefs"),
                        F.size("links").alias("external_links"))


def _article_sql() -> str:
    origin = "regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.\\-]*://[^/?#]*)', 1)"
    pats = " or ".join(f"contains(h, {S.q(p)})" for p in ARTICLE_URL_PATTERNS)
    return f"""
with h as (select page_id, url, regexp_extract_all(html, '{HREF_RE}', 1) as hrefs from pages),
a as (select page_id, list_transform(hrefs, lambda x: case when starts_with(x, '/') then {origin} || x else x end) as abs
      from h)
select page_id, array_to_string(list_filter(abs, lambda h: starts_with(h, 'http') and ({pats}))[1:3], '|') as article_urls,
       len(list_filter(abs, lambda h: starts_with(h, 'http'))) as absolute_links
from a
"""


@register("page_article_urls", sql=_article_sql(), ops=("I9", "F9"))
def q_page_article_urls(spark, sf_dir):
    p = Tables(spark, sf_dir).pages.select("page_id", "url",
                                           F.regexp_extract_all("html", F.lit(HREF_RE), 1).alias("hrefs"))
    origin = F.regexp_extract(F.col("url"), r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)", 1)
    absolute = F.transform("hrefs", lambda h: F.when(F.startswith(h, F.lit("/")), F.concat(origin, h)).otherwise(h))
    return p.select("page_id", F.concat_ws("|", article_urls("hrefs", "url")).alias("article_urls"),
                    F.size(F.filter(absolute, lambda h: F.startswith(h, F.lit("http")))).cast("long")
                    .alias("absolute_links"))


@register("document_bylines", ops=("I10", "B10", "H22"), sql=f"""
select doc_id, array_to_string(
  list_filter(list_transform(list_filter(
      {' || '.join(f"regexp_extract_all(coalesce(text, ''), '{p}', 1)" for p in BYLINE_PATTERNS)},
      lambda n: length(trim(n)) >= 5 and not list_contains({'[' + ', '.join(S.q(a) for a in NOISE_AUTHORS) + ']'}, lower(trim(n)))),
    lambda n: trim(n)), lambda n: true), '|') as bylines_all
from documents
""")
def q_document_bylines(spark, sf_dir):
    """All valid bylines of every document (order kept, duplicates kept here;
    the distinct-in-order form is ``bylines_col``)."""
    d = Tables(spark, sf_dir).documents
    t = F.coalesce(F.col("text"), F.lit(""))
    found = F.concat(*[F.regexp_extract_all(t, F.lit(p), 1) for p in BYLINE_PATTERNS])
    noise = F.array(*[F.lit(a) for a in NOISE_AUTHORS])
    ok = F.transform(F.filter(found, lambda n: (F.length(F.trim(n)) >= 5) &
                              ~F.array_contains(noise, F.lower(F.trim(n)))), lambda n: F.trim(n))
    return d.select("doc_id", F.concat_ws("|", ok).alias("bylines_all"))


@register("document_byline_domains", ops=("I10", "D9"))
def q_document_byline_domains(spark, sf_dir):
    """Distinct bylines per source outlet (bylines merged across articles)."""
    d = Tables(spark, sf_dir).documents.select("source", F.explode(bylines_col("text")).alias("author"))
    return d.groupBy("source").agg(F.count_distinct("author").alias("authors"))


@register("corpus_read", ops=("A3", "E1", "B2"), sql=f"""
with a as (
  select 'd' || cast(doc_id as varchar) as domain, text, '' as links,
         '2024-12-15 03:47:00' as timestamp, 0 as file_rank from documents
  union all
  select lower(trim({sql_url_domain('url')})), {_html_sql('html')}, '', '2024-12-15 03:47:00', 1
  from pages),
b as (select * from a where domain is not null and domain <> '' and length(text) > 50)
select domain, arg_min(text, (file_rank, text)) as text, arg_min(links, (file_rank, text)) as links,
       arg_min(timestamp, (file_rank, text)) as timestamp, cast(min(file_rank) as integer) as file_rank
from b group by domain
""")
def q_corpus_read(spark, sf_dir):
    t = Tables(spark, sf_dir)
    docs = t.documents.select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("domain"), "text")
    pages = t.pages.select(url_domain("url").alias("domain"), html_text("html").alias("body"))
    return tolerant_corpus([docs, pages]).select("domain", "text", "links", "timestamp",
                                                 F.col("file_rank").cast("int").alias("file_rank"))
