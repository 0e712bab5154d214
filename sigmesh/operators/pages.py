"""Page jobs: HTML to text, links, article URLs and bylines (I8-I10, B1, B2,
B34, E1, F9, H22, G3).

``html_text`` is the pure-expression form (regular expressions only, runs in
codegen).  ``parse_pages`` is the structural parser: ``mapInPandas`` over the
standard-library ``html.parser`` on each Arrow batch — per-row Python stays a
small helper, Spark partitions the pages.
"""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import ARTICLE_URL_PATTERNS, BYLINE_PATTERNS, NOISE_AUTHORS, STRIP_CLASSES, STRIP_TAGS
from ..functions.domains import normalize_domain, parent_domain, url_domain
from ..functions.text import clean_text, is_english
from ..functions.timeparts import parse_ts

# Regex steps of the expression form, applied in order.
HTML_STRIP_STEPS = (
    (r"(?is)<script[^>]*>.*?</script>", " "),
    (r"(?is)<style[^>]*>.*?</style>", " "),
    (r"(?s)<!--.*?-->", " "),
    (r"<[^>]*>", " "),
)


def html_text(col) -> F.Column:
    """Visible text of an HTML string by regular expressions (no script,
    style, comments or tags); whitespace collapsed."""
    c = F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))
    for pat, rep in HTML_STRIP_STEPS:
        c = F.regexp_replace(c, pat, rep)
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def first_per_domain(df: DataFrame, order_col: str) -> DataFrame:
    """Keep the first row per domain by an explicit ordinal.

    Uses ``min_by`` on a struct — a partial aggregation — rather than a
    window partitioned by domain, so a domain with a third of all pages is
    reduced map-side."""
    cols = [c for c in df.columns if c != "domain"]
    return (df.groupBy("domain").agg(F.min_by(F.struct(*cols), F.col(order_col)).alias("r"))
              .select("domain", "r.*"))


def clean_pages(raw: DataFrame, cfg, order_col: str = "ord") -> DataFrame:
    """Clean pipeline (B1): normalise domain, drop null, first per domain,
    clean text, length >= min, English, clean links and timestamp, text_len."""
    d = raw.withColumn("domain", normalize_domain("domain")).filter(F.col("domain").isNotNull())
    d = first_per_domain(d, order_col)
    d = d.withColumn("text", clean_text("text")).filter(F.length("text") >= cfg.min_text_len)
    d = d.filter(is_english("text"))
    if "links" in d.columns:
        from .links import clean_links
        d = d.withColumn("links", F.concat_ws("|", clean_links("links")))
    if "timestamp" in d.columns:
        d = d.withColumn("timestamp", parse_ts("timestamp"))
    return d.withColumn("text_len", F.length("text"))


def is_redirect(df: DataFrame) -> DataFrame:
    """Final domain differs and belongs to another parent site."""
    return df.withColumn("is_redirect",
                         F.col("final_domain").isNotNull() & (F.col("final_domain") != F.col("domain")) &
                         (parent_domain("final_domain") != parent_domain("domain")))


def article_urls(links_col, base_url_col, k: int = 3) -> F.Column:
    """Article-shaped absolute URLs, first ``k`` (I9).  Relative links are
    made absolute against the page's scheme://host."""
    origin = F.regexp_extract(F.col(base_url_col), r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)", 1)
    absolute = F.transform(F.col(links_col) if isinstance(links_col, str) else links_col,
                           lambda h: F.when(F.startswith(h, F.lit("/")), F.concat(origin, h)).otherwise(h))
    pats = F.array(*[F.lit(p) for p in ARTICLE_URL_PATTERNS])
    keep = F.filter(absolute, lambda h: F.startswith(h, F.lit("http")) &
                    F.exists(pats, lambda p: F.contains(h, p)))
    return F.slice(keep, 1, k)


def bylines_col(text_col) -> F.Column:
    """Bylines from text (I10): three patterns in order, each name of length
    >= 5 and not a desk name, distinct in first-seen order."""
    t = F.coalesce(F.col(text_col) if isinstance(text_col, str) else text_col, F.lit(""))
    found = F.concat(*[F.regexp_extract_all(t, F.lit(p), 1) for p in BYLINE_PATTERNS])
    noise = F.array(*[F.lit(a) for a in NOISE_AUTHORS])
    ok = F.filter(found, lambda n: (F.length(F.trim(n)) >= 5) & ~F.array_contains(noise, F.lower(F.trim(n))))
    return F.array_distinct(F.transform(ok, lambda n: F.trim(n)))


class _Extractor(HTMLParser):
    """Collects visible text (all, and body without boilerplate) and hrefs."""

    VOID = {"br", "img", "meta", "link", "input", "hr", "area", "base", "col", "embed", "source", "wbr"}

    def __init__(self, token_classes: bool):
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, bool, bool]] = []  # (tag, dropped_all, dropped_body)
        self.text: list[str] = []
        self.body: list[str] = []
        self.article: list[str] = []
        self.hrefs: list[str] = []
        self.token_classes = token_classes
        self.in_article = 0

    def _drop_body(self, tag, attrs):
        if tag in STRIP_TAGS:
            return True
        a = dict(attrs)
        cls = " ".join([a.get("class") or "", a.get("id") or ""]).lower()
        if self.token_classes:
            toks = set(cls.replace("_", "-").split())
            return any(k.rstrip("-") in toks or (k.endswith("-") and any(t.startswith(k) for t in toks))
                       for k in STRIP_CLASSES)
        return any(k in cls for k in STRIP_CLASSES)

    def handle_starttag(self, tag, attrs):
        if tag == "a":
            href = dict(attrs).get("href")
            if href:
                self.hrefs.append(href)
        if tag in self.VOID:
            return
        parent_all = self.stack[-1][1] if self.stack else False
        parent_body = self.stack[-1][2] if self.stack else False
        drop_all = parent_all or tag in ("script", "style", "nav", "footer", "header", "aside", "form")
        drop_body = parent_body or self._drop_body(tag, attrs)
        is_art = tag in ("article", "main") or dict(attrs).get("role") == "main"
        self.stack.append((tag, drop_all, drop_body, is_art))
        if is_art:
            self.in_article += 1

    def handle_endtag(self, tag):
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                for t in self.stack[i:]:
                    if t[3]:
                        self.in_article -= 1
                del self.stack[i:]
                return

    def handle_data(self, data):
        top = self.stack[-1] if self.stack else ("", False, False, False)
        if not top[1]:
            self.text.append(data)
        if not top[2]:
            self.body.append(data)
            if self.in_article > 0:
                self.article.append(data)


def _parse_batch(it, token_classes: bool, max_chars: int | None):
    for pdf in it:
        texts, bodies, links = [], [], []
        for html in pdf["html"].fillna(""):
            p = _Extractor(token_classes)
            try:
                p.feed(html)
                p.close()
            except Exception:  # malformed markup: keep what was read
                pass
            src = p.article if p.article else p.body
            t, b = " ".join(" ".join(p.text).split()), " ".join(" ".join(src).split())
            texts.append(t[:max_chars] if max_chars else t)
            bodies.append(b[:max_chars] if max_chars else b)
            links.append(p.hrefs)
        yield pd.DataFrame({"page_id": pdf["page_id"], "url": pdf["url"], "text": texts,
                            "body_text": bodies, "hrefs": links})


def parse_pages(pages: DataFrame, token_classes: bool = True, max_chars: int | None = 2000) -> DataFrame:
    """Structural parse of every page (I8): text (boilerplate tags removed),
    body_text (article/main preferred, boilerplate classes removed), hrefs."""
    schema = "page_id long, url string, text string, body_text string, hrefs array<string>"
    return pages.select("page_id", "url", "html").mapInPandas(
        lambda it: _parse_batch(it, token_classes, max_chars), schema)


def outlinks_from_hrefs(parsed: DataFrame, k: int = 15, keep: tuple = ()) -> DataFrame:
    """Links to other sites (I8): absolute hrefs whose host is another parent
    site, distinct in first-seen order, first ``k`` (F9, K10); ``keep`` are
    columns carried along."""
    src = url_domain("url")
    hosts = F.transform(F.filter("hrefs", lambda h: F.startswith(h, F.lit("http"))), lambda h: url_domain(h))
    other = F.filter(hosts, lambda h: h.isNotNull() & (h != src) & (parent_domain(h) != parent_domain(src)))
    return parsed.select("page_id", src.alias("domain"), F.slice(F.array_distinct(other), 1, k).alias("links"), *keep)
