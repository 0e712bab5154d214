"""Page archives written and read back (A1)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from ..sources.archive import read_pages_archive, write_archive
from ..sources.tables import Tables
from .registry import register


@register("page_archive", ops=("A1",), sql="""
select url, length(html) as html_chars, md5(html) as html_md5 from pages
where page_id % 7 <> 3 and page_id % 11 <> 5 and starts_with(url, 'http') and length(html) >= 100
""")
def q_page_archive(spark, sf_dir):
    """All pages as archive records, some of them requests or images; the pages that the filters leave."""
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/archive-{uuid.uuid4().hex[:12]}"
    p = Tables(spark, sf_dir).pages
    kind = F.when(F.col("page_id") % 7 == 3, "request").otherwise("response")
    mime = F.when(F.col("page_id") % 11 == 5, "image/png").otherwise("text/html; charset=utf-8")
    write_archive(p.select("url", "html", kind.alias("record_type"), mime.alias("content_type")), base)
    return read_pages_archive(spark, base).select("url", F.length("html").alias("html_chars"), F.md5(F.encode("html", "UTF-8")).alias("html_md5"))
