"""Shared-author signal.

A byline shared by many domains would yield a quadratic number of pairs, so
pairs are not emitted: each (author, domain) membership of an author seen on
more than one domain is an edge of the author "hyperedge".  Counts come from
partial aggregation and a salted join; the names kept per domain for the
explanation are a two-stage bounded top-3.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.domains import author_norm, valid_author
from ..session import stored
from .skew import group_sizes, salted_join, top_k_per_key


def author_memberships(bylines: DataFrame) -> DataFrame:
    """(domain, author_norm, author) for valid bylines of shared authors, with
    ``author_domains`` = distinct domains of that author (> 1). Bylines once a
    domain are stored: their shuffle ends with that, and columns of names take
    a fraction of what cached rows spill."""
    b = stored(bylines.filter(valid_author("author"))
              .select("domain", author_norm("author").alias("author_norm"), F.col("author"))
              .groupBy("domain", "author_norm").agg(F.min("author").alias("author")))
    sizes = group_sizes(b.select("author_norm"), ["author_norm"], "author_domains")
    return salted_join(b, sizes, ["author_norm"], "inner", ["domain"], size_col="author_domains", kept=True) \
        .filter(F.col("author_domains") > 1)


def author_signal(domains: DataFrame, bylines: DataFrame, top: int = 3) -> DataFrame:
    """Per domain: shared_author_count, shared_authors (first ``top`` names by
    order), author_overlap_flagged."""
    m = stored(author_memberships(bylines))
    counts = m.groupBy("domain").agg(F.count(F.lit(1)).alias("shared_author_count"))
    firsts = (top_k_per_key(m, "domain", [F.col("author_norm")], top, ["author_norm"])
              .groupBy("domain")
              .agg(F.array_sort(F.collect_list(F.struct("rank", "author"))).alias("a")))
    names = firsts.select("domain", F.transform("a", lambda x: x["author"]).alias("shared_authors"))
    j = domains.select("domain").join(counts, "domain", "left").join(names, "domain", "left")
    n = F.coalesce(F.col("shared_author_count"), F.lit(0))
    return j.select(
        "domain",
        n.cast("int").alias("shared_author_count"),
        F.coalesce(F.col("shared_authors"), F.array().cast("array<string>")).alias("shared_authors"),
        (n > 0).cast("int").alias("author_overlap_flagged"),
    )


def author_pair_counts(memberships: DataFrame) -> DataFrame:
    """Implied undirected pairs per shared author: n·(n−1)/2."""
    return (memberships.select("author_norm", "author_domains").distinct()
            .select("author_norm", F.col("author_domains").cast("long").alias("n"),
                    (F.col("author_domains") * (F.col("author_domains") - 1) / 2).cast("long").alias("pairs")))
