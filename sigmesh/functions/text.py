"""Text expressions (clean text, English test, syndication, excerpts).

All of them are built-in column expressions, so they run inside whole-stage
codegen and need no Python on the executors.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import ENGLISH_WORDS, SYNDICATION_MARKERS, NAV_PHRASES


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


WHITESPACE = " \t\n\x0b\x0c\r"


def strip_ws(col) -> Column:
    """Remove leading and trailing whitespace of any kind (not only spaces)."""
    return F.btrim(_c(col), F.lit(WHITESPACE))


def clean_text(col) -> Column:
    """Entities to space, drop non-ASCII, drop URLs, keep word chars and
    ``.,!?-``, collapse whitespace (H6)."""
    t = F.coalesce(_c(col), F.lit(""))
    t = F.regexp_replace(t, r"&[a-zA-Z]+;", " ")
    t = F.regexp_replace(t, r"[^\x00-\x7F]", "")
    t = F.regexp_replace(t, r"http\S+", "")
    # "special char -> space" then "whitespace run -> one space" in one pass:
    # a maximal run of chars that are neither word chars nor kept punctuation
    # (specials and whitespace alike) becomes exactly one space.
    t = F.regexp_replace(t, r"[^\w.,!?\-]+", " ")
    return F.trim(t)


def english_hits(col) -> Column:
    """Number of stop words present as `` w `` in the lower-cased text.

    One split on single spaces: a word occurs as `` w `` exactly when it is a
    token with a space on both sides, i.e. any token but the first and last.
    The distinct intersection with the word list counts each word once."""
    toks = F.split(F.lower(F.coalesce(_c(col), F.lit(""))), " ")
    n = F.size(toks)
    inner = F.when(n >= 3, F.slice(toks, 2, n - 2)).otherwise(F.array().cast("array<string>"))
    return F.size(F.array_intersect(inner, F.array(*[F.lit(w) for w in ENGLISH_WORDS])))


def is_english(col) -> Column:
    """Text of at least 50 chars with at least 3 stop words."""
    c = _c(col)
    return F.coalesce((F.length(c) >= 50) & (english_hits(c) >= 3), F.lit(False))


def excerpt(col, n: int = 400) -> Column:
    """First ``n`` characters, whitespace-trimmed."""
    return strip_ws(F.substring(F.coalesce(_c(col), F.lit("")), 1, n))


def is_syndicated(col, n: int = 400) -> Column:
    """Any syndication marker inside the lower-cased excerpt."""
    low = F.lower(excerpt(col, n))
    return reduce(lambda a, b: a | b, [F.locate(m, low) > 0 for m in SYNDICATION_MARKERS])


def nav_phrase_flags(col, n: int = 600) -> Column:
    """Array of 0/1 per navigation phrase found in the first ``n`` lower chars."""
    low = F.substring(F.lower(F.coalesce(_c(col), F.lit(""))), 1, n)
    return F.array(*[(F.locate(p, low) > 0).cast("int") for p in NAV_PHRASES])


def min_text(col, n: int) -> Column:
    """Keep rows whose text is longer than ``n`` (B2)."""
    return F.length(_c(col)) > n
