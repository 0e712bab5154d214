"""Timestamp and date expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


SPACE_FMT = "yyyy-MM-dd HH:mm:ss"
T_FMT = "yyyy-MM-dd'T'HH:mm:ss"


def parse_ts(col) -> Column:
    """Standard ``yyyy-MM-dd HH:mm:ss`` text from the crawl form; unparsed values
    are kept as their first 19 characters (H8)."""
    head = F.substring(_c(col).cast("string"), 1, 19)
    return F.coalesce(F.date_format(F.try_to_timestamp(head, F.lit(T_FMT)), SPACE_FMT), head)


def to_ts(col) -> Column:
    """Timestamp from either text form (space or ``T``); null when neither parses."""
    c = _c(col)
    head = F.substring(c.cast("string"), 1, 19)
    return F.coalesce(F.try_to_timestamp(head, F.lit(SPACE_FMT)),
                      F.try_to_timestamp(head, F.lit(T_FMT)))


def hour_of(ts) -> Column:
    """Hour, −1 when the value is missing (H9)."""
    return F.coalesce(F.hour(_c(ts)), F.lit(-1))


def minute_of(ts) -> Column:
    return F.coalesce(F.minute(_c(ts)), F.lit(-1))


def weekday_of(ts) -> Column:
    """Day of week with Monday = 0, −1 when missing (H9)."""
    return F.coalesce(F.weekday(_c(ts)), F.lit(-1))


def age_days(date_col, as_of: str) -> Column:
    """Whole days between a date/timestamp and ``as_of``."""
    return F.datediff(F.to_timestamp(F.lit(as_of)), _c(date_col))


def parse_created(col) -> Column:
    """Creation date from ISO text, its first 19 or first 10 chars."""
    c = F.regexp_replace(_c(col).cast("string"), "Z$", "")
    return F.coalesce(F.try_to_timestamp(F.substring(c, 1, 19), F.lit(T_FMT)),
                      F.try_to_timestamp(F.substring(c, 1, 19), F.lit(SPACE_FMT)),
                      F.try_to_timestamp(F.substring(c, 1, 10), F.lit("yyyy-MM-dd")))


def contamination(n) -> Column:
    """Bounded outlier share ``clamp(1/n, .1, .3)`` (H19); ``.1`` for n <= 0."""
    n = _c(n) if not isinstance(n, int) else F.lit(n)
    return F.when(n <= 0, F.lit(0.1)).otherwise(F.least(F.lit(0.3), F.greatest(F.lit(0.1), 1.0 / n)))
