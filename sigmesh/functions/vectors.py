"""Vector expressions on ``array<float>`` columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def dot(a, b) -> Column:
    return F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: x.cast("double") * y.cast("double")),
                       F.lit(0.0), lambda acc, x: acc + x)


def norm(a) -> Column:
    return F.sqrt(F.aggregate(_c(a), F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))


def unit(a) -> Column:
    """L2-normalised vector; a zero vector stays zero."""
    # the norm is bound first: inside the inner function it would be taken again for each component
    scaled = F.transform(F.array(norm(a)), lambda n: F.transform(_c(a), lambda x: F.when(n > 0, x.cast("double") / n).otherwise(F.lit(0.0))))
    return F.get(scaled, F.lit(0))


def cosine(a, b) -> Column:
    """Cosine similarity of two vectors."""
    return dot(a, b) / (norm(a) * norm(b))
