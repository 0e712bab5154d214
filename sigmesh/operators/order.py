"""Global order without one task: range partitions, their sizes, prefix offsets.

Rows are sorted over range partitions and written to the shared folder, so that
places and sizes come from the same rows whatever executor is lost. The sizes
(one row per partition) are added up on the driver; each row's place is the
offset of its partition plus its place there. Running totals work alike.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

_PLACE_BITS = 33  # of monotonically_increasing_id


def _checkpointed(df: DataFrame) -> DataFrame:
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def _ranged(df: DataFrame, order: list, keep: Callable | None) -> DataFrame:
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = (keep or _checkpointed)(rows.withColumn("_id", F.monotonically_increasing_id()))
    return rows.withColumn("_part", F.shiftright("_id", _PLACE_BITS))


def with_rank(df: DataFrame, order: list[str | Column], name: str = "rank", keep: Callable | None = None) -> DataFrame:
    """``df`` with the place of each row from 0 in the order of ``order``.

    ``order`` should decide all ties; equal keys share a range partition. ``keep``
    writes a frame and returns a reader of it (default: ``checkpoint()``).
    """
    return with_running(df, order, {}, name, keep)


def with_running(df: DataFrame, order: list[str | Column], totals: dict[str, str | Column], rank: str = "rank",
                 keep: Callable | None = None) -> DataFrame:
    """``df`` with ``rank`` and, for each of ``totals`` (new name to an integer column), its sum over the rows up to each row.

    Within a partition the sums are a window of that partition alone, so no task
    holds more than one range partition.
    """
    rows = _ranged(df.select("*", *[F.coalesce(_col(c), F.lit(0)).cast("long").alias(f"_in_{n}") for n, c in totals.items()]),
                   order, keep)
    sums = [F.sum(f"_in_{n}").alias(f"_in_{n}") for n in totals]
    sizes = sorted(rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"), *sums).collect(), key=lambda r: r["_part"])
    at, offsets = [0] * (1 + len(totals)), []
    for r in sizes:
        offsets.append((r["_part"], *at))
        at = [a + x for a, x in zip(at, r[1:])]
    fields = "_part long, _before long" + "".join(f", _before_{n} long" for n in totals)
    starts = F.broadcast(df.sparkSession.createDataFrame(offsets, fields))  # one row per partition
    out = rows.join(starts, "_part")
    place = F.col("_id").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    out = out.withColumn(rank, F.col("_before") + place)
    if totals:
        from pyspark.sql import Window
        here = Window.partitionBy("_part").orderBy("_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        out = out.withColumns({n: F.col(f"_before_{n}") + F.sum(f"_in_{n}").over(here) for n in totals})
    return out.select(*df.columns, rank, *totals)


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c
