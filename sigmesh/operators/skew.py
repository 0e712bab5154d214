"""Skew-safe building blocks.

Any key here (an IP, an ASN, a registrar, an author name, a link target) may
hold a third of all rows.  Two rules follow:

* aggregate per key with partial (map-side) aggregation, never with a window
  partitioned by the key, so a hot key is combined before the shuffle;
* attach a per-key result back to the rows with a *salted* join: the row side
  is spread over ``buckets`` salts, the per-key side (one row per key) is
  replicated once per salt, so a hot key lands in ``buckets`` tasks instead
  of one.  Nothing is broadcast unless its size is fixed by construction.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_BUCKETS = 32
# A key with at least this many rows is "hot" and is spread over ``buckets``
# tasks; the hot-key list is capped, so broadcasting it is size-bounded.
HOT_MIN_ROWS = 200_000
MAX_HOT_KEYS = 1_000


def reuse(df: DataFrame) -> DataFrame:
    """Mark an intermediate that one plan reads more than once (for example
    the rows of a salted join, which feed the per-key sizes, the hot-key list
    and the join itself).  Without it each branch re-scans the source tables;
    with it the source is read once and the copy (memory, spilling to disk) is
    recomputed from lineage if an executor is lost."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def salt_of(cols, buckets: int) -> Column:
    cols = [F.col(c) if isinstance(c, str) else c for c in cols]
    return F.pmod(F.xxhash64(*cols), F.lit(buckets)).cast("int")


def hot_keys(per_key: DataFrame, keys: list[str], size_col: str, hot_min: int = HOT_MIN_ROWS,
             max_hot: int = MAX_HOT_KEYS) -> DataFrame:
    """The largest keys with at least ``hot_min`` rows, at most ``max_hot`` of them."""
    return (per_key.filter(F.col(size_col) >= hot_min).orderBy(F.desc(size_col)).limit(max_hot)
            .select(*keys, F.lit(True).alias("__hot")))


def salted_join(rows: DataFrame, per_key: DataFrame, keys: list[str], how: str = "left",
                salt_by: list[str] | None = None, buckets: int = DEFAULT_BUCKETS,
                size_col: str | None = None, hot_min: int = HOT_MIN_ROWS, kept: bool = False) -> DataFrame:
    """Join ``per_key`` (one row per key, with its row count ``size_col``)
    onto ``rows``, splitting hot keys.

    Rows of a hot key get a salt ``hash(salt_by) mod buckets`` and the hot
    key's per-key row is replicated once per salt, so its rows are spread
    over ``buckets`` tasks; every other key keeps salt 0 and is joined once.
    Without ``size_col`` every key is treated as hot (full salting).
    ``kept``: ``rows`` are stored already and need no copy of their own."""
    salt_by = salt_by or rows.columns
    rows = rows if kept else reuse(rows)
    if size_col is None:
        r = rows.withColumn("__salt", salt_of(salt_by, buckets))
        k = per_key.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))))
        return r.join(k, keys + ["__salt"], how).drop("__salt")
    hot = F.broadcast(hot_keys(per_key, keys, size_col, hot_min))
    r = (rows.join(hot, keys, "left")
         .withColumn("__salt", F.when(F.col("__hot"), salt_of(salt_by, buckets)).otherwise(F.lit(0)))
         .drop("__hot"))
    k = (per_key.join(hot, keys, "left")
         .withColumn("__salt", F.explode(F.when(F.col("__hot"), F.sequence(F.lit(0), F.lit(buckets - 1)))
                                         .otherwise(F.array(F.lit(0)))))
         .drop("__hot"))
    return r.join(k, keys + ["__salt"], how).drop("__salt")


def group_sizes(df: DataFrame, keys: list[str], name: str = "group_size",
                distinct_of: str | None = None) -> DataFrame:
    """Rows (or distinct ``distinct_of`` values) per key, via partial aggregation."""
    if distinct_of:
        df = df.select(*keys, distinct_of).distinct()
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def with_group_size(rows: DataFrame, keys: list[str], name: str, salt_by: list[str],
                    buckets: int = DEFAULT_BUCKETS) -> DataFrame:
    """Attach the size of each row's key group without a key-partitioned window."""
    rows = reuse(rows)
    sizes = group_sizes(rows.select(*keys), keys, name)
    return salted_join(rows, sizes, keys, "left", salt_by, buckets, size_col=name)


def one_row_join(rows: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a single-row aggregate (a global count) to every
    row as scalar subqueries: each value is computed once and inlined, so
    the plan has no join — in particular no nested-loop or cartesian join."""
    return rows.select("*", *[one_row.select(c).scalar().alias(c) for c in one_row.columns])


def top_k_per_key(df: DataFrame, key: str, order_cols: list, k: int, salt_by: list[str],
                  buckets: int = DEFAULT_BUCKETS) -> DataFrame:
    """Top ``k`` rows per key in two stages (per key+salt, then per key), so a
    hot key is ranked in ``buckets`` tasks and the final stage sees at most
    ``k * buckets`` rows per key."""
    from pyspark.sql import Window
    s = df.withColumn("__salt", salt_of(salt_by, buckets))
    w1 = Window.partitionBy(key, "__salt").orderBy(*order_cols)
    s = s.withColumn("__rn", F.row_number().over(w1)).filter(F.col("__rn") <= k).drop("__rn", "__salt")
    w2 = Window.partitionBy(key).orderBy(*order_cols)
    return s.withColumn("rank", F.row_number().over(w2)).filter(F.col("rank") <= k)
