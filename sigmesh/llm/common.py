"""Scratch tables in the shared folder, and small frame helpers."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sigmesh.session import ensure_checkpoint_dir, ship_package


def shared_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a local one only where it is unset (tests)."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    local = ensure_checkpoint_dir(spark)
    return (named or local).rstrip("/")


class Scratch:
    """Parquet tables of one run, under a folder of its own in the shared checkpoint folder.

    A written table cuts the lineage and survives the loss of any executor.
    """

    def __init__(self, spark: SparkSession, job: str):
        self.spark = spark
        ship_package(spark)
        self.root = f"{shared_root(spark)}/sigmesh-{job}-{uuid.uuid4().hex[:12]}"
        self._n = 0

    def table(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and return a reader of it."""
        path = self.path(name)
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def path(self, name: str) -> str:
        self._n += 1
        return f"{self.root}/{self._n:03d}-{name}"

    def drop(self, df: DataFrame) -> None:
        """Delete the files behind a table of this run that nothing reads any more."""
        jvm, sc = self.spark._jvm, self.spark.sparkContext
        for f in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            if f.split(":", 1)[-1].lstrip("/").startswith(self.root.split(":", 1)[-1].lstrip("/")):
                p = jvm.org.apache.hadoop.fs.Path(f)
                p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)


def documents(df: DataFrame, *more: str) -> DataFrame:
    """``doc_id`` as long and ``text`` with null as empty, and no other column (so none can clash)."""
    return df.select(F.col("doc_id").cast("long").alias("doc_id"),
                     F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *more)


def salted_left_join(left: DataFrame, right: DataFrame, keys: list[str], spread: str, salts: int = 16) -> DataFrame:
    """Left join to a table of one row per key, when one key may hold a third of ``left``.

    ``left`` rows of a key spread over ``salts`` by the hash of the column
    ``spread``; each row of ``right`` is repeated once per salt. Callers pass a
    ``right`` that is small beside ``left`` (only keys of several rows).
    """
    a = left.withColumn("_salt", F.pmod(F.xxhash64(F.col(spread)), F.lit(salts)).cast("int"))
    b = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return a.join(b, [*keys, "_salt"], "left").drop("_salt")
