"""Monitor cycles on a stream of feed rows.

Each micro-batch is one cycle: its distinct domains in order, the first ``cap``
(the cycle's own rule), cut into chunks of ``size``; every chunk is given to the
analysis by itself; results and a summary line are written under the batch's
id. A batch that runs again writes the same rows to the same folders, and its
summary, written last, decides whether its results count: a cycle that failed
midway leaves nothing that readers see.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.monitor import plan_batches
from ..session import ensure_checkpoint_dir

SUMMARY = ("batch_id long, ran_at timestamp, whoisds_count int, reddit_count int, queued_unique int, batches int, "
           "results int, synthetic_batches int")
RESULTS = "batch_id long, chunk int, domain string, verdict string"

#: A frame of one chunk's domains to a frame of (domain, verdict).
Analysis = Callable[[DataFrame], DataFrame]


class CycleStore:
    """Results and summaries of cycles, a folder per batch id."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _folder(self, table: str, batch_id: int) -> str:
        return f"{self.path}/{table}/batch_id={batch_id}"

    def _read(self, table: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).option("basePath", f"{self.path}/{table}").parquet(f"{self.path}/{table}/batch_id=*")
        except AnalysisException as e:
            if "PATH_NOT_FOUND" in str(e):
                return self.spark.createDataFrame([], schema)
            raise

    def summaries(self) -> DataFrame:
        return self._read("summaries", SUMMARY)

    def results(self) -> DataFrame:
        """Results of finished cycles alone."""
        return self._read("results", RESULTS).join(self.summaries().select("batch_id"), "batch_id", "left_semi")

    def cycle(self, batch: DataFrame, batch_id: int, analyse: Analysis, cap: int = 40, size: int = 10) -> None:
        """One cycle over a micro-batch of (source, domain, ran_at): 'registration' and 'social' rows."""
        batch = batch.persist()  # counted and planned; released below
        try:
            counts = batch.agg(F.max("ran_at").alias("ran_at"),
                               F.count_distinct(F.when(F.col("source") == "registration", F.col("domain"))).cast("int").alias("whoisds_count"),
                               F.count_distinct(F.when(F.col("source") == "social", F.col("domain"))).cast("int").alias("reddit_count")).first()
            if counts["ran_at"] is None:
                return
            chunks: dict[int, list[str]] = {}
            for r in plan_batches(batch.filter("domain IS NOT NULL"), cap, size).collect():  # at most ``cap`` names
                chunks.setdefault(r["batch_id"], []).append(r["domain"])
        finally:
            batch.unpersist()
        done = None
        for chunk, names in sorted(chunks.items()):
            found = analyse(self.spark.createDataFrame([(n,) for n in names], "domain string"))
            found = found.select(F.lit(chunk).alias("chunk"), "domain", "verdict")
            done = found if done is None else done.unionByName(found)
        synthetic = 0
        if done is not None:
            done.coalesce(1).write.mode("overwrite").parquet(self._folder("results", batch_id))
            kept = self.spark.read.parquet(self._folder("results", batch_id))
            synthetic = kept.filter("verdict = 'SYNTHETIC'").select("chunk").distinct().count()
        line = (counts["ran_at"], counts["whoisds_count"], counts["reddit_count"], sum(map(len, chunks.values())), len(chunks), len(chunks), synthetic)
        fields = SUMMARY.split(", ", 1)[1]
        self.spark.createDataFrame([line], fields).coalesce(1).write.mode("overwrite").parquet(self._folder("summaries", batch_id))


def run_cycles(feed: DataFrame, analyse: Analysis, store: CycleStore | None = None, cap: int = 40, size: int = 10,
               available_now: bool = True, every: str = "6 hours"):
    """Drive the cycles of a streaming ``feed`` (source, domain, ran_at); returns the store, or the running query."""
    spark = feed.sparkSession
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/cycles-{uuid.uuid4().hex[:12]}"
    store = store or CycleStore(spark, f"{base}/store")
    w = (feed.writeStream.outputMode("append").option("checkpointLocation", f"{base}/progress")
         .foreachBatch(lambda batch, batch_id: store.cycle(batch, batch_id, analyse, cap, size)))
    if not available_now:
        return w.trigger(processingTime=every).start()
    w.trigger(availableNow=True).start().awaitTermination()
    return store
