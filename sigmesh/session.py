"""Session construction and cluster-safe scratch locations."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

# Settings a cluster job relies on: AQE re-plans joins and coalesces small
# shuffles, skew-join splits hot partitions, UTC keeps timestamps stable.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "sigmesh", extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench; a cluster passes its own master."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    conf.update({
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.driver.memory": os.environ.get("SIGMESH_DRIVER_MEMORY", "16g"),
        "spark.driver.host": "127.0.0.1",
        "spark.driver.bindAddress": "127.0.0.1",
    })
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    # The shared folder comes from the cluster's config; only an unset one
    # (tests, local runs) gets a local folder.
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster that setting points at shared storage and is used as is.
    Only when it is unset on a local master (tests, local runs) is a fresh
    local folder made; a cluster without it is an error, since a machine-local
    folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder for cluster runs")
        d = tempfile.mkdtemp(prefix="sigmesh-ckpt-", dir="/tmp")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def tidy(spark: SparkSession) -> None:
    """From now on shuffle files of a finished job go at once, not when the driver happens to collect garbage."""
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def stored(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder as columns and read from there: cut from its lineage like ``checkpoint()``,
    but compressed, and with a size the planner knows."""
    spark = df.sparkSession
    tidy(spark)
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/rows-{uuid.uuid4().hex[:12]}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once per application, for their Python workers."""
    tidy(spark)
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    top = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="sigmesh-ship-"), "sigmesh_package.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(top):
            for n in names:
                if n.endswith(".py"):
                    path = os.path.join(folder, n)
                    z.write(path, os.path.relpath(path, os.path.dirname(top)))
    spark.sparkContext.addPyFile(target)
    _SHIPPED.add(app)
