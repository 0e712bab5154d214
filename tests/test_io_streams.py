"""Sources, sinks and streams on small files written to a fresh scratch folder."""

import json
import os
import tempfile

from pyspark.sql import functions as F

from sigmesh.operators.monitor import latest_run, monitor_health, rate_trend, read_runs, run_timeline
from sigmesh.sources.files import export_report, get_report, new_report_id, save_reports, write_metrics
from sigmesh.streaming.monitor import dedup_feed, feed_stream, run_append


def scratch():
    return tempfile.mkdtemp(prefix="sigmesh-test-", dir="/tmp")


def test_feed_stream_dedup_and_late_rows(spark):
    d = scratch()
    feed = os.path.join(d, "feed")
    os.makedirs(feed)
    docs = [("2026-03-25T00:00:00Z", ["a.com", "b.com"]), ("2026-03-25T01:00:00Z", ["a.com", "c.com"]),
            ("2026-03-28T00:00:00Z", ["e.com"]), ("2026-03-20T00:00:00Z", ["late.com"])]
    for i, (ts, doms) in enumerate(docs):
        with open(os.path.join(feed, f"f{i}.json"), "w") as f:
            f.write(json.dumps({"source": "social", "fetched_at": ts, "domains": doms}) + "\n")
    out = run_append(spark, dedup_feed(feed_stream(spark, feed, max_files=1), "fetched_at", "24 hours"), "t")
    got = sorted(r.domain for r in out.collect())
    # the repeat of a.com within the horizon is dropped; the late file is behind the watermark
    assert got == ["a.com", "b.com", "c.com", "e.com"]


def test_run_log_views(spark):
    d = scratch()
    p = os.path.join(d, "runs.jsonl")
    lines = [{"ran_at": "2026-03-25T20:05:26.912020", "whoisds_count": 5, "reddit_count": 9, "queued_unique": 12,
              "batches": 2, "results": 12, "synthetic_batches": 1},
             {"ran_at": "2026-03-26T02:05:00+00:00", "whoisds_count": 1, "reddit_count": 3, "queued_unique": 4,
              "batches": 1, "results": 4, "synthetic_batches": 1}]
    with open(p, "w") as f:
        f.write(json.dumps(lines[0]) + "\n\nnot json\n" + json.dumps(lines[1]) + "\n")
    runs = read_runs(spark, p)
    assert runs.count() == 2
    t = {r.run: r.synthetic_rate for r in run_timeline(runs).collect()}
    assert t == {"Run 1": 0.5, "Run 2": 1.0}
    tr = rate_trend(runs).collect()[0]
    assert (tr.first_rate, tr.last_rate, tr.arrow) == (0.5, 1.0, "↑")
    h = monitor_health(runs).collect()[0]
    assert (h.total, h.synthetic, h.organic, h.synthetic_pct) == (3, 2, 1, 66.7)
    assert latest_run(runs).collect()[0].status == "ok"


def test_reports_and_metrics(spark):
    d = scratch()
    rid = new_report_id()
    rep = spark.createDataFrame([(rid, "SYNTHETIC", 0.9)], "report_id string, cluster_verdict string, confidence double")
    save_reports(rep, os.path.join(d, "reports"))
    assert get_report(spark, os.path.join(d, "reports"), rid).count() == 1
    assert get_report(spark, os.path.join(d, "reports"), "../etc/passwd").count() == 0
    doc = export_report(rep).collect()[0].document
    assert json.loads(doc)["cluster_verdict"] == "SYNTHETIC"
    m = os.path.join(d, "metrics")
    write_metrics(spark.createDataFrame([("f1", 0.7)], "metric string, value double"), m, "ablation")
    write_metrics(spark.createDataFrame([("auc", 0.8)], "metric string, value double"), m, "comparison")
    write_metrics(spark.createDataFrame([("f1", 0.6)], "metric string, value double"), m, "ablation")
    got = {(r.section, r.metric): r.value for r in spark.read.parquet(m).collect()}
    assert got == {("ablation", "f1"): 0.6, ("comparison", "auc"): 0.8}


class _Conf:
    def get(self, key, default=None):
        return default


class _Ctx:
    def __init__(self, master, ckpt=None):
        self.master, self._ckpt = master, ckpt

    def getCheckpointDir(self):
        return self._ckpt

    def getConf(self):
        return _Conf()

    def setCheckpointDir(self, d):
        self._ckpt = d


class _Session:
    def __init__(self, ctx):
        self.sparkContext = ctx


def test_checkpoint_dir_is_taken_from_the_session_and_never_local_on_a_cluster():
    import pytest

    from sigmesh.session import ensure_checkpoint_dir
    # a configured shared folder is used as is
    assert ensure_checkpoint_dir(_Session(_Ctx("yarn", "hdfs:///shared/ckpt"))) == "hdfs:///shared/ckpt"
    # unset on a cluster master: refuse rather than fall back to a machine-local folder
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(_Session(_Ctx("yarn")))
    # unset on a local master (tests): a local folder is made
    assert ensure_checkpoint_dir(_Session(_Ctx("local[2]"))).startswith("/tmp/")


def test_stream_of_unordered_files_equals_batch(spark, tmp_path):
    from pyspark.sql import functions as F
    from sigmesh.streaming.monitor import cadence_stream, parquet_stream, run_updates, timeline
    ev = spark.range(600).select(F.concat(F.lit("d"), F.col("id") % 7).alias("domain"),
                                 F.timestamp_seconds(F.lit(1700000000) + F.col("id") * 1800).alias("ts"))
    path = str(tmp_path / "ev.parquet")
    for part in (2, 0, 3, 1):  # the latest times come first
        ev.filter(F.floor(F.unix_timestamp("ts") % 4000 / 1000) == part).orderBy(F.desc("ts")).coalesce(1).write.mode("append").parquet(path)
    got = run_updates(spark, cadence_stream(parquet_stream(spark, path)), ["domain", "window_start"], ["pages"], "unordered")
    want = ev.groupBy("domain", F.window("ts", "1 hour").alias("w")).agg(F.count(F.lit(1)).alias("pages"))
    assert {tuple(r) for r in got.collect()} == {(r.domain, r.w.start, r.pages) for r in want.collect()}
    line = run_updates(spark, timeline(parquet_stream(spark, path)), ["window_start", "window_end"], ["events"], "unordered2")
    assert sum(r.events for r in line.collect()) == 600
