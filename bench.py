"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line: {"metric", "value", "unit", "queries", "sf"}.
Each query is timed end to end (plan + execute) with a full write-free
action (``count`` over the whole result via a no-op sink), after one warm-up
run of a tiny query so JVM start-up is not charged to the first query.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from sigmesh.plans.registry import load_all  # noqa: E402
from sigmesh.session import build_session  # noqa: E402

HEADLINE = (
    "cadence_features",
    "text_clean_english",
    "registration_signal",
    "hosting_signal",
    "link_signal",
    "archive_signal",
    "author_signal",
    "similarity_pairs_exact",
    "similarity_scores",
    "feature_table",
    "analysis_verdicts",
    "evaluation_confusion",
    "graph_degrees",
    "page_parse",
)


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None
    spark = build_session(f"local[{cpus}]", int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", cpus)),
                          app_name="sigmesh-bench")
    reg = load_all()
    names = [n for n in HEADLINE if n in reg]
    # warm-up: JVM, codegen caches
    reg["cadence_features"].build(spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for n in names:
        spark.catalog.clearCache()  # each query starts cold, as its own job would
        t0 = time.perf_counter()
        reg[n].build(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[n] = round(time.perf_counter() - t0, 3)
    spark.stop()
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
