"""Benchmark the headline queries at ``$BENCH_SF_DIR`` (default sf0.1) on
``local[$BENCH_CPUS]``; print one JSON line.

Each query is forced to completion through the ``noop`` sink (every row
computed, nothing collected).  ``als_evaluate`` is the reference's headline
operation: fit one implicit ALS model and score its top-500 lists for the
validation users with precision@10/500, MAP and nDCG@500.

``BENCH_EVENT_LOG=<dir>`` writes Spark's event log there (stage and task
times without the UI).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "scan_interactions", "split_audit", "index_all_splits", "ordered_label_list",
    "subsample_train", "count_transform_stats", "metric_map", "variant_compare",
    "error_by_group", "mips_bruteforce", "als_evaluate",
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    from reclab.plans.registry import load_all
    from reclab.session import build_session

    log_dir = os.environ.get("BENCH_EVENT_LOG")  # stage/task times, read offline
    extra = {"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")}
    if log_dir:
        os.makedirs(log_dir, exist_ok=True)
        extra |= {"spark.eventLog.enabled": "true",
                  "spark.eventLog.dir": f"file://{os.path.abspath(log_dir)}"}
    spark = build_session(f"local[{cpus}]", int(cpus), extra=extra)
    queries, _ = load_all()
    # warm the JVM (class loading, codegen caches) on a trivial job
    spark.range(1000).selectExpr("sum(id)").collect()
    times = {}
    for name in names:
        t0 = time.time()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
        print(f"{name}: {times[name]}s", file=sys.stderr)
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "total_headline_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
