"""Bench: wall seconds per headline query at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query runs once to warm up (JIT, file listing, cached calendar), then
is timed on BENCH_REPEATS further full runs (collect of the whole result);
the median run is reported. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from uptake.plans.catalog import REGISTRY  # noqa: E402
from uptake.session import local_session  # noqa: E402

HEADLINE = [
    "weekly_insights", "wau_by_segment", "activation_by_wave", "feature_adoption_bu_role", "median_ttv_by_segment",
    "retention_cohorts", "training_vs_activation", "barrier_ranking", "time_saved_by_feature", "dormancy_by_segment",
    "mau_by_week", "stickiness_by_segment", "segment_scorecard", "dormancy_trend", "headline_kpis",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    keys = os.environ.get("BENCH_QUERIES")
    keys = keys.split(",") if keys else [k for k in HEADLINE if k in REGISTRY]
    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", cpus)))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    times = {}
    for k in keys:
        fn = REGISTRY[k][0]
        fn(spark, sf_dir).collect()
        runs = []
        for _ in range(repeats):
            t0 = time.perf_counter()
            fn(spark, sf_dir).collect()
            runs.append(time.perf_counter() - t0)
        times[k] = round(statistics.median(runs), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_wall_seconds_headline_queries", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
