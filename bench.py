"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the data, ``BENCH_CPUS`` the local cores, ``BENCH_RUNS`` the timed runs
after one warm-up (median is reported), ``BENCH_QUERIES`` a list of other queries.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from opsloom.catalog import QUERIES
from opsloom.session import local_session

HEADLINE = (
    "demand_summary",
    "arrival_target",
    "occupancy_target",
    "wait_features",
    "no_show_features",
    "point_in_time_history",
    "arrival_features",
    "quarantine_split",
    "reference_cascade",
    "temporal_split",
    "waiting_baseline_report",
    "arrival_baseline_report",
    "baseline_report",
    "regression_metrics",
    "classification_metrics",
    "feature_drift",
    "monitoring_checks",
    "reminder_policy",
    "flow_summary",
    "recursive_forecast",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = os.environ.get("BENCH_QUERIES", " ".join(HEADLINE)).split()
    spark = local_session(cpus, app="opsloom-bench")
    seconds: dict[str, float] = {}
    for name in names:
        times = []
        for run in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            if run:
                times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times), 3)
    print(
        json.dumps({
            "metric": "headline_queries_total",
            "value": round(sum(seconds.values()), 3),
            "unit": "sec",
            "queries": seconds,
            "sf": os.path.basename(sf_dir.rstrip("/")),
        })
    )
    spark.stop()


if __name__ == "__main__":
    main()
