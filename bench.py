"""Time the headline queries and print one JSON line.

Each query runs once to warm up and then `BENCH_RUNS` times; the best time counts. The
result is consumed by Spark's `noop` sink, so all rows are computed and none collected.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from contract import QUERIES  # noqa: E402
from sensorweave.session import local_session  # noqa: E402

HEADLINE = [
    "quality_code_counts",
    "quality_codes",
    "gap_flags",
    "delta_summary",
    "dedupe_latest",
    "sequence_anomalies",
    "collapse_last",
    "grid_reindex",
    "impute_run_limited",
    "impute_limit_both",
    "null_runs",
    "pivot_wide",
    "window_features",
    "rolling_features",
    "engineered_features",
    "item_spread",
    "percentiles",
    "histogram",
    "deployment_range_join",
    "ordered_split",
    "roc_points",
    "flow_standard",
    "flow_rounded",
    "flow_resampled",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cores, app="bench")
    seconds = {}
    for name in names:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(min(times[1:]), 3)
        print(f"{name}: {seconds[name]} (first {times[0]:.2f})", file=sys.stderr, flush=True)
    total = round(sum(seconds.values()), 3)
    scale = Path(folder).name.removeprefix("sf")
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": seconds, "sf": float(scale)}))
    spark.stop()


if __name__ == "__main__":
    main()
