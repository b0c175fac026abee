"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]
and print one JSON line {"metric", "value", "unit", "queries", "sf"}.

Each query is materialised with a no-op write (the whole result is computed,
nothing is collected); the first run of each query is a warm-up and the
reported time is the best of the timed runs."""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from netquery.plans.registry import load_all  # noqa: E402
from netquery.session import build_session  # noqa: E402

HEADLINE = [
    "server_replay", "asof_join", "fanout", "concurrency", "rate_limit", "rate_limit_interval", "admin_state",
    "parse_telemetry", "tick_gaps", "binary_metrics", "roc_auc", "pr_curve", "leaderboard",
    "box_stats", "histogram", "stratified_folds", "densify", "jain_mean", "path_delay",
    "one_hot_long", "scale_no_mean", "resolve_mail", "stream_tick_windows", "stream_sessions",
    "model_gaussian_nb",
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = os.environ.get("BENCH_QUERIES")
    names = names.split(",") if names else HEADLINE
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(8, 2 * cpus))
    q, _ = load_all()
    times = {}
    for name in names:
        best = None
        for i in range(runs + 1):
            t = time.perf_counter()
            q[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t
            if i > 0:
                best = dt if best is None else min(best, dt)
        times[name] = round(best, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": float(m.group(1)) if m else sf_dir}
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
