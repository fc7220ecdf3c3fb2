"""Benchmark the headline queries.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (timed runs per query, default 3), BENCH_EVENT_LOG_DIR (optional: write
Spark's event log there for stage and task timings).  Every query is executed to the
end with the no-op sink (no result is pulled to the driver); one warm-up run,
then the median of the timed runs.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "q_cheapest_insurer", "q_billing_percentiles", "q_outlier_summary", "q_profile_completeness",
    "q_fact", "q_welch", "q_validate", "q_market_share", "q_cost_efficiency", "q_readmission",
    "q_monthly_trend", "q_describe", "q_profile_cardinality", "q_boxplot",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    from carelens.session import get_spark
    from carelens.plans.registry import REGISTRY

    extra = {"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "8g")}
    if os.environ.get("BENCH_EVENT_LOG_DIR"):
        extra.update({"spark.eventLog.enabled": "true", "spark.eventLog.dir": os.environ["BENCH_EVENT_LOG_DIR"]})
    spark = get_spark(f"local[{cpus}]", app="carelens-bench", shuffle_partitions=max(8, 2 * cpus), extra=extra)

    def run(name: str) -> float:
        t0 = time.perf_counter()
        REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    for name in HEADLINE:  # warm-up: JIT, file listing, metadata caches
        run(name)
    times = {name: round(statistics.median(run(name) for _ in range(runs)), 3) for name in HEADLINE}
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total_median_sec", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(sf) if sf else sf_dir,
                      "cpus": cpus, "runs": runs}))


if __name__ == "__main__":
    main()
