"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the data, BENCH_CPUS the local cores,
BENCH_RUNS the timed runs per query after one warm-up (the median is reported).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from mercata.plans.catalog import QUERIES  # noqa: E402
from mercata.session import build_session  # noqa: E402

HEADLINE = (
    "scan_events_nested", "flatten_struct", "explode_items", "clean_ga4_events", "cleaning_log",
    "mart_sessions", "mart_orders", "mart_products", "enforce_constraints",
    "funnel_conversion", "channel_cac_roas", "cohort_retention", "customer_ltv",
    "pricing_analytics", "touchpoint_candidates", "touchpoint_order", "attribution_last_click",
    "attribution_linear", "attribution_time_decay", "channel_attribution",
    "attribution_comparison", "dq_report", "validation_status", "unverified_numbers",
    "ltv_describe", "ltv_histogram",
)


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus,
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "8g"),
        # Small local inputs: let post-shuffle partitions stay small enough for all cores.
        spark__sql__adaptive__coalescePartitions__minPartitionSize="64k",
        spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    timings = {}
    for name in names:
        taken = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        timings[name] = round(statistics.median(taken[1:]), 3)
    print(json.dumps({"metric": "headline queries, summed median", "unit": "sec",
                      "value": round(sum(timings.values()), 3), "queries": timings,
                      "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf"),
                      "cpus": int(cpus), "spark": spark.version}))
    spark.stop()


if __name__ == "__main__":
    main()
