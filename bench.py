"""Benchmark: headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS].

Prints one JSON line:
{"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Each query is run once to warm up, then timed ``BENCH_REPEAT`` times
(median kept).  Execution is forced with the ``noop`` sink, so the
whole plan runs and nothing is collected to the driver.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "group_progress", "group_stats", "has_errors", "attributes_long", "filter_records", "hoist_keys",
    "sort_by_attribute", "page_records", "rank_records", "navigate_all", "navigate_target", "visible_groups",
    "review_gate", "reconcile_read", "clean_records", "apply_edits", "export_wide", "export_manifest",
    "history_long", "white_share_luma", "extract_attributes", "pending_uploads", "status_edits", "table_view",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    from palimpsest.session import get_spark
    from palimpsest.plans import REGISTRY

    spark = get_spark(f"local[{cpus}]", shuffle_partitions=max(cpus, 8),
                      extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    times: dict[str, float] = {}
    for name in (only or HEADLINE):
        q = REGISTRY[name]

        def run():
            t0 = time.perf_counter()
            q.build(spark, sf_dir).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - t0

        run()
        times[name] = round(statistics.median(run() for _ in range(repeat)), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
