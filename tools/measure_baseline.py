"""
(noop sink, warm, median of N) and its oracle SQL on DuckDB (same
parquet files, median of N) for scale only.

Usage: python tools/measure_baseline.py [sf_dir] [cpus] [repeat]
"""

from __future__ import annotations

import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    cpus = int(sys.argv[2]) if len(sys.argv) > 2 else 4
    repeat = int(sys.argv[3]) if len(sys.argv) > 3 else 3
    from palimpsest.session import get_spark
    from palimpsest.plans import REGISTRY
    spark = get_spark(f"local[{cpus}]", max(cpus, 8))
    con = duckdb.connect()
    con.execute(f"SET threads = {cpus}")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    print("| query | spark sec | duckdb sec |")
    print("| --- | --- | --- |")
    for name, q in REGISTRY.items():
        def run_spark():
            t0 = time.perf_counter()
            q.build(spark, sf).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - t0

        def run_duck():
            t0 = time.perf_counter()
            con.execute(q.sql).fetchall()
            return time.perf_counter() - t0
        run_spark()
        s = statistics.median(run_spark() for _ in range(repeat))
        d = ""
        if q.sql:
            run_duck()
            d = f"{statistics.median(run_duck() for _ in range(repeat)):.3f}"
        print(f"| {name} | {s:.3f} | {d} |", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
