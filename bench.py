"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is fully executed with the ``noop`` sink (every row computed,
nothing collected to the driver).  ``silver_clean`` times the whole
dedup -> backfill -> clean flow; downstream queries read the silver and
scored-feature tables, which are materialised once per session the first
time a query needs them (that build is included in that query's time).
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

HEADLINE = [
    "dedup_icao_ts", "silver_backfill", "silver_clean", "gold_enrich", "star_join",
    "fact_flight_trace", "dim_aircraft", "bronze_flatten", "live_transform", "ml_feed",
    "unpack_state_array", "icao_range_join", "flight_features", "hybrid_label",
    "sequence_windows", "episode_grouping", "category_threshold", "val_daily_coverage",
    "phase_distribution_hist", "top_countries", "geo_grid_density", "active_aircraft_trend",
]


def main() -> None:
    sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
    base = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from aerotrace.plans.catalog import QUERIES
    from aerotrace.session import get_spark

    spark = get_spark(master=f"local[{cpus}]", shuffle_partitions=int(cpus) * 2,
                      app_name="aerotrace-bench", extra={"spark.driver.memory": "16g", "aerotrace.scan.partitions": cpus})
    # warm-up: JVM, codegen caches, file listing
    QUERIES["scan_table"](spark, base).write.format("noop").mode("overwrite").save()
    times = {}
    for name in HEADLINE:
        t0 = time.perf_counter()
        QUERIES[name](spark, base).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(base.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
