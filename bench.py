"""Benchmark: build the lake (bronze -> silver -> gold) and run the headline queries.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Prints one JSON line: {"metric", "value", "unit", "queries": {name: sec}, "sf"}.
Each query is executed in full with the no-op sink (nothing is collected).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "vw_distance_km_results", "vw_distance_mi_results", "vw_time_hour_results",
    "vw_global_leaderboard", "vw_seasonal_race_trends", "vw_runner_demographics",
    "vw_country_seasonal_trends", "demographics_full", "vw_km_business", "star_left_preview",
    "rejection_counts", "dq_null_key_audit", "dq_dim_uniqueness", "dq_missing_athlete_keys",
    "duplicate_column_diff", "profile_distinct_counts", "numeric_summary", "top_speeds",
    "stream_silver_obt",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from racelake.plans.lakehouse import lakehouse
    from racelake.queries import REGISTRY
    from racelake.session import get_session

    spark = get_session(f"local[{cpus}]", shuffle_partitions=cpus * 2, app_name="racelake-bench")
    timings: dict[str, float] = {}

    lake = lakehouse(spark, sf_dir)
    for layer in ("bronze_results", "bronze_country_codes", "silver_obt", "silver_accounting",
                  "fact_results", "dim_event", "dim_athlete", "dim_country", "dim_date"):
        t0 = time.perf_counter()
        lake.table(layer)
        timings[f"build_{layer}"] = round(time.perf_counter() - t0, 3)

    for name in HEADLINE:
        t0 = time.perf_counter()
        REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - t0, 3)

    match = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "lake_build_plus_headline_queries",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(match.group(1)) if match else sf_dir,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
