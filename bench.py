"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the tables (default sf0.1), ``BENCH_CPUS`` the local cores.
Every query runs over whole tables into a sink that discards its rows.
"""

from __future__ import annotations

import json
import os
import sys
import time

from curbline.plans.queries import all_queries
from curbline.session import build_session

HEADLINE = [
    "flow_matrix",
    "clean_trips_yellow",
    "clean_trips_fhv",
    "add_row_key",
    "dedup_by_key",
    "distinct_on",
    "union_services",
    "payment_summary",
    "rate_code_summary",
    "vendor_summary",
    "monthly_service_counts",
    "daily_summary",
    "pickup_zone_summary",
    "dropoff_zone_summary",
    "flow_pivot",
    "time_dimension",
    "upsert_month",
    "merge_by_key",
    "reconcile_coalesce",
    "salted_full_join",
    "check_ranges",
    "month_roundtrip",
    "job_ingest_dev",
    "job_load_stage",
    "job_build_fact",
    "job_build_summaries",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = build_session("bench", os.environ.get("BENCH_CPUS", "8"))
    queries = all_queries()

    def run(name: str) -> float:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        # The first run compiles the query's code and is not counted.
        run(name)
        seconds[name] = run(name)
        print(f"{seconds[name]:8.3f} {name}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline queries, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").split("sf")[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
