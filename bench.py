"""Time the headline queries: one JSON line on stdout.

BENCH_SF_DIR  folder with the sample tables (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)
"""

from __future__ import annotations

import json
import os
import sys
import time

from meterlake import queries as registered
from meterlake.session import local_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = [
    "scan_csv_readings",
    "clean_readings",
    "dedup_latest",
    "assign_keys",
    "dim_customer",
    "fact_consumption",
    "fact_demand",
    "feeder_grid",
    "fact_feeder",
    "fact_meter_events",
    "rate_readings",
    "rate_readings_asof",
    "fact_billing",
    "revenue_summary",
    "peak_load",
    "theft_detection",
    "weather_impact",
    "dq_failures",
    "dq_row_flags",
    "merge_upsert",
    "merge_insert_only",
    "backfill_conditional",
    "scd2_apply",
    "incremental_extract",
    "partitioned_write_read",
]


def run(spark, name: str, sf_dir: str = SF_DIR) -> float:
    """Build and fully evaluate one query; every row is produced, none is kept."""
    started = time.perf_counter()
    registered.queries()[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    names = sys.argv[1:] or HEADLINE
    spark = local_session(CPUS, "meterlake-bench")
    # Untimed pass over the smallest sample: loads classes and compiles code before the clock runs.
    small = os.path.join(os.path.dirname(SF_DIR.rstrip("/")), "sf0.001")
    for name in names if os.path.isdir(small) else []:
        run(spark, name, small)
    times = {name: round(run(spark, name), 3) for name in names}
    spark.stop()
    sf = os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf")
    report = {
        "metric": "total wall time of the headline queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
    }
    print(json.dumps(report))


if __name__ == "__main__":
    main()
