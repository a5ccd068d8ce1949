"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the number of local cores.
"""

from __future__ import annotations

import json
import os
import time

from skytally import registry
from skytally.session import local_session

HEADLINE = (
    "hourly_activity",
    "daily_activity",
    "ingestion_health",
    "suppressed_cells",
    "staged_profile",
    "grid_density",
    "hourly_totals",
    "altitude_profile",
    "daily_profile",
    "health_read",
    "flow_arrows",
    "density_bins",
    "cell_size",
    "altitude_share",
    "headline",
    "payload_status",
    "reject_reasons",
    "accepted_profile",
    "dry_run",
    "dedup_first_wins",
    "idempotent_insert",
    "load_accounting",
    "ledger_state",
    "attributed_rows",
    "orphan_rows",
    "dup_keys",
    "contract_report",
    "health_checks",
    "late_refresh",
    "reconcile_hourly",
    "stream_land",
    "stream_hourly",
    "stream_dedup",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus)
    spark.sparkContext.setLogLevel("ERROR")

    # Start the JVM's compilers and read the files once before the clock runs.
    registry.QUERIES["hourly_activity"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    seconds = {}
    for name in HEADLINE:
        begin = time.perf_counter()
        registry.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - begin, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
