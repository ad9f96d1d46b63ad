"""Time the headline queries: one JSON line on stdout.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the data, BENCH_CPUS (default 8) the local cores. Every query
runs once to warm the JVM up and is then timed, from building the plan to the last row (``noop`` sink).
"""

from __future__ import annotations

import json
import os
import sys
import time

from skyweave.queries import QUERIES
from skyweave.queries.source_queries import STORE_TTL, store_on_disk
from skyweave.session import local_session
from skyweave.sources import store_files

HEADLINE = [
    "flagship_composite",
    "a1_max_mosaic",
    "a2_average_mosaic",
    "a3_priority_mosaic",
    "a4_weighted_mosaic",
    "a9_marginal_cells",
    "a12_coverage_or",
    "a13_outages",
    "a18_availability_profile",
    "j1_tolerance_match",
    "j5_grid_map_lookup",
    "j5_tile_map_lookup",
    "j6_grid_map",
    "j7_nearest_reprojection",
    "j9_bilinear",
    "j10_not_yet_stored",
    "j16_colour_lookup",
    "s7_srd_text",
    "s16_store_upsert",
    "s17_store_lookup",
    "w3_longest_gaps",
    "w5_failure_streaks",
    "w6_isolation_filter",
    "r7_resample",
    "plan_fetch",
    "plan_composite_latest",
    "plan_backload",
]


def disk_lookup(spark, sf_dir: str) -> float:
    """Twenty keys looked up in the store on disk; the plan is made before the clock starts."""
    folder, now = store_on_disk(spark, sf_dir)
    rows = store_files.read(spark, folder).orderBy("source", "timestamp", "product").limit(20).collect()
    found = store_files.lookup(spark, folder, [(r.source, r.product, r.timestamp) for r in rows], now, STORE_TTL)
    found.collect()
    begin = time.perf_counter()
    found.collect()
    return time.perf_counter() - begin


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, partitions=max(int(cpus), 1) if cpus.isdigit() else 8, app="bench")
    run = lambda name: QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINE:
        run(name)
        begin = time.perf_counter()
        run(name)
        seconds[name] = round(time.perf_counter() - begin, 3)
    seconds["s17_disk_lookup"] = round(disk_lookup(spark, sf_dir), 3)
    line = {
        "metric": "headline queries, total time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": cpus,
    }
    print(json.dumps(line))
    sys.stdout.flush()


if __name__ == "__main__":
    main()
