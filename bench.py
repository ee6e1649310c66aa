"""Time the headline queries and print one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is run to completion with the ``noop`` sink (every row is
produced, nothing is collected to the driver).  One untimed warm-up pass
loads the JVM code paths; the reported time is the best of ``BENCH_REPS``
runs per query.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from seqlake.registry import QUERIES  # noqa: E402
from seqlake.session import build_session  # noqa: E402

HEADLINE = [
    "catalog_clean",
    "analysis_table",
    "read_pairs",
    "latest_assembly",
    "new_reads_latest",
    "latest_submission",
    "submission_tables",
    "retention_expand",
    "retention_infer",
    "transfer_pending",
    "transfer_batches",
    "wide_uris",
    "entity_pages",
    "normalize_ids",
    "resolve_headers",
    "sheet_valid",
    "sheet_errors",
    "sheet_valid_skewed",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    reps = int(os.environ.get("BENCH_REPS", "2"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(8, 2 * cpus), app_name="seqlake-bench",
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    # Warm-up on the smallest query set (not timed).
    QUERIES["latest_result"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        best = None
        for _ in range(reps):
            t0 = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        times[name] = round(best, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
