"""Bench: wall time of the headline queries on ``$BENCH_SF_DIR`` with ``local[$BENCH_CPUS]``.

Prints one JSON line: {"metric", "value" (sum of per-query medians), "unit", "queries", "sf", ...}.
Each query is run once to warm up, then ``$BENCH_REPEAT`` times (default 3); the median counts.
A run forces the whole result with a no-op write (every row and column is computed, nothing is collected).
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
    "stg_indicator_latest",
    "unwrap_pages",
    "stg_hourly_latest",
    "mart_hourly",
    "merge_indicator",
    "merge_hourly",
    "kpi_latest",
    "chart_feed",
    "reject_summary",
    "raw_roundtrip",
    "full_run",
    "upsert_existing",
    "stream_merge_hourly",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    names = os.environ.get("BENCH_QUERIES")
    names = names.split(",") if names else HEADLINE

    from rawmart.queries import QUERIES
    from rawmart.session import build_session

    spark = build_session(f"local[{cpus}]", shuffle_partitions=int(cpus) * 2, app="rawmart-bench")
    # JVM and code-generation warm-up, not counted
    QUERIES["mart_hourly"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    rows: dict[str, int] = {}
    for name in names:
        fn = QUERIES[name]
        samples = []
        for i in range(repeat + 1):
            t0 = time.perf_counter()
            df = fn(spark, sf_dir)
            df.write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            if i > 0:
                samples.append(dt)
        times[name] = round(statistics.median(samples), 3)
        rows[name] = fn(spark, sf_dir).count()
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "sum_of_median_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "rows": rows,
                "sf": float(m.group(1)) if m else sf_dir,
                "cpus": int(cpus),
                "repeat": repeat,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
