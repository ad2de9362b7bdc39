"""Time every registered query and print one JSON line.

BENCH_SF_DIR  data folder (default /root/testdata/sf0.1)
BENCH_CPUS    cores (default 8)
BENCH_RUNS    timed runs per query after one warm-up; the median counts (default 1)
BENCH_ONLY    comma-separated query names (default all)

Each run builds the query anew and computes all its rows without keeping them.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from incidentia.plans.queries import QUERIES
from incidentia.session import local_session


def timed(query, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    only = [n for n in os.environ.get("BENCH_ONLY", "").split(",") if n] or list(QUERIES)

    spark = local_session(cores, "incidentia-bench")
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in only:
        timed(QUERIES[name], spark, sf_dir)
        seconds[name] = round(
            statistics.median(timed(QUERIES[name], spark, sf_dir) for _ in range(runs)), 3
        )
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cores": cores,
            }
        )
    )


if __name__ == "__main__":
    main()
