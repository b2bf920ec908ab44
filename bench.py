"""Benchmark: every registered query on the whole tables of one scale factor.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS
(default 8), BENCH_RUNS (default 3), BENCH_QUERIES (comma list, default all).
Each query is fully materialised with the ``noop`` sink (all rows computed,
nothing collected to the driver); the per-query number is the median of the
runs after one warm-up run of the whole set.  Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from eventide.plans.catalog import QUERIES  # noqa: E402
from eventide.session import get_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or list(QUERIES)
    spark = get_session(f"local[{cpus}]", app="eventide-bench", shuffle_partitions=cpus,
                        conf={"spark.driver.memory": "16g"})

    def run(name: str) -> float:
        t = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t

    for n in names:  # warm-up: JIT, file listing, Python workers
        run(n)
    times = {n: round(statistics.median(run(n) for _ in range(runs)), 4) for n in names}
    sf = os.path.basename(sf_dir).removeprefix("sf")
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 4),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "runs": runs,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
