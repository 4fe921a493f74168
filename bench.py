"""Time the registered queries and print one JSON line.

    BENCH_SF_DIR  tables to read        (default /root/testdata/sf0.1)
    BENCH_CPUS    local[N] executors    (default 8)
    BENCH_REPS    runs per query        (default 3; the median is reported)
    BENCH_QUERIES comma-separated subset (default: all registered queries)

Each run executes the whole plan into Spark's ``noop`` sink, so every row
is computed and nothing is collected to the driver.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from martkit.session import build_session  # noqa: E402
from martkit.plans.queries import REGISTRY  # noqa: E402


def run_once(spark, fn, sf_dir: str) -> float:
    t0 = time.perf_counter()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    reps = int(os.environ.get("BENCH_REPS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    names = only or sorted(REGISTRY)
    spark = build_session(f"local[{cpus}]", extra={"spark.driver.memory": "16g"})
    # Warm the JVM (class loading, codegen of scans, joins and aggregates)
    # outside the timings.
    for warm in ("distinct_pairs", "best_row"):
        run_once(spark, REGISTRY[warm], sf_dir)
    per_query = {}
    for n in names:
        times = [run_once(spark, REGISTRY[n], sf_dir) for _ in range(reps)]
        per_query[n] = round(statistics.median(times), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "sum_of_median_query_seconds", "value": round(sum(per_query.values()), 3),
                      "unit": "sec", "queries": per_query, "sf": sf, "cpus": cpus, "reps": reps}))
    spark.stop()


if __name__ == "__main__":
    main()
