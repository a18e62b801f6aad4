"""Benchmark: wall time of every registered query.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is executed in full into Spark's ``noop`` sink (nothing is
collected to the driver).  Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from thermoflux.plans import QUERIES  # noqa: E402
from thermoflux.session import get_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    reps = int(os.environ.get("BENCH_REPS", "2"))   # best of N after the warm-up pass
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(QUERIES)
    spark = get_session(master=f"local[{cpus}]", shuffle_partitions=max(cpus, 1))
    # Warm the JVM (class loading, JIT, codegen caches) outside the timed region by
    # running every query once on the smallest fixture; BENCH_WARMUP=0 times cold runs.
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", os.path.join(os.path.dirname(os.path.normpath(sf_dir)), "sf0.001"))
    warm = os.environ.get("BENCH_WARMUP", "1") != "0" and os.path.isdir(warm_dir)
    if warm:
        for name in names:
            QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    for name in names:
        best = float("inf")
        for _ in range(reps):
            t0 = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - t0)
        times[name] = round(best, 3)
    sf = os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf")
    print(json.dumps({"metric": "total_query_wall_time", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": cpus,
                      "warmup": os.path.basename(warm_dir) if warm else None, "best_of": reps}))
    spark.stop()


if __name__ == "__main__":
    main()
