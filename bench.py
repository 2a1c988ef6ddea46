"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is run to completion with the ``noop`` sink (every row computed,
nothing collected), on its own: no plan or table is kept between queries.  The
time is the median of ``BENCH_RUNS`` runs (3); prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time
from statistics import median

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from shelfwise.plans.queries import QUERIES  # noqa: E402
from shelfwise.session import build_session  # noqa: E402

HEADLINE = [
    "silver_prices", "silver_inventory", "sku_dimension", "gold_features", "feature_mart",
    "price_flags", "score_compare", "target_summary", "table_profile",
    "stream_gold", "stream_bronze_silver_prices",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(master=f"local[{cpus}]", app="shelfwise-bench",
                          shuffle_partitions=max(8, 2 * int(cpus)))
    # warm the JVM (class loading, JIT) on the flagship query over the smallest
    # data set; it shares no plan or data with the timed runs below
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir) and os.path.abspath(warm_dir) != os.path.abspath(sf_dir):
        QUERIES["feature_mart"](spark, warm_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        runs = []
        for _ in range(int(os.environ.get("BENCH_RUNS", "3"))):
            t0 = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t0)
        times[name] = round(median(runs), 3)
    spark.stop()
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
