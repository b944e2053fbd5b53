"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS (default 8) the local cores. All
queries run once to warm up the JVM and are then timed in three rounds; the median counts. Rows go to the ``noop``
sink, so nothing is collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tillstar.plans.queries import QUERIES  # noqa: E402
from tillstar.session import local_session  # noqa: E402

HEADLINE = [
    "r1_top_products", "r2_store_growth", "r3_supplier_contribution", "r4_seasonal_sales", "r5_monthly_volatility",
    "r6_product_affinity", "r7_yearly_rollup", "r8_half_year_split", "r9_sales_spikes", "r10_store_quarterly",
    "j1_enrich", "j3_rejects", "g1_keep_last", "g2_dimension", "k1_unique", "k6_conflicts", "m1_stream_enrich",
    "o2_loaded_top_products", "x8_set", "x13_patch",
]


def run(spark, folder: str, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, app="bench")
    names = sys.argv[1:] or HEADLINE
    for name in names:
        run(spark, folder, name)
    rounds = [{name: run(spark, folder, name) for name in names} for _ in range(3)]
    times = {name: round(statistics.median(r[name] for r in rounds), 3) for name in names}
    print(json.dumps({
        "metric": "total time of headline queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
