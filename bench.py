"""Benchmark the headline queries; prints one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (warm runs per query, default 3; the median is reported).
Each query is fully materialised with the ``noop`` sink (no collect to the
driver), after one untimed warm-up run.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = [
    "dedupe_order_items",
    "orders_fx",
    "customers_valid",
    "dim_customer",
    "dim_date",
    "fact_sales",
    "gold_sales_analytics",
    "gold_customer_analytics",
    "gold_product_analytics",
    "top_products_by_revenue",
    "expectation_report",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    from lakeforge.plans.catalog import CATALOG
    from lakeforge.plans.registry import fixture_context
    from lakeforge.session import build_session

    spark = build_session(f"local[{cpus}]", cpus,
                          extra={"spark.driver.memory": os.environ.get("BENCH_MEM", "16g")})
    keys = [k for k in HEADLINE if k in CATALOG]
    extra = os.environ.get("BENCH_QUERIES")
    if extra:
        keys = [k for k in extra.split(",") if k in CATALOG]
    times: dict[str, float] = {}
    for k in keys:
        samples = []
        for i in range(runs + 1):
            # timed from plan construction: eager work done while building
            # (size checks, shared models written once) is part of the query
            t0 = time.perf_counter()
            df = CATALOG[k](fixture_context(spark, sf_dir))
            df.write.format("noop").mode("overwrite").save()
            if i:
                samples.append(time.perf_counter() - t0)
        times[k] = round(statistics.median(samples), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "sum_median_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": cpus,
        "runs": runs,
        "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
