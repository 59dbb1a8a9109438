"""Command line: build models from a bronze zone and write them as parquet.

    spark-submit -m lakeforge --bronze s3://lake/bronze \\
        --fx s3://lake/raw/currency/batch_date=2026-07-01 --out s3://lake/gold \\
        --models fact_sales gold_sales_analytics expectation_report

Every requested key of the catalog is written to ``<out>/<key>``; models are
memoised within the run, so shared upstream models are planned once per key.
"""

from __future__ import annotations

import argparse

from .plans.catalog import CATALOG
from .plans.registry import materialize, parquet_context
from .session import build_session, cluster_conf

# core tables written first, so later keys start from the written files
MATERIALIZE_FIRST = ["dim_customer", "dim_product", "dim_store", "dim_date", "fact_sales"]


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="lakeforge")
    ap.add_argument("--bronze", required=True, help="bronze root: <root>/<table>/batch_date=*/")
    ap.add_argument("--fx", required=True, help="landed FX CSV folder of the batch")
    ap.add_argument("--out", required=True, help="output root")
    ap.add_argument("--models", nargs="+", default=["gold_sales_analytics",
                                                    "gold_customer_analytics",
                                                    "gold_product_analytics",
                                                    "expectation_report"])
    ap.add_argument("--master", default=None)
    ap.add_argument("--input-gb", type=float, help="size of the bronze zone: sizes shuffles and splits for it")
    ap.add_argument("--cores", type=int, default=64, help="executor cores of the cluster, with --input-gb")
    args = ap.parse_args(argv)

    extra = cluster_conf(int(args.input_gb * (1 << 30)), args.cores) if args.input_gb else None
    spark = build_session(args.master, extra=extra)
    ctx = parquet_context(spark, args.bronze, args.fx)
    unknown = [m for m in args.models if m not in CATALOG]
    if unknown:
        raise SystemExit(f"unknown keys: {unknown}")
    for m in MATERIALIZE_FIRST:
        materialize(ctx, m, f"{args.out.rstrip('/')}/{m}")
    for m in args.models:
        if m in MATERIALIZE_FIRST:
            continue
        CATALOG[m](ctx).write.mode("overwrite").parquet(f"{args.out.rstrip('/')}/{m}")


if __name__ == "__main__":
    main()
