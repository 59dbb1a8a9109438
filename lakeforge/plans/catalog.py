"""Named result sets: every registered query of the package, by key.

Each entry is ``(ctx) -> DataFrame``. Most keys are models of the pipeline;
the rest are reports built on them (quality, profiling, reconciliation).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from . import core, marts, silver, staging  # noqa: F401  (register models)
from .registry import Context

CATALOG: dict[str, Callable[[Context], DataFrame]] = {}


def entry(key: str):
    def deco(fn):
        CATALOG[key] = fn
        return fn
    return deco


def _alias(key: str, model_name: str) -> None:
    CATALOG[key] = lambda ctx, _m=model_name: ctx.ref(_m)


# models exposed under their own name
for _name in [
    "dedupe_customers", "dedupe_products", "dedupe_stores", "dedupe_orders",
    "dedupe_order_items", "dedupe_payments",
    "orders_mandatory", "clean_customers", "silver_products", "silver_stores",
    "silver_payments",
    "stg_customers", "stg_products", "stg_stores", "stg_orders", "stg_order_items",
    "stg_payments",
    "dim_customer", "dim_product", "dim_store", "dim_date",
    "latest_orders", "latest_order_items", "fact_sales",
    "gold_sales_analytics", "gold_customer_analytics", "gold_product_analytics",
    "top_products_by_revenue",
]:
    _alias(_name, _name)

# models exposed under the inventory's names
_alias("orders_fx", "silver_orders")
_alias("customers_valid", "silver_customers")
_alias("customers_rejected", "reject_customers")
_alias("customers_null_email", "unknown_customers")
_alias("clean_products", "silver_products")
_alias("clean_stores", "silver_stores")
_alias("clean_payments", "silver_payments")


from . import reports, zones  # noqa: E402,F401  (register the report entries)
