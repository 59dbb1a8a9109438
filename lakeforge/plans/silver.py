"""Silver layer: latest-by-key, cleansing, quarantine, FX enrichment."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions import cleanse as C
from ..operators.enrich import enrich_fx
from ..operators.latest import latest_by_key, latest_by_load
from ..operators.quarantine import drop_missing, split_valid
from ..schemas import SPECS
from ..sources.fx import fx_rates_typed
from .registry import Context, model

INVALID_EMAIL = "Invalid Email"


def dedupe(ctx: Context, table: str) -> DataFrame:
    """Newest row per key; over several loads, the newest as of each."""
    spec = SPECS[table]
    loads = ctx.opt("over_loads")
    if loads:
        return latest_by_load(ctx.source(table), spec.key, list(spec.order_by), list(spec.tie_breakers),
                              "batch_date", loads, hot_keys=bool(ctx.opt("hot_keys", False)))
    return latest_by_key(ctx.source(table), spec.key, list(spec.order_by), list(spec.tie_breakers))


@model("dedupe_orders", "silver")
def dedupe_orders(ctx: Context) -> DataFrame:
    return dedupe(ctx, "orders")


@model("orders_mandatory", "silver")
def orders_mandatory(ctx: Context) -> DataFrame:
    """Deduplicated orders without a NULL in any mandatory column."""
    return drop_missing(ctx.ref("dedupe_orders"), SPECS["orders"].mandatory)


@model("fx_rates_typed", "silver")
def fx_rates(ctx: Context) -> DataFrame:
    return fx_rates_typed(ctx.source("fx_rates"))


@model("silver_orders", "silver")
def silver_orders(ctx: Context) -> DataFrame:
    """Orders with the exchange rate of their currency (NULL when unknown)."""
    return enrich_fx(ctx.ref("orders_mandatory"), ctx.ref("fx_rates_typed"))


@model("dedupe_customers", "silver")
def dedupe_customers(ctx: Context) -> DataFrame:
    return dedupe(ctx, "customers")


@model("clean_customers", "silver")
def clean_customers(ctx: Context) -> DataFrame:
    return ctx.ref("dedupe_customers").withColumns({
        "first_name": C.clean_name("first_name"),
        "last_name": C.clean_name("last_name"),
        "state": C.canonical_state("state"),
        "country": C.clean_name("country"),
        "phone": C.clean_phone("phone"),
    })


def _customer_split(ctx: Context):
    return split_valid(ctx.ref("clean_customers"), C.email_is_valid("email"), INVALID_EMAIL,
                       null_as_reject=bool(ctx.opt("null_email_as_reject", False)))


@model("silver_customers", "silver")
def silver_customers(ctx: Context) -> DataFrame:
    return _customer_split(ctx).valid


@model("reject_customers", "silver")
def reject_customers(ctx: Context) -> DataFrame:
    return _customer_split(ctx).rejected


@model("unknown_customers", "silver")
def unknown_customers(ctx: Context) -> DataFrame:
    """Customers whose e-mail is NULL: neither valid nor rejected by the rule."""
    return _customer_split(ctx).unknown


@model("dedupe_products", "silver")
def dedupe_products(ctx: Context) -> DataFrame:
    return dedupe(ctx, "products")


@model("silver_products", "silver")
def silver_products(ctx: Context) -> DataFrame:
    return ctx.ref("dedupe_products").withColumns({
        "product_name": C.clean_name("product_name"),
        "category": C.clean_name("category"),
    })


@model("dedupe_stores", "silver")
def dedupe_stores(ctx: Context) -> DataFrame:
    return dedupe(ctx, "stores")


@model("silver_stores", "silver")
def silver_stores(ctx: Context) -> DataFrame:
    return ctx.ref("dedupe_stores").withColumns({
        "store_name": C.clean_name("store_name"),
        "region": C.clean_name("region"),
        "country": C.clean_name("country"),
    })


@model("dedupe_order_items", "silver")
def dedupe_order_items(ctx: Context) -> DataFrame:
    return dedupe(ctx, "order_items")


@model("silver_order_items", "silver")
def silver_order_items(ctx: Context) -> DataFrame:
    return ctx.ref("dedupe_order_items")


@model("dedupe_payments", "silver")
def dedupe_payments(ctx: Context) -> DataFrame:
    return dedupe(ctx, "payments")


@model("silver_payments", "silver")
def silver_payments(ctx: Context) -> DataFrame:
    return ctx.ref("dedupe_payments").withColumn(
        "payment_method", C.clean_payment_method("payment_method"))


SILVER_OUTPUTS = {
    "orders": "silver_orders",
    "customers": "silver_customers",
    "products": "silver_products",
    "stores": "silver_stores",
    "order_items": "silver_order_items",
    "payments": "silver_payments",
}
