"""Core star schema: customer, product, store and date dimensions, sales fact."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import calendar_columns
from ..functions.money import money
from ..operators.joins import orphans
from ..operators.latest import latest_by_key
from .registry import Context, model


@model("dim_customer", "core")
def dim_customer(ctx: Context) -> DataFrame:
    """Newest version of each customer by ``updated_at``; natural id is the key."""
    latest = latest_by_key(ctx.ref("versions_customers"), "customer_id", ["updated_at"],
                           ["ingestion_timestamp", "load_date"])
    return latest.select(
        F.col("customer_id").alias("customer_key"), "customer_id", "first_name", "last_name",
        "email", "phone", "address", "city", "state", "country", "signup_date", "is_active",
        "created_at", "updated_at", "batch_date")


@model("dim_product", "core")
def dim_product(ctx: Context) -> DataFrame:
    latest = latest_by_key(ctx.ref("versions_products"), "product_id", ["updated_at"],
                           ["ingestion_timestamp", "load_date"])
    return latest.select(
        F.col("product_id").alias("product_key"), "product_id", "product_name", "category",
        "sub_category", "unit_price", "unit_cost", "is_active", "created_at", "updated_at",
        "batch_date")


@model("dim_store", "core")
def dim_store(ctx: Context) -> DataFrame:
    latest = latest_by_key(ctx.ref("versions_stores"), "store_id", ["created_at"],
                           ["ingestion_timestamp", "load_date"])
    return latest.select(
        F.col("store_id").alias("store_key"), "store_id", "store_name", "store_type",
        "store_size", "region", "country", "opened_date", "created_at", "batch_date")


@model("dim_date", "core")
def dim_date(ctx: Context) -> DataFrame:
    """One row per day that has an order (sparse calendar).

    The days need no exchange rates, and of an order's versions each once. Distinct is taken on the date first (a partial aggregate before the
    shuffle), then the calendar attributes are derived from the few survivors.
    """
    days = ctx.ref("versions_order_heads").select(F.col("order_date").cast("date").alias("__d")).distinct()
    return days.select(*calendar_columns("__d"))


def latest_load(staging: DataFrame, key: str, tie_breakers: tuple[str, ...] = ()) -> DataFrame:
    """Newest version of each key by ``batch_date``; equal ones by ingestion, then by load."""
    return latest_by_key(staging, key, ["batch_date"],
                         ["ingestion_timestamp", "load_date", *tie_breakers])


@model("latest_orders", "core")
def latest_orders(ctx: Context) -> DataFrame:
    return latest_load(ctx.ref("versions_orders"), "order_id")


@model("latest_order_heads", "core")
def latest_order_heads(ctx: Context) -> DataFrame:
    """``latest_orders`` without the exchange rate, for what needs no FX join."""
    return latest_load(ctx.ref("versions_order_heads"), "order_id")


@model("latest_order_items", "core")
def latest_order_items(ctx: Context) -> DataFrame:
    return latest_load(ctx.ref("versions_order_items"), "order_item_id", ("product_id",))


@model("fact_orders", "core")
def fact_orders(ctx: Context) -> DataFrame:
    """The fact's side of orders: heads that have a customer and a store, with their keys.

    Dimensions contribute only their keys, so column pruning leaves them narrow.
    """
    o = (ctx.ref("latest_order_heads")
         .select("order_id", "customer_id", "store_id", "order_date", "order_status",
                 "currency_code"))
    c = ctx.ref("dim_customer").select("customer_key")
    s = ctx.ref("dim_store").select("store_key")
    return (o.join(c, o.customer_id == c.customer_key).join(s, o.store_id == s.store_key)
            .select("order_id", "customer_key", "store_key", "order_date", "order_status", "currency_code"))


@model("unknown_products", "core")
def unknown_products(ctx: Context) -> DataFrame:
    """Products that items name and the dimension doesn't hold, each once."""
    named = ctx.ref("latest_order_items").select("product_id").distinct()
    return orphans(named, "product_id", ctx.ref("dim_product"), "product_key")


def sales_fact(ctx: Context, orders: DataFrame, with_products: Callable[[DataFrame], DataFrame],
               orders_first: bool = False) -> DataFrame:
    """Items that meet ``orders`` and pass ``with_products``, which adds their product's key."""
    i = ctx.ref("latest_order_items").select(
        "order_item_id", "order_id", "product_id", "quantity", "unit_price_at_sale",
        "unit_cost_at_sale", "discount_amount", "line_total", "batch_date")
    f = with_products(i.join(orders, "order_id")) if orders_first else with_products(i).join(orders, "order_id")
    return f.select(
        "order_item_id", "order_id", "customer_key", "product_key", "store_key",
        F.col("order_date").cast("date").alias("date_key"),
        "quantity",
        F.col("unit_price_at_sale").alias("unit_price"),
        F.col("unit_cost_at_sale").alias("unit_cost"),
        "discount_amount", "line_total",
        money(F.col("line_total") - F.col("quantity") * F.col("unit_cost_at_sale")).alias("profit"),
        "order_status", "currency_code", "batch_date")


def joined_products(products: DataFrame) -> Callable[[DataFrame], DataFrame]:
    p = products.select("product_key")
    return lambda df: df.join(p, df.product_id == p.product_key)


@model("fact_sales", "core")
def fact_sales(ctx: Context) -> DataFrame:
    """Sales fact at order-item grain (inner star join, as the warehouse model).

    Join order: orders meet their two dimensions first (orders are the smaller
    side), items meet the product dimension, then the two meet on order_id.
    Dimensions contribute only their keys, so column pruning leaves them
    narrow; AQE turns their joins into broadcasts when runtime sizes allow and
    splits a hot customer/product key otherwise. Where items and orders are tables
    bucketed by order (``plans.tables``), those two meet first, without a shuffle; the
    products that the dimension lacks are a table there, so items are shuffled by product
    only if that one is large.
    """
    if not ctx.opt("bucketed"):
        return sales_fact(ctx, ctx.ref("fact_orders"), joined_products(ctx.ref("dim_product")))
    unknown = ctx.ref("unknown_products").select(F.col("product_id").alias("__unknown"))

    def known_products(df: DataFrame) -> DataFrame:
        # an anti join would be pushed below the join with orders, and shuffle items for that one too
        return (df.where(F.col("product_id").isNotNull())
                .join(unknown, F.col("product_id") == F.col("__unknown"), "left").where(F.col("__unknown").isNull())
                .withColumn("product_key", F.col("product_id")))

    return sales_fact(ctx, ctx.ref("fact_orders"), known_products, orders_first=True)


def fact_orphans(ctx: Context, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """``orphans`` of the sales fact: the key comes from one side of its join, so that side is
    checked before the join and the others meet only what is left of it. A fact that the
    context holds already (a written one) is checked as it is."""
    if "fact_sales" in ctx._cache or key not in ("customer_key", "store_key", "product_key"):
        return orphans(ctx.ref("fact_sales"), key, parent, parent_key)
    orders, products = ctx.ref("fact_orders"), ctx.ref("dim_product")
    if key == "product_key":
        return sales_fact(ctx, orders, joined_products(orphans(products, key, parent, parent_key)))
    return sales_fact(ctx, orphans(orders, key, parent, parent_key), joined_products(products), orders_first=True)
