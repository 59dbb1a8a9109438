"""Gold marts: daily, customer and product aggregates of the sales fact."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.money import avg_money, sum_int, sum_money
from .registry import Context, model


def _by(ctx: Context, key: str) -> DataFrame:
    """The fact with the first item of each order within ``key`` marked, to count its orders.

    Rows lie by order after the fact's join, so this sorts them where they are. A distinct
    count would hold every pair of order and key in memory, in two hash maps of a task.
    """
    of_order = Window.partitionBy("order_id", key).orderBy("order_item_id")
    first = (F.row_number().over(of_order) == 1) & F.col("order_id").isNotNull()
    return ctx.ref("fact_sales").withColumn("__first", F.when(first, 1))


def _measures(prefix_items: str) -> list:
    return [
        F.count("__first").alias("total_orders"),
        sum_int("quantity").alias(prefix_items),
    ]


@model("gold_sales_analytics", "marts")
def gold_sales_analytics(ctx: Context) -> DataFrame:
    """Per day: distinct orders, items, revenue, profit, average line value.

    One hash aggregate with a partial (map-side) step, so a day holding a large
    share of the rows is reduced before any shuffle. Readers order by ``date_key``.
    """
    return _by(ctx, "date_key").groupBy("date_key").agg(
        *_measures("total_items_sold"),
        sum_money("line_total").alias("total_revenue"),
        sum_money("profit").alias("total_profit"),
        avg_money("line_total").alias("average_line_item_value"))


@model("gold_customer_analytics", "marts")
def gold_customer_analytics(ctx: Context) -> DataFrame:
    """Per customer, with seven descriptive columns of the dimension.

    Aggregated on the key first, then joined to the (key-unique) dimension:
    the wide descriptive columns never travel through the aggregation shuffle.
    """
    agg = _by(ctx, "customer_key").groupBy("customer_key").agg(
        *_measures("total_items_purchased"),
        sum_money("line_total").alias("total_spent"),
        sum_money("profit").alias("total_profit"),
        avg_money("line_total").alias("average_line_item_value"),
        F.max("date_key").alias("last_order_date"))
    dim = ctx.ref("dim_customer").select(
        "customer_key", "customer_id", "first_name", "last_name", "city", "state", "country")
    return agg.join(dim, "customer_key").select(
        "customer_key", "customer_id", "first_name", "last_name", "city", "state", "country",
        "total_orders", "total_items_purchased", "total_spent", "total_profit",
        "average_line_item_value", "last_order_date")


@model("gold_product_analytics", "marts")
def gold_product_analytics(ctx: Context) -> DataFrame:
    """Per product; readers order by ``total_revenue desc``."""
    agg = _by(ctx, "product_key").groupBy("product_key").agg(
        *_measures("units_sold"),
        sum_money("line_total").alias("total_revenue"),
        sum_money("profit").alias("total_profit"),
        avg_money("line_total").alias("average_sale_value"))
    dim = ctx.ref("dim_product").select(
        "product_key", "product_id", "product_name", "category", "sub_category")
    return agg.join(dim, "product_key").select(
        "product_key", "product_id", "product_name", "category", "sub_category",
        "total_orders", "units_sold", "total_revenue", "total_profit", "average_sale_value")


def top_products_by_revenue(ctx: Context, n: int = 10) -> DataFrame:
    """The ``n`` products with the highest revenue (a top-k report).

    ``orderBy(..).limit(n)`` plans as TakeOrderedAndProject: each task keeps
    its own top n, so only n rows per task reach the final merge.
    """
    return (ctx.ref("gold_product_analytics")
            .orderBy(F.col("total_revenue").desc(), F.col("product_key").asc())
            .limit(n))


model("top_products_by_revenue", "marts")(top_products_by_revenue)
