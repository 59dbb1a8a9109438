"""Reports over the pipeline: quality, reconciliation, profiles, SCD1, FX feed,
watermark and source-zone operators. Each function is ``(ctx) -> DataFrame``
and is registered in the catalog under the inventory's key."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import cleanse as C
from ..functions.money import avg_money, money, sum_money
from ..operators.diff import diff_counts
from ..operators.enrich import convert_to_base, enrich_fx
from ..operators.joins import orphans
from ..operators.latest import apply_scd1
from ..operators.profile import bucketize, concentration
from ..operators.quality import (CORE_EXPECTATIONS, check_batch, duplicate_keys, null_counts,
                                 rule_audit, run_expectations)
from ..schemas import RAW_REQUIRED_ORDER_COLUMNS, RAW_SCHEMAS, SPECS
from ..session import scratch_path
from ..sinks.writers import append_by_name
from ..sources import fx as FXS
from ..sources.extract import read_incremental, read_with_lookback
from ..sources.files import latest_batch
from ..sources.watermark import advance_watermark, get_watermark
from .bronze import with_lineage
from .catalog import entry
from .core import fact_orphans
from .registry import Context, model
from .tables import with_fact_tables

# Report parameters.
CONCENTRATION_SEGMENTS = [("top_1pct", 1, True), ("top_5pct", 5, True), ("bottom_50pct", 50, False)]
# customer frequency segments by number of orders (upper bound, inclusive)
CUSTOMER_SEGMENTS = [("dormant", 0), ("light", 2), ("regular", 7), ("frequent", 19), ("vip", None)]
ORDERS_PIPELINE = "orders_pipeline"
WATERMARK_LAG_DAYS = 90
LOOKBACK = "180 DAYS"
LATE_ORDER_MOD = 97
STATE_UPDATED_AT = "2026-07-01 00:00:00"
ADVANCED_AT = "2026-07-02 00:00:00"
LINEAGE_BATCH = "2026-07-02"
LINEAGE_TS = "2026-07-02 01:00:00"
# FX snapshots derived from order days: a day ending in 3 failed, in 7 is missing
FX_FAILED_DAY_MOD = 3
FX_MISSING_DAY_MOD = 7


def _count(df: DataFrame, **labels) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        *[F.lit(v).alias(k) for k, v in labels.items()], "row_count")


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


# ---------------------------------------------------------------- expectations
for _e in CORE_EXPECTATIONS:
    if _e.kind == "unique":
        entry(f"unique_{_e.model}")(
            lambda ctx, _e=_e: duplicate_keys(ctx.ref(_e.model), _e.column))
    if _e.kind == "relationships":
        entry(f"rel_fact_{_e.to.removeprefix('dim_')}")(
            lambda ctx, _e=_e: fact_orphans(ctx, _e.column, ctx.ref(_e.to), _e.field))


@entry("not_null_core")
def not_null_core(ctx: Context) -> DataFrame:
    parts = [ctx.ref(e.model).agg(F.count(F.when(F.col(e.column).isNull(), 1)).alias("null_rows"))
             .select(F.lit(e.model).alias("model"), F.lit(e.column).alias("column_name"), "null_rows")
             for e in CORE_EXPECTATIONS if e.kind == "not_null"]
    return _union(parts)


@entry("expectation_report")
def expectation_report(ctx: Context) -> DataFrame:
    """The 13 column tests of the core models."""
    return run_expectations(ctx.ref, CORE_EXPECTATIONS)


@entry("raw_checks")
def raw_checks(ctx: Context) -> DataFrame:
    """Gate on the newest landed batch of every source table and the FX feed."""
    parts = []
    for t in SPECS:
        req = RAW_REQUIRED_ORDER_COLUMNS if t == "orders" else ()
        parts.append(check_batch(latest_batch(ctx.source(t)), t, req, optional=(t == "orders")))
    parts.append(check_batch(ctx.source("fx_rates"), "fx_rates",
                             ("base_currency", "target_currency", "exchange_rate", "last_updated")))
    # a batch that lacks a mandatory column must fail
    parts.append(check_batch(latest_batch(ctx.source("orders")).drop("order_status"), "orders_incomplete",
                             RAW_REQUIRED_ORDER_COLUMNS))
    return _union(parts)


@entry("dirty_rule_audit")
def dirty_rule_audit(ctx: Context) -> DataFrame:
    c = ctx.ref("dedupe_customers")
    p = ctx.ref("dedupe_products")
    i = ctx.ref("dedupe_order_items")
    return _union([
        rule_audit(c, "customers", "customer_id", [
            ("email", "null email", F.col("email").isNull()),
            ("phone", "missing phone", F.col("phone").isNull())]),
        rule_audit(p, "products", "product_id", [
            ("unit_cost", "negative cost", F.col("unit_cost") < 0),
            ("unit_price", "negative price", F.col("unit_price") < 0),
            ("is_active", "inactive product", ~F.col("is_active"))]),
        rule_audit(i, "order_items", "order_item_id", [
            ("unit_price_at_sale", "negative line price", F.col("unit_price_at_sale") < 0)]),
    ])


@entry("line_total_check")
def line_total_check(ctx: Context) -> DataFrame:
    i = ctx.ref("dedupe_order_items")
    expected = money(F.col("unit_price_at_sale") * F.col("quantity") - F.col("discount_amount"))
    return (i.select("order_item_id", "line_total", expected.alias("expected_line_total"))
            .where(~F.col("line_total").eqNullSafe(F.col("expected_line_total"))))


SOURCE_FKS = [
    ("orders", "customer_id", "customers", "customer_id"),
    ("orders", "store_id", "stores", "store_id"),
    ("order_items", "order_id", "orders", "order_id"),
    ("order_items", "product_id", "products", "product_id"),
    ("payments", "order_id", "orders", "order_id"),
]


@entry("source_orphans")
def source_orphans(ctx: Context) -> DataFrame:
    parts = []
    for child, fk, parent, pk in SOURCE_FKS:
        o = orphans(ctx.ref(f"dedupe_{child}"), fk, ctx.ref(f"dedupe_{parent}"), pk)
        parts.append(o.agg(F.count(F.lit(1)).alias("orphan_rows")).select(
            F.lit(child).alias("child_table"), F.lit(fk).alias("fk_column"),
            F.lit(parent).alias("parent_table"), "orphan_rows"))
    return _union(parts)


@entry("fact_dropped_rows")
def fact_dropped_rows(ctx: Context) -> DataFrame:
    """Latest order items that the inner star join discards, with the first reason."""
    i = ctx.ref("latest_order_items").select("order_item_id", "order_id", "product_id")
    o = ctx.ref("latest_orders").select(F.col("order_id").alias("__o"), "customer_id", "store_id")
    c = ctx.ref("dim_customer").select(F.col("customer_key").alias("__c"))
    p = ctx.ref("dim_product").select(F.col("product_key").alias("__p"))
    s = ctx.ref("dim_store").select(F.col("store_key").alias("__s"))
    j = (i.join(o, i.order_id == o.__o, "left")
          .join(c, F.col("customer_id") == F.col("__c"), "left")
          .join(p, F.col("product_id") == F.col("__p"), "left")
          .join(s, F.col("store_id") == F.col("__s"), "left"))
    reason = (F.when(F.col("__o").isNull(), "order_missing")
               .when(F.col("__c").isNull(), "customer_not_in_dim")
               .when(F.col("__p").isNull(), "product_not_in_dim")
               .when(F.col("__s").isNull(), "store_not_in_dim"))
    return j.select("order_item_id", "order_id", reason.alias("drop_reason")) \
            .where(F.col("drop_reason").isNotNull())


# ---------------------------------------------------------------- layer metrics
def _bronze_and_silver(ctx: Context, table: str, kept: Column | None = None) -> DataFrame:
    """bronze and silver rows of a table in one pass over bronze: rows per key with a map-side
    combine, and of each key whether its newest row is ``kept`` (all are without it)."""
    spec = SPECS[table]
    way = F.lit("silver") if kept is None else F.max_by(kept, F.struct(*spec.order_by, *spec.tie_breakers))
    keys = ctx.source(table).groupBy(spec.key).agg(F.count(F.lit(1)).alias("n"), way.alias("way"))
    ways = ["silver", "reject", "unknown"] if table == "customers" else ["silver"]
    sums = keys.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("bronze"),
                    *[F.count(F.when(F.col("way") == w, 1)).alias(w) for w in ways])
    counts = F.create_map(*[x for c in ["bronze", *ways] for x in (F.lit(c), F.col(c))])
    return sums.select(F.explode(counts).alias("layer", "row_count")).select(
        "layer", F.lit(table).alias("table_name"), "row_count")


@entry("layer_row_counts")
def layer_row_counts(ctx: Context) -> DataFrame:
    """Rows per layer, each table read once. What does not change the number of rows
    (cleansing, the FX join) is left out."""
    valid = C.email_is_valid("email")
    whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in SPECS["orders"].mandatory])
    kept = {"customers": F.when(valid, "silver").when(~valid, "reject").otherwise("unknown"),
            "orders": F.when(whole, "silver").otherwise("dropped")}
    return _union([_bronze_and_silver(ctx, t, kept.get(t)) for t in SPECS])


@entry("orders_reconciliation")
def orders_reconciliation(ctx: Context) -> DataFrame:
    """Rows in, after the dedupe and after the mandatory filter: one pass per side of the dedupe."""
    whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in SPECS["orders"].mandatory])
    none = F.lit(0).cast("bigint")
    bronze = ctx.source("orders").agg(F.count(F.lit(1)).alias("b"), none.alias("d"), none.alias("f"))
    kept = ctx.ref("dedupe_orders").agg(none.alias("b"), F.count(F.lit(1)).alias("d"),
                                        F.count(F.when(whole, 1)).alias("f"))
    row = bronze.unionByName(kept).agg(F.sum("b").alias("bronze_rows"), F.sum("d").alias("deduped_rows"),
                                       F.sum("f").alias("final_rows"))
    return row.select("bronze_rows", "deduped_rows", "final_rows",
                      (F.col("bronze_rows") - F.col("deduped_rows")).alias("duplicates_removed"),
                      (F.col("deduped_rows") - F.col("final_rows")).alias("null_rows_removed"))


@entry("orders_null_counts")
def orders_null_counts(ctx: Context) -> DataFrame:
    return null_counts(ctx.ref("dedupe_orders"), SPECS["orders"].mandatory)


# ---------------------------------------------------------------- cleansers
@entry("canonical_state")
def canonical_state(ctx: Context) -> DataFrame:
    c = ctx.ref("dedupe_customers")
    return (c.groupBy(F.col("state").alias("raw_state"))
            .agg(F.count(F.lit(1)).alias("customers"))
            .withColumn("canonical_state", C.canonical_state("raw_state")))


@entry("clean_phone")
def clean_phone(ctx: Context) -> DataFrame:
    c = ctx.ref("dedupe_customers")
    return c.select("customer_id", F.col("phone").alias("raw_phone"),
                    C.clean_phone("phone").alias("clean_phone"))


# ---------------------------------------------------------------- SCD1
def _first_batch(df: DataFrame) -> DataFrame:
    first = df.agg(F.min("batch_date").alias("__b"))
    return df.join(F.broadcast(first), F.col("batch_date") == F.col("__b"), "left_semi")


def _later_batches(df: DataFrame) -> DataFrame:
    first = df.agg(F.min("batch_date").alias("__b"))
    return df.join(F.broadcast(first), F.col("batch_date") == F.col("__b"), "left_anti")


@entry("scd1_customers")
def scd1_customers(ctx: Context) -> DataFrame:
    """Customer table of the first batch, updated in place by later changes of city."""
    src = ctx.source("customers")
    base = _first_batch(src).select(*RAW_SCHEMAS["customers"].fieldNames())
    changes = _later_batches(src).select("customer_id", "city", "updated_at")
    return apply_scd1(base, changes, "customer_id", "updated_at", ["city"])


@entry("scd1_products")
def scd1_products(ctx: Context) -> DataFrame:
    src = ctx.source("products")
    base = _first_batch(src).select(*RAW_SCHEMAS["products"].fieldNames())
    changes = _later_batches(src).select("product_id", "unit_cost", "updated_at")
    return apply_scd1(base, changes, "product_id", "updated_at", ["unit_cost"])


PRICE_COLUMNS = {"dim_product": ("product_key", ["unit_cost", "unit_price", "updated_at"]),
                 "fact_sales": ("order_item_id", ["unit_cost", "line_total", "profit"])}


@entry("price_invariance")
def price_invariance(ctx: Context) -> DataFrame:
    """What an update of product costs in place changes: costs of the dimension, and no
    measure of the fact, which keeps the cost of its day. One row per compared column."""
    src = ctx.source("products")
    base = _first_batch(src)
    changes = _later_batches(src).select("product_id", "unit_cost", "updated_at", "ingestion_timestamp", "batch_date")
    updated = apply_scd1(base, changes, "product_id", "updated_at", ["unit_cost"])

    def over(products: DataFrame) -> Context:
        return Context(ctx.spark, lambda t: products if t == "products" else ctx.source(t), ctx.options)
    old, new = over(base), over(updated)
    return _union([diff_counts(old.ref(m), new.ref(m), key, columns).select(F.lit(m).alias("table_name"), "*")
                   for m, (key, columns) in PRICE_COLUMNS.items()])


@entry("fact_sales_tables")
def fact_sales_tables(ctx: Context) -> DataFrame:
    """The sales fact over bucketed tables of the catalog."""
    database = f"fact_{uuid.uuid4().hex}"
    return with_fact_tables(ctx, database, root=scratch_path(ctx.spark, database)).ref("fact_sales")


# ---------------------------------------------------------------- profiles
def _orders_per(ctx: Context, col: str) -> DataFrame:
    return ctx.ref("latest_orders").groupBy(col).agg(F.count(F.lit(1)).alias("orders"))


@entry("product_concentration")
def product_concentration(ctx: Context) -> DataFrame:
    lines = ctx.ref("latest_order_items").groupBy("product_id").agg(F.count(F.lit(1)).alias("lines"))
    prods = ctx.ref("dim_product").select(F.col("product_key").alias("product_id"))
    counts = prods.join(lines, "product_id", "left").select(F.coalesce("lines", F.lit(0)).alias("lines"))
    return concentration(counts, "lines", CONCENTRATION_SEGMENTS)


def _store_orders(ctx: Context, by: str) -> DataFrame:
    per_store = _orders_per(ctx, "store_id")
    st = ctx.ref("dim_store").select(F.col("store_key").alias("store_id"), by)
    j = st.join(per_store, "store_id", "left")
    return j.groupBy(by).agg(
        F.count(F.lit(1)).alias("stores"),
        F.coalesce(F.sum("orders"), F.lit(0)).cast("bigint").alias("orders"),
    ).withColumn("orders_per_store", F.col("orders").cast("double") / F.col("stores"))


@entry("store_tier_orders")
def store_tier_orders(ctx: Context) -> DataFrame:
    return _store_orders(ctx, "store_size")


@entry("region_orders")
def region_orders(ctx: Context) -> DataFrame:
    return _store_orders(ctx, "region")


def _fact_by_category(ctx: Context) -> DataFrame:
    f = ctx.ref("fact_sales").select("product_key", "line_total")
    p = ctx.ref("dim_product").select("product_key", "category")
    return f.join(p, "product_key")


@entry("category_mix")
def category_mix(ctx: Context) -> DataFrame:
    g = _fact_by_category(ctx).groupBy("category").agg(
        F.count(F.lit(1)).alias("lines"), sum_money("line_total").alias("revenue"))
    # the grouped result has one row per category: a window over all of it is tiny
    total = F.sum("lines").over(Window.partitionBy(F.lit(0)))
    return g.withColumn("line_share", F.col("lines").cast("double") / total.cast("double"))


@entry("category_line_value")
def category_line_value(ctx: Context) -> DataFrame:
    return _fact_by_category(ctx).groupBy("category").agg(
        F.count(F.lit(1)).alias("lines"), avg_money("line_total").alias("average_line_value"))


@entry("customer_segments")
def customer_segments(ctx: Context) -> DataFrame:
    per = _orders_per(ctx, "customer_id")
    cust = ctx.ref("dim_customer").select(F.col("customer_key").alias("customer_id"))
    j = cust.join(per, "customer_id", "left").select(F.coalesce("orders", F.lit(0)).alias("orders"))
    seg = j.withColumn("segment", bucketize(F.col("orders"), CUSTOMER_SEGMENTS))
    g = seg.groupBy("segment").agg(F.count(F.lit(1)).alias("customers"),
                                   F.sum("orders").cast("bigint").alias("orders"))
    total = F.sum("customers").over(Window.partitionBy(F.lit(0)))
    return g.withColumn("customer_share", F.col("customers").cast("double") / total.cast("double"))


@entry("customer_order_counts")
def customer_order_counts(ctx: Context) -> DataFrame:
    return _orders_per(ctx, "customer_id").withColumnRenamed("orders", "order_count")


def _daily_orders(ctx: Context) -> DataFrame:
    return (ctx.ref("latest_orders").groupBy(F.col("order_date").cast("date").alias("day"))
            .agg(F.count(F.lit(1)).alias("orders")))


@entry("seasonality_lift")
def seasonality_lift(ctx: Context) -> DataFrame:
    d = _daily_orders(ctx)
    weekend = F.dayofweek("day").isin(1, 7)
    dec = F.month("day") == 12

    def avg_if(cond):
        return F.try_divide(F.sum(F.when(cond, F.col("orders"))).cast("double"),
                            F.count(F.when(cond, F.lit(1))).cast("double"))
    r = d.agg(avg_if(~weekend).alias("weekday_avg"), avg_if(weekend).alias("weekend_avg"),
              avg_if(dec).alias("december_avg"), avg_if(~dec).alias("other_month_avg"))
    return r.select("*", F.try_divide(F.col("weekend_avg"), F.col("weekday_avg")).alias("weekend_lift"),
                    F.try_divide(F.col("december_avg"), F.col("other_month_avg")).alias("december_lift"))


@entry("monthly_growth")
def monthly_growth(ctx: Context) -> DataFrame:
    m = (ctx.ref("latest_orders")
         .groupBy(F.year("order_date").alias("year"), F.month("order_date").alias("month"))
         .agg(F.count(F.lit(1)).alias("orders")))
    # one row per calendar month: the ordered window sees a calendar-sized input
    w = Window.partitionBy(F.lit(0)).orderBy("year", "month")
    prev = F.lag("orders").over(w)
    return m.select("year", "month", "orders", prev.alias("prev_orders"),
                    F.try_divide((F.col("orders") - prev).cast("double"), prev.cast("double"))
                    .alias("growth"))


@entry("inactive_rate")
def inactive_rate(ctx: Context) -> DataFrame:
    p = ctx.ref("silver_products")
    return p.agg(F.count(F.lit(1)).alias("products"),
                 F.count(F.when(~F.col("is_active"), 1)).alias("inactive_products")) \
        .withColumn("inactive_rate", F.col("inactive_products").cast("double") / F.col("products"))


@entry("fx_convert")
def fx_convert(ctx: Context) -> DataFrame:
    f = ctx.ref("fact_sales").select("order_item_id", "currency_code", "line_total")
    j = enrich_fx(f, ctx.ref("fx_rates_typed"))
    return j.withColumn("line_total_base", convert_to_base("line_total"))


@entry("payment_reconciliation")
def payment_reconciliation(ctx: Context) -> DataFrame:
    items = ctx.ref("latest_order_items").groupBy("order_id").agg(
        F.sum(money("line_total")).alias("__items"))
    pays = ctx.ref("silver_payments").groupBy("order_id").agg(
        F.sum(money("amount")).alias("__paid"))
    j = items.join(pays, "order_id", "full_outer")
    status = (F.when(F.col("__paid").isNull(), "missing_payment")
               .when(F.col("__items").isNull(), "missing_items")
               .when(F.col("__paid") == F.col("__items"), "match")
               .otherwise("mismatch"))
    return j.select("order_id", F.col("__items").cast("double").alias("items_total"),
                    F.col("__paid").cast("double").alias("payment_amount"),
                    money(F.col("__paid") - F.col("__items")).cast("double").alias("difference"),
                    status.alias("status"))


# ---------------------------------------------------------------- FX feed
@model("fx_snapshots", "sources")
def fx_snapshots(ctx: Context) -> DataFrame:
    """Daily FX snapshots (snapshot_date, status, payload JSON), one per order day.

    Derived from the order calendar so that the feed grows with the data:
    rates are a function of the day, some days fail and some are missing.
    """
    days = ctx.ref("latest_orders").select(F.col("order_date").cast("date").alias("d")).distinct()
    days = days.where(F.dayofmonth("d") % 10 != FX_MISSING_DAY_MOD)
    failed = F.dayofmonth("d") % 10 == FX_FAILED_DAY_MOD
    rates = F.create_map(
        F.lit("USD"), F.lit(1.0),
        F.lit("INR"), (F.dayofyear("d") + 8300).cast("double") / 100,
        F.lit("EUR"), (F.month("d") + 900).cast("double") / 1000,
        F.lit("GBP"), (F.dayofmonth("d") + 750).cast("double") / 1000)
    payload = F.to_json(F.struct(F.lit("USD").alias("base_code"),
                                 F.date_format("d", "yyyy-MM-dd 00:00:01").alias("time_last_update_utc"),
                                 rates.alias("rates")))
    return days.select(F.col("d").alias("snapshot_date"),
                       F.when(failed, F.lit("FAILED")).otherwise(F.lit(FXS.STATUS_SUCCESS)).alias("status"),
                       F.when(failed, F.lit(None).cast("string")).otherwise(payload).alias("payload"))


@entry("fx_explode")
def fx_explode(ctx: Context) -> DataFrame:
    return FXS.fx_rows(ctx.ref("fx_snapshots"), keep=("snapshot_date",))


@entry("fx_last_known_good")
def fx_last_known_good(ctx: Context) -> DataFrame:
    """Per order day: the snapshot used and whether the feed was degraded."""
    batches = ctx.ref("latest_orders").select(F.col("order_date").cast("date").alias("batch_date"))
    return FXS.latest_good_fx(batches, ctx.ref("fx_snapshots")).drop("payload")


# ---------------------------------------------------------------- sources, watermark
@model("source_orders", "sources")
def source_orders(ctx: Context) -> DataFrame:
    """The source system's current orders: newest version per key, no lineage."""
    return ctx.ref("dedupe_orders").select(*RAW_SCHEMAS["orders"].fieldNames())


@entry("src_snapshot")
def src_snapshot(ctx: Context) -> DataFrame:
    return ctx.ref("dedupe_customers").select(*RAW_SCHEMAS["customers"].fieldNames())


@model("watermark_state", "sources")
def watermark_state(ctx: Context) -> DataFrame:
    """State table with the orders pipeline's last watermark (derived from the data)."""
    newest = ctx.ref("source_orders").agg(F.max("order_date").alias("m"))
    return newest.select(
        F.lit(ORDERS_PIPELINE).alias("pipeline_name"),
        (F.col("m") - F.expr(f"INTERVAL {WATERMARK_LAG_DAYS} DAYS")).cast("timestamp_ntz")
        .alias("last_watermark"),
        F.lit(STATE_UPDATED_AT).cast("timestamp_ntz").alias("updated_at"))


@entry("wm_lookup")
def wm_lookup(ctx: Context) -> DataFrame:
    return get_watermark(ctx.ref("watermark_state"), ORDERS_PIPELINE)


@model("src_incremental", "sources")
def src_incremental(ctx: Context) -> DataFrame:
    wm = get_watermark(ctx.ref("watermark_state"), ORDERS_PIPELINE)
    return read_incremental(ctx.ref("source_orders"), "order_date", wm)


entry("src_incremental")(lambda ctx: ctx.ref("src_incremental"))


@entry("wm_advance")
def wm_advance(ctx: Context) -> DataFrame:
    return advance_watermark(ctx.ref("watermark_state"), ctx.ref("src_incremental"),
                             ORDERS_PIPELINE, "order_date", updated_at=ADVANCED_AT)


def _landed_before(ctx: Context) -> DataFrame:
    """Orders as earlier runs have landed them: the first batch's rows up to the watermark,
    without those that came too late for it."""
    mark = ctx.ref("watermark_state").agg(F.max("last_watermark")).first()[0]
    return _first_batch(ctx.source("orders")).where(
        (F.col("order_date") <= F.lit(mark).cast("timestamp_ntz")) & (F.col("order_id") % LATE_ORDER_MOD != 5))


@entry("src_late_rows")
def src_late_rows(ctx: Context) -> DataFrame:
    """The orders increment with a lookback: rows past the watermark, and of the days before
    it those that earlier runs have missed or that have changed since."""
    mark = get_watermark(ctx.ref("watermark_state"), ORDERS_PIPELINE)
    return read_with_lookback(ctx.ref("source_orders"), "order_id", "order_date", mark, LOOKBACK,
                              _landed_before(ctx), ["batch_date"])


@entry("bronze_all_batches")
def bronze_all_batches(ctx: Context) -> DataFrame:
    return _union([ctx.source(t).groupBy("batch_date").agg(F.count(F.lit(1)).alias("row_count"))
                   .select(F.lit(t).alias("table_name"), "batch_date", "row_count") for t in SPECS])


@entry("latest_batch")
def latest_batch_orders(ctx: Context) -> DataFrame:
    return latest_batch(ctx.source("orders"))


@entry("bronze_lineage")
def bronze_lineage(ctx: Context) -> DataFrame:
    return with_lineage(ctx.ref("source_orders"), LINEAGE_BATCH, source_file="fixture",
                        ingestion_ts=LINEAGE_TS)


@entry("append_by_name")
def append_by_name_orders(ctx: Context) -> DataFrame:
    """A second load of orders with upper-case names, one column missing and one
    unknown column, appended by name onto the staged orders."""
    existing = ctx.ref("stg_orders")
    incoming = ctx.ref("silver_orders").drop("exchange_rate")
    incoming = incoming.select(*[F.col(c).alias(c.upper()) for c in incoming.columns],
                               F.lit("x").alias("EXTRA_COLUMN"))
    return append_by_name(existing, incoming)
