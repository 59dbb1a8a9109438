"""Adapter tables over the TPC-H-like test parquet (see FIXTURES.md).

Each adapter turns a test table into one of the retail source tables, already
stamped with lineage and with a second record version for one key in ten, so it
plays the role of a bronze table holding two daily batches.

The column expressions below are written in the common subset of Spark SQL and
DuckDB; ``oracle/`` reuses the same text, so both engines start from identical
rows. Spark builds the version rows with ``explode`` (a generator, no join).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# --- adapter definitions (FIXTURES.md §2) --------------------------------------
# Lineage constants and the money types of the adapters.
SOURCE_SYSTEM = "postgres"
SOURCE_FILE = "fixture"
MONEY2 = "decimal(10,2)"
MONEY4 = "decimal(18,4)"

CUSTOMERS = [
    ("customer_id", "c_custkey"),
    ("first_name", "concat('  ', lower(c_mktsegment), ' ')"),
    ("last_name", "upper(c_name)"),
    ("email", "case when c_custkey % 33 = 0 then null when c_custkey % 20 = 7 "
              "then concat('user', c_custkey, '.example.com') "
              "else concat('user', c_custkey, '@example.com') end"),
    ("phone", "case when c_custkey % 20 = 3 then null else concat('+91 (', 100 + c_custkey % 900, "
              "') 555-', 1000 + c_custkey % 9000) end"),
    ("address", "concat(c_custkey, ' Main St')"),
    ("city", "concat('City ', c_nationkey, case when v = 2 then ' moved' else '' end)"),
    ("state", "case c_custkey % 8 when 0 then 'TN' when 1 then 'Tamil Nadu' when 2 then 'TamilNadu' "
              "when 3 then 'KA' when 4 then 'Karnataka' when 5 then 'MH' when 6 then 'Maharashtra' "
              "else '  kerala ' end"),
    ("country", "concat(' ', lower(n_name))"),
    ("signup_date", "date '2020-01-01' + cast(c_custkey % 365 as int)"),
    ("is_active", "c_acctbal >= 1000"),
    ("created_at", "cast('2020-01-01 00:00:00' as {TS})"),
    ("updated_at", "cast(concat('2026-07-0', v, ' 00:00:00') as {TS})"),
]

PRODUCTS = [
    ("product_id", "p_partkey"),
    ("product_name", "concat(' ', upper(p_name))"),
    ("category", "lower(p_type)"),
    ("sub_category", "p_brand"),
    ("unit_price", "cast(case when p_partkey % 100 = 1 then -p_retailprice else p_retailprice end "
                   "as decimal(10,2))"),
    ("unit_cost", "cast(cast(case when p_partkey % 100 = 2 then -p_retailprice else p_retailprice end "
                  "as decimal(10,2)) * cast(case when v = 2 then '0.66' else '0.60' end as decimal(3,2)) "
                  "as decimal(18,4))"),
    ("is_active", "p_partkey % 33 <> 0"),
    ("created_at", "cast('2020-01-01 00:00:00' as {TS})"),
    ("updated_at", "cast(concat('2026-07-0', v, ' 00:00:00') as {TS})"),
]

STORES = [
    ("store_id", "s_suppkey"),
    ("store_name", "concat(lower(s_name), ' ')"),
    ("store_type", "case when s_suppkey % 10 < 7 then 'physical' else 'online' end"),
    ("store_size", "case when s_suppkey % 20 < 3 then 'large' when s_suppkey % 20 < 12 then 'medium' "
                   "else 'small' end"),
    ("region", "lower(r_name)"),
    ("country", "n_name"),
    ("opened_date", "date '2018-01-01' + cast(s_suppkey % 365 as int)"),
    ("created_at", "cast(concat('2018-01-0', v, ' 00:00:00') as {TS})"),
]

ORDERS = [
    ("order_id", "o_orderkey"),
    ("customer_id", "o_custkey"),
    ("store_id", "o_custkey % 10"),
    ("order_date", "o_orderdate"),
    ("order_status", "case when o_orderkey % 50 = 13 then null when o_orderstatus = 'F' or v = 2 "
                     "then 'completed' when o_orderstatus = 'O' then 'pending' else 'cancelled' end"),
    ("currency_code", "case o_orderkey % 5 when 0 then 'INR' when 1 then 'USD' when 2 then 'EUR' "
                      "when 3 then 'GBP' else 'XXX' end"),
    ("created_at", "o_orderdate"),
]

ORDER_ITEMS = [
    ("order_item_id", "l_orderkey * 10 + l_linenumber"),
    ("order_id", "l_orderkey"),
    ("product_id", "l_partkey"),
    ("quantity", "cast(l_quantity as int)"),
    ("unit_price_at_sale", "cast(l_extendedprice as decimal(10,2))"),
    ("unit_cost_at_sale", "cast(cast(l_extendedprice as decimal(10,2)) * cast('0.60' as decimal(3,2)) "
                          "as decimal(18,4))"),
    ("discount_amount", "cast(cast(l_extendedprice as decimal(10,2)) * cast(l_discount as decimal(4,2)) "
                        "as decimal(18,4))"),
    ("line_total", "cast(cast(l_extendedprice as decimal(10,2)) * cast(l_quantity as int) "
                   "- cast(l_extendedprice as decimal(10,2)) * cast(l_discount as decimal(4,2)) "
                   "as decimal(18,4))"),
    ("created_at", "l_shipdate"),
    ("ingestion_timestamp", "l_shipdate"),
    ("batch_date", "cast(l_shipdate as date)"),
]

PAYMENTS = [
    ("payment_id", "o_orderkey"),
    ("order_id", "o_orderkey"),
    ("payment_method", "case o_orderkey % 5 when 0 then 'credit_card' when 1 then 'upi' when 2 then 'paypal' "
                       "when 3 then ' net_banking' else 'debit_card' end"),
    ("payment_status", "case when o_orderkey % 20 = 0 and v = 1 then 'failed' when o_orderkey % 33 = 0 "
                       "then 'refunded' else 'success' end"),
    ("amount", "cast(o_totalprice as decimal(12,2))"),
    ("currency_code", "case o_orderkey % 5 when 0 then 'INR' when 1 then 'USD' when 2 then 'EUR' "
                      "when 3 then 'GBP' else 'XXX' end"),
    ("payment_date", "o_orderdate"),
    ("created_at", "o_orderdate"),
]

# Batch lineage for the versioned adapters (v = 1 is the first daily batch).
VERSION_LINEAGE = [
    ("ingestion_timestamp", "cast(concat('2026-07-0', v, ' 01:00:00') as {TS})"),
    ("batch_date", "cast(concat('2026-07-0', v) as date)"),
]
CONST_LINEAGE = [
    ("source_system", "'postgres'"),
    ("source_file", "'fixture'"),
]

# FX feed rows: (target currency, rate as text). GBP does not parse, XXX is absent.
FX_RATES = [("USD", "1.0"), ("INR", "83.25"), ("EUR", "0.92"), ("GBP", "n/a")]
FX_BASE = "USD"
FX_LAST_UPDATED = "Wed, 01 Jul 2026 00:00:01 +0000"

# adapter name -> (source tables, key whose multiples of ten get a second version)
ADAPTERS = {
    "customers": (CUSTOMERS, "c_custkey"),
    "products": (PRODUCTS, "p_partkey"),
    "stores": (STORES, "s_suppkey"),
    "orders": (ORDERS, "o_orderkey"),
    "order_items": (ORDER_ITEMS, None),
    "payments": (PAYMENTS, "o_orderkey"),
}
# --- end of adapter definitions ------------------------------------------------

# The adapters' daily batches; after each one, silver is loaded into staging.
LOAD_DATES = ("2026-07-01", "2026-07-02")


def columns(adapter: str, ts_type: str) -> list[tuple[str, str]]:
    """Ordered (name, expression) list of an adapter, lineage included."""
    cols, version_key = ADAPTERS[adapter]
    lineage = (VERSION_LINEAGE if version_key else []) + CONST_LINEAGE
    return [(n, e.replace("{TS}", ts_type)) for n, e in cols + lineage]


def _read(spark: SparkSession, sf_dir: str, table: str, memo: dict | None = None) -> DataFrame:
    """One test table; with ``memo`` each file is opened (listed, footer read) once."""
    if memo is None:
        return spark.read.parquet(f"{sf_dir}/{table}.parquet")
    if table not in memo:
        memo[table] = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    return memo[table]


def _source(spark: SparkSession, sf_dir: str, adapter: str, memo: dict | None = None) -> DataFrame:
    if adapter == "customers":
        nation = _read(spark, sf_dir, memo=memo, table="nation").select("n_nationkey", "n_name")
        return _read(spark, sf_dir, memo=memo, table="customer").join(
            F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"))
    if adapter == "products":
        return _read(spark, sf_dir, memo=memo, table="part")
    if adapter == "stores":
        nation = _read(spark, sf_dir, memo=memo, table="nation")
        region = _read(spark, sf_dir, memo=memo, table="region")
        geo = nation.join(F.broadcast(region), F.col("n_regionkey") == F.col("r_regionkey"))
        return _read(spark, sf_dir, memo=memo, table="supplier").join(
            F.broadcast(geo.select("n_nationkey", "n_name", "r_name")),
            F.col("s_nationkey") == F.col("n_nationkey"))
    if adapter in ("orders", "payments"):
        return _read(spark, sf_dir, memo=memo, table="orders")
    if adapter == "order_items":
        return _read(spark, sf_dir, memo=memo, table="lineitem")
    raise KeyError(adapter)


def adapter(spark: SparkSession, sf_dir: str, name: str, memo: dict | None = None) -> DataFrame:
    """One adapter table (bronze-shaped, both batches) as a DataFrame.

    nation/region are the fixed 25/5-row TPC-H reference tables, so broadcasting
    them is bounded by construction.
    """
    _, version_key = ADAPTERS[name]
    df = _source(spark, sf_dir, name, memo)
    if version_key:
        # v = 1 for every key; v = 2 (a later batch) for keys that are multiples of ten
        df = df.withColumn(
            "v", F.explode(F.when(F.col(version_key) % 10 == 0, F.array(F.lit(1), F.lit(2)))
                           .otherwise(F.array(F.lit(1)))))
    return df.selectExpr(*[f"{e} AS {n}" for n, e in columns(name, "timestamp_ntz")])


def fx_rates_raw(spark: SparkSession, sf_dir: str | None = None) -> DataFrame:
    """The landed FX CSV rows: all four columns as text."""
    rows = [(FX_BASE, t, r, FX_LAST_UPDATED) for t, r in FX_RATES]
    return spark.createDataFrame(
        rows, "base_currency string, target_currency string, exchange_rate string, last_updated string")


def register_views(spark: SparkSession, sf_dir: str, prefix: str = "") -> None:
    """Register every adapter as a temp view (``customers``, ``orders``, ...)."""
    for name in ADAPTERS:
        adapter(spark, sf_dir, name).createOrReplaceTempView(prefix + name)
    fx_rates_raw(spark).createOrReplaceTempView(prefix + "fx_rates")
