"""Oracle SQL per registered query key."""

from __future__ import annotations

from lakeforge.functions.cleanse import PHONE_STRIP_PATTERN

from .sql import avg_money, canonical_state, q, sum_money, with_models

ORACLE: dict[str, str] = {}


def _add(key: str, select: str) -> None:
    ORACLE[key] = with_models(select)


for _name in [
    "dedupe_customers", "dedupe_products", "dedupe_stores", "dedupe_orders",
    "dedupe_order_items", "dedupe_payments",
    "orders_mandatory", "clean_customers", "silver_products", "silver_stores",
    "silver_payments",
    "stg_customers", "stg_products", "stg_stores", "stg_orders", "stg_order_items",
    "stg_payments",
    "dim_customer", "dim_product", "dim_store", "dim_date",
    "latest_orders", "latest_order_items", "fact_sales",
]:
    _add(_name, f"SELECT * FROM {_name}")

for _key, _cte in [("orders_fx", "silver_orders"), ("customers_valid", "silver_customers"),
                   ("customers_rejected", "reject_customers"),
                   ("customers_null_email", "unknown_customers"),
                   ("clean_products", "silver_products"), ("clean_stores", "silver_stores"),
                   ("clean_payments", "silver_payments")]:
    _add(_key, f"SELECT * FROM {_cte}")

def _totals(key: str, items: str, spent: str, average: str, more: str = "") -> str:
    """Totals of the fact by ``key``, money as exact sums."""
    return f"""(
  SELECT {key} AS k, count(DISTINCT order_id) AS total_orders,
         cast(sum(quantity) AS bigint) AS {items}, {sum_money('line_total')} AS {spent},
         {sum_money('profit')} AS total_profit, {avg_money('line_total')} AS {average}{more}
  FROM fact_sales GROUP BY {key})"""


_add("gold_sales_analytics", "SELECT * EXCLUDE (k), k AS date_key FROM "
     + _totals("date_key", "total_items_sold", "total_revenue", "average_line_item_value") + " d")
_add("gold_customer_analytics",
     "SELECT t.* EXCLUDE (k), customer_key, customer_id, first_name, last_name, city, state, country FROM "
     + _totals("customer_key", "total_items_purchased", "total_spent", "average_line_item_value",
               ", max(date_key) AS last_order_date") + " t JOIN dim_customer ON k = customer_key")
_GOLD_PRODUCT = (
    "SELECT t.* EXCLUDE (k, total_profit), product_key, product_id, product_name, category, sub_category, "
    "total_profit FROM " + _totals("product_key", "units_sold", "total_revenue", "average_sale_value")
    + " t JOIN dim_product ON k = product_key")
_add("gold_product_analytics", _GOLD_PRODUCT)
_add("top_products_by_revenue",
     f"SELECT * FROM ({_GOLD_PRODUCT}) g ORDER BY total_revenue DESC, product_key ASC LIMIT 10")

# ------------------------------------------------------------------ quality
for _m, _k in [("dim_customer", "customer_key"), ("dim_product", "product_key"),
               ("dim_store", "store_key"), ("dim_date", "date_key"),
               ("fact_sales", "order_item_id")]:
    _add(f"unique_{_m}", f"SELECT {_k}, count(*) AS n FROM {_m} WHERE {_k} IS NOT NULL "
                         f"GROUP BY {_k} HAVING count(*) > 1")

for _d, _k in [("customer", "customer_key"), ("product", "product_key"), ("store", "store_key")]:
    _add(f"rel_fact_{_d}", f"SELECT f.* FROM fact_sales f WHERE f.{_k} IS NOT NULL AND NOT EXISTS "
                           f"(SELECT 1 FROM dim_{_d} d WHERE d.{_k} = f.{_k})")

_NOT_NULL = [("dim_customer", "customer_key"), ("dim_product", "product_key"),
             ("dim_store", "store_key"), ("dim_date", "date_key"), ("fact_sales", "order_item_id")]
_add("not_null_core", " UNION ALL ".join(
    f"SELECT '{m}' AS model, '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_rows "
    f"FROM {m}" for m, c in _NOT_NULL))

_TESTS = []
for _m, _c in _NOT_NULL:
    _TESTS.append((f"unique_{_m}_{_c}", "unique", _m, _c,
                   f"SELECT count(*) FROM (SELECT {_c} FROM {_m} WHERE {_c} IS NOT NULL "
                   f"GROUP BY {_c} HAVING count(*) > 1)"))
    _TESTS.append((f"not_null_{_m}_{_c}", "not_null", _m, _c,
                   f"SELECT count(*) FROM {_m} WHERE {_c} IS NULL"))
for _d, _k in [("customer", "customer_key"), ("product", "product_key"), ("store", "store_key")]:
    _TESTS.append((f"relationships_fact_sales_{_k}__dim_{_d}_{_k}", "relationships", "fact_sales", _k,
                   f"SELECT count(*) FROM fact_sales f WHERE f.{_k} IS NOT NULL AND NOT EXISTS "
                   f"(SELECT 1 FROM dim_{_d} d WHERE d.{_k} = f.{_k})"))
_add("expectation_report", " UNION ALL ".join(
    f"SELECT '{n}' AS test_name, '{kd}' AS kind, '{m}' AS model, '{c}' AS column_name, "
    f"({sq}) AS failures, ({sq}) = 0 AS passed" for n, kd, m, c, sq in _TESTS))

_RAW = []
for _t in ["customers", "products", "stores", "orders", "order_items", "payments"]:
    _RAW.append(f"SELECT '{_t}' AS table_name, true AS batch_present, count(*) AS row_count, "
                f"'' AS missing_columns, count(*) > 0 AS passed FROM b_{_t} "
                f"WHERE batch_date = (SELECT max(batch_date) FROM b_{_t})")
_RAW.append("SELECT 'fx_rates' AS table_name, true AS batch_present, count(*) AS row_count, "
            "'' AS missing_columns, count(*) > 0 AS passed FROM fx_raw")
_RAW.append("SELECT 'orders_incomplete', true, count(*), 'order_status', false FROM b_orders "
            "WHERE batch_date = (SELECT max(batch_date) FROM b_orders)")
_add("raw_checks", " UNION ALL ".join(_RAW))

_add("dirty_rule_audit", """
SELECT 'customers' AS table_name, customer_id AS row_key, 'email' AS field, 'null email' AS issue
  FROM dedupe_customers WHERE email IS NULL
UNION ALL SELECT 'customers', customer_id, 'phone', 'missing phone' FROM dedupe_customers WHERE phone IS NULL
UNION ALL SELECT 'products', product_id, 'unit_cost', 'negative cost' FROM dedupe_products WHERE unit_cost < 0
UNION ALL SELECT 'products', product_id, 'unit_price', 'negative price' FROM dedupe_products WHERE unit_price < 0
UNION ALL SELECT 'products', product_id, 'is_active', 'inactive product' FROM dedupe_products WHERE NOT is_active
UNION ALL SELECT 'order_items', order_item_id, 'unit_price_at_sale', 'negative line price'
  FROM dedupe_order_items WHERE unit_price_at_sale < 0""")

_add("line_total_check", """
SELECT order_item_id, line_total, expected_line_total FROM (
  SELECT order_item_id, line_total,
         cast(unit_price_at_sale * quantity - discount_amount AS decimal(18,4)) AS expected_line_total
  FROM dedupe_order_items) t
WHERE line_total IS DISTINCT FROM expected_line_total""")

_FKS = [("orders", "customer_id", "customers", "customer_id"),
        ("orders", "store_id", "stores", "store_id"),
        ("order_items", "order_id", "orders", "order_id"),
        ("order_items", "product_id", "products", "product_id"),
        ("payments", "order_id", "orders", "order_id")]
_add("source_orphans", " UNION ALL ".join(
    f"SELECT '{c}' AS child_table, '{fk}' AS fk_column, '{p}' AS parent_table, count(*) AS orphan_rows "
    f"FROM dedupe_{c} x WHERE x.{fk} IS NOT NULL AND NOT EXISTS "
    f"(SELECT 1 FROM dedupe_{p} y WHERE y.{pk} = x.{fk})" for c, fk, p, pk in _FKS))

_add("fact_dropped_rows", """
SELECT order_item_id, order_id, drop_reason FROM (
  SELECT i.order_item_id, i.order_id,
    CASE WHEN o.order_id IS NULL THEN 'order_missing'
         WHEN c.customer_key IS NULL THEN 'customer_not_in_dim'
         WHEN p.product_key IS NULL THEN 'product_not_in_dim'
         WHEN s.store_key IS NULL THEN 'store_not_in_dim' END AS drop_reason
  FROM latest_order_items i
  LEFT JOIN latest_orders o ON i.order_id = o.order_id
  LEFT JOIN dim_customer c ON o.customer_id = c.customer_key
  LEFT JOIN dim_product p ON i.product_id = p.product_key
  LEFT JOIN dim_store s ON o.store_id = s.store_key) t
WHERE drop_reason IS NOT NULL""")

# ------------------------------------------------------------------ layer metrics
_LAYER = [f"SELECT 'bronze' AS layer, '{t}' AS table_name, count(*) AS row_count FROM b_{t}"
          for t in ["customers", "products", "stores", "orders", "order_items", "payments"]]
_LAYER += [f"SELECT 'silver', '{t}', count(*) FROM silver_{t}"
           for t in ["orders", "customers", "products", "stores", "order_items", "payments"]]
_LAYER += ["SELECT 'reject', 'customers', count(*) FROM reject_customers",
           "SELECT 'unknown', 'customers', count(*) FROM unknown_customers"]
_add("layer_row_counts", " UNION ALL ".join(_LAYER))

_add("orders_reconciliation", """
SELECT b AS bronze_rows, d AS deduped_rows, f AS final_rows, b - d AS duplicates_removed,
       d - f AS null_rows_removed
FROM (SELECT (SELECT count(*) FROM b_orders) AS b, (SELECT count(*) FROM dedupe_orders) AS d,
             (SELECT count(*) FROM orders_mandatory) AS f) t""")

_MAND = ["order_id", "customer_id", "store_id", "order_date", "order_status", "currency_code",
         "created_at", "ingestion_timestamp", "batch_date", "source_system", "source_file"]
_add("orders_null_counts", "SELECT " + ", ".join(
    f"count(*) FILTER (WHERE {c} IS NULL) AS {c}" for c in _MAND) + " FROM dedupe_orders")

# ------------------------------------------------------------------ cleansers
_add("canonical_state", f"""
SELECT state AS raw_state, count(*) AS customers, {canonical_state('state')} AS canonical_state
FROM dedupe_customers GROUP BY state""")
_add("clean_phone", f"""
SELECT customer_id, phone AS raw_phone, regexp_replace(phone, {q(PHONE_STRIP_PATTERN)}, '', 'g') AS clean_phone
FROM dedupe_customers""")

# ------------------------------------------------------------------ SCD1
_add("scd1_customers", """
SELECT b.customer_id, b.first_name, b.last_name, b.email, b.phone, b.address,
       coalesce(c.city, b.city) AS city, b.state, b.country, b.signup_date, b.is_active,
       b.created_at, coalesce(c.updated_at, b.updated_at) AS updated_at
FROM (SELECT * FROM b_customers WHERE batch_date = (SELECT min(batch_date) FROM b_customers)) b
LEFT JOIN (SELECT * FROM b_customers WHERE batch_date > (SELECT min(batch_date) FROM b_customers)) c
  ON b.customer_id = c.customer_id""")
_add("scd1_products", """
SELECT b.product_id, b.product_name, b.category, b.sub_category, b.unit_price,
       coalesce(c.unit_cost, b.unit_cost) AS unit_cost, b.is_active, b.created_at,
       coalesce(c.updated_at, b.updated_at) AS updated_at
FROM (SELECT * FROM b_products WHERE batch_date = (SELECT min(batch_date) FROM b_products)) b
LEFT JOIN (SELECT * FROM b_products WHERE batch_date > (SELECT min(batch_date) FROM b_products)) c
  ON b.product_id = c.product_id""")

# ------------------------------------------------------------------ profiles
_CONC = []
for _name, _pct, _top in [("top_1pct", 1, True), ("top_5pct", 5, True), ("bottom_50pct", 50, False)]:
    _CONC.append(f"""
SELECT '{_name}' AS segment, (SELECT count(*) FROM pl) AS entities,
       ((SELECT count(*) FROM pl) * {_pct} + 99) // 100 AS covered,
       cast((SELECT sum(lines) FROM (SELECT lines FROM pl ORDER BY lines {'DESC' if _top else 'ASC'}
              LIMIT ((SELECT count(*) FROM pl) * {_pct} + 99) // 100) x) AS bigint) AS lines,
       cast((SELECT sum(lines) FROM (SELECT lines FROM pl ORDER BY lines {'DESC' if _top else 'ASC'}
              LIMIT ((SELECT count(*) FROM pl) * {_pct} + 99) // 100) x) AS double)
         / cast((SELECT sum(lines) FROM pl) AS double) AS share""")
ORACLE["product_concentration"] = with_models(
    "", extra="pl AS (SELECT p.product_key, coalesce(l.lines, 0) AS lines FROM dim_product p "
              "LEFT JOIN (SELECT product_id, count(*) AS lines FROM latest_order_items "
              "GROUP BY product_id) l ON p.product_key = l.product_id)") + " UNION ALL ".join(_CONC)

for _key, _by in [("store_tier_orders", "store_size"), ("region_orders", "region")]:
    _add(_key, f"""
SELECT s.{_by}, count(*) AS stores, cast(coalesce(sum(o.orders), 0) AS bigint) AS orders,
       cast(coalesce(sum(o.orders), 0) AS double) / count(*) AS orders_per_store
FROM dim_store s LEFT JOIN (SELECT store_id, count(*) AS orders FROM latest_orders GROUP BY store_id) o
  ON s.store_key = o.store_id
GROUP BY s.{_by}""")

_add("category_mix", f"""
SELECT category, lines, revenue, cast(lines AS double) / cast(sum(lines) OVER () AS double) AS line_share
FROM (SELECT p.category, count(*) AS lines, {sum_money('f.line_total')} AS revenue
      FROM fact_sales f JOIN dim_product p ON f.product_key = p.product_key GROUP BY p.category) g""")

_add("category_line_value", f"""
SELECT p.category, count(*) AS lines, {avg_money('f.line_total')} AS average_line_value
FROM fact_sales f JOIN dim_product p ON f.product_key = p.product_key GROUP BY p.category""")

_add("customer_segments", """
SELECT segment, customers, orders, cast(customers AS double) / cast(sum(customers) OVER () AS double)
       AS customer_share
FROM (SELECT CASE WHEN n <= 0 THEN 'dormant' WHEN n <= 2 THEN 'light' WHEN n <= 7 THEN 'regular'
                  WHEN n <= 19 THEN 'frequent' ELSE 'vip' END AS segment,
             count(*) AS customers, cast(sum(n) AS bigint) AS orders
      FROM (SELECT c.customer_key, coalesce(o.orders, 0) AS n FROM dim_customer c
            LEFT JOIN (SELECT customer_id, count(*) AS orders FROM latest_orders GROUP BY customer_id) o
            ON c.customer_key = o.customer_id) x
      GROUP BY 1) g""")

_add("customer_order_counts",
     "SELECT customer_id, count(*) AS order_count FROM latest_orders GROUP BY customer_id")

_add("seasonality_lift", """
SELECT weekday_avg, weekend_avg, december_avg, other_month_avg,
       weekend_avg / weekday_avg AS weekend_lift, december_avg / other_month_avg AS december_lift
FROM (SELECT
  cast(sum(orders) FILTER (WHERE dayofweek(day) NOT IN (0, 6)) AS double)
    / cast(count(*) FILTER (WHERE dayofweek(day) NOT IN (0, 6)) AS double) AS weekday_avg,
  cast(sum(orders) FILTER (WHERE dayofweek(day) IN (0, 6)) AS double)
    / cast(count(*) FILTER (WHERE dayofweek(day) IN (0, 6)) AS double) AS weekend_avg,
  cast(sum(orders) FILTER (WHERE month(day) = 12) AS double)
    / cast(count(*) FILTER (WHERE month(day) = 12) AS double) AS december_avg,
  cast(sum(orders) FILTER (WHERE month(day) <> 12) AS double)
    / cast(count(*) FILTER (WHERE month(day) <> 12) AS double) AS other_month_avg
  FROM (SELECT cast(order_date AS date) AS day, count(*) AS orders FROM latest_orders GROUP BY 1) d) t""")

_add("monthly_growth", """
SELECT year, month, orders, prev_orders,
       cast(orders - prev_orders AS double) / cast(prev_orders AS double) AS growth
FROM (SELECT year, month, orders, lag(orders) OVER (ORDER BY year, month) AS prev_orders
      FROM (SELECT cast(year(order_date) AS integer) AS year, cast(month(order_date) AS integer) AS month,
                   count(*) AS orders FROM latest_orders GROUP BY 1, 2) m) t""")

_add("inactive_rate", """
SELECT count(*) AS products, count(*) FILTER (WHERE NOT is_active) AS inactive_products,
       cast(count(*) FILTER (WHERE NOT is_active) AS double) / count(*) AS inactive_rate
FROM silver_products""")

_add("fx_convert", """
SELECT f.order_item_id, f.currency_code, f.line_total, r.exchange_rate,
       CASE WHEN r.exchange_rate IS NOT NULL AND r.exchange_rate <> 0
            THEN cast(f.line_total AS double) / r.exchange_rate END AS line_total_base
FROM fact_sales f LEFT JOIN fx_rates_typed r ON f.currency_code = r.target_currency""")

_add("payment_reconciliation", """
SELECT coalesce(i.order_id, p.order_id) AS order_id, cast(i.items AS double) AS items_total,
       cast(p.paid AS double) AS payment_amount,
       cast(cast(p.paid - i.items AS decimal(18,4)) AS double) AS difference,
       CASE WHEN p.paid IS NULL THEN 'missing_payment' WHEN i.items IS NULL THEN 'missing_items'
            WHEN p.paid = i.items THEN 'match' ELSE 'mismatch' END AS status
FROM (SELECT order_id, sum(cast(line_total AS decimal(18,4))) AS items FROM latest_order_items
      GROUP BY order_id) i
FULL OUTER JOIN (SELECT order_id, sum(cast(amount AS decimal(18,4))) AS paid FROM silver_payments
      GROUP BY order_id) p ON i.order_id = p.order_id""")

# ------------------------------------------------------------------ FX feed
_FX_SNAP = ("fx_snap AS (SELECT d AS snapshot_date, "
            "CASE WHEN day(d) % 10 = 3 THEN 'FAILED' ELSE 'SUCCESS' END AS status "
            "FROM (SELECT DISTINCT cast(order_date AS date) AS d FROM latest_orders) x "
            "WHERE day(d) % 10 <> 7)")
ORACLE["fx_explode"] = with_models("", extra=_FX_SNAP) + """
SELECT snapshot_date, 'USD' AS base_currency, target_currency, exchange_rate,
       strftime(snapshot_date, '%Y-%m-%d 00:00:01') AS last_updated
FROM (
  SELECT snapshot_date, 'USD' AS target_currency, 1.0::double AS exchange_rate FROM fx_snap WHERE status = 'SUCCESS'
  UNION ALL SELECT snapshot_date, 'INR', cast(dayofyear(snapshot_date) + 8300 AS double) / 100
    FROM fx_snap WHERE status = 'SUCCESS'
  UNION ALL SELECT snapshot_date, 'EUR', cast(month(snapshot_date) + 900 AS double) / 1000
    FROM fx_snap WHERE status = 'SUCCESS'
  UNION ALL SELECT snapshot_date, 'GBP', cast(day(snapshot_date) + 750 AS double) / 1000
    FROM fx_snap WHERE status = 'SUCCESS') r"""

ORACLE["fx_last_known_good"] = with_models("", extra=_FX_SNAP) + """
SELECT b.batch_date, g.snapshot_date,
       CASE WHEN g.snapshot_date IS NULL THEN 'UNAVAILABLE'
            WHEN g.snapshot_date = b.batch_date THEN 'SUCCESS' ELSE 'DEGRADED' END AS fx_status
FROM (SELECT DISTINCT cast(order_date AS date) AS batch_date FROM latest_orders) b
ASOF LEFT JOIN (SELECT snapshot_date FROM fx_snap WHERE status = 'SUCCESS') g
  ON b.batch_date >= g.snapshot_date"""

# ------------------------------------------------------------------ sources, watermark
_RAW_ORDERS = "order_id, customer_id, store_id, order_date, order_status, currency_code, created_at"
_RAW_CUSTOMERS = ("customer_id, first_name, last_name, email, phone, address, city, state, country, "
                  "signup_date, is_active, created_at, updated_at")
_WM = ("wm_state AS (SELECT 'orders_pipeline' AS pipeline_name, "
       "cast(max(order_date) - INTERVAL 90 DAY AS timestamp) AS last_watermark, "
       "TIMESTAMP '2026-07-01 00:00:00' AS updated_at FROM dedupe_orders), "
       f"src_inc AS (SELECT {_RAW_ORDERS} FROM dedupe_orders WHERE order_date > "
       "(SELECT max(last_watermark) FROM wm_state WHERE pipeline_name = 'orders_pipeline'))")
_add("src_snapshot", f"SELECT {_RAW_CUSTOMERS} FROM dedupe_customers")
ORACLE["wm_lookup"] = with_models("", extra=_WM) + \
    "SELECT pipeline_name, last_watermark FROM wm_state WHERE pipeline_name = 'orders_pipeline'"
ORACLE["src_incremental"] = with_models("", extra=_WM) + "SELECT * FROM src_inc"
ORACLE["wm_advance"] = with_models("", extra=_WM) + """
SELECT 'orders_pipeline' AS pipeline_name, coalesce((SELECT max(order_date) FROM src_inc), w.last_watermark)
       AS last_watermark,
       CASE WHEN (SELECT max(order_date) FROM src_inc) IS NOT NULL THEN TIMESTAMP '2026-07-02 00:00:00'
            ELSE w.updated_at END AS updated_at
FROM wm_state w"""

_add("bronze_all_batches", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, batch_date, count(*) AS row_count FROM b_{t} GROUP BY batch_date"
    for t in ["customers", "products", "stores", "orders", "order_items", "payments"]))
_add("latest_batch", "SELECT * FROM b_orders WHERE batch_date = (SELECT max(batch_date) FROM b_orders)")
_add("bronze_lineage", f"""
SELECT {_RAW_ORDERS}, TIMESTAMP '2026-07-02 01:00:00' AS ingestion_timestamp,
       DATE '2026-07-02' AS batch_date, 'postgres' AS source_system, 'fixture' AS source_file
FROM dedupe_orders""")
_add("append_by_name", """
SELECT * FROM stg_orders
UNION ALL
SELECT order_id, customer_id, store_id, order_date, order_status, currency_code,
       cast(NULL AS double) AS exchange_rate, created_at, ingestion_timestamp, batch_date,
       source_system, source_file, cast(NULL AS date) AS load_date
FROM silver_orders""")

# ------------------------------------------------------------------ late rows, tables, price invariance
ORACLE["src_late_rows"] = with_models("", extra=_WM) + """
SELECT s.* FROM (
  SELECT order_id, customer_id, store_id, order_date, order_status, currency_code, created_at FROM dedupe_orders) s
WHERE s.order_date > (SELECT max(last_watermark) FROM wm_state)
   OR (s.order_date > (SELECT max(last_watermark) - INTERVAL 180 DAY FROM wm_state)
       AND NOT EXISTS (
         SELECT 1 FROM b_orders b
         WHERE b.batch_date = (SELECT min(batch_date) FROM b_orders) AND b.order_id % 97 <> 5
           AND b.order_id = s.order_id AND b.order_date = s.order_date AND b.created_at = s.created_at
           AND b.customer_id IS NOT DISTINCT FROM s.customer_id AND b.store_id IS NOT DISTINCT FROM s.store_id
           AND b.order_status IS NOT DISTINCT FROM s.order_status
           AND b.currency_code IS NOT DISTINCT FROM s.currency_code))"""
_add("fact_sales_tables", "SELECT * FROM fact_sales")
_FIRST = "(SELECT min(batch_date) FROM b_products)"
_PRICES = f"""
  p1 AS (SELECT * FROM b_products WHERE batch_date = {_FIRST}),
  p2 AS (SELECT b.product_id, coalesce(c.unit_cost, b.unit_cost) AS unit_cost, b.unit_price,
                coalesce(c.updated_at, b.updated_at) AS updated_at
         FROM p1 b LEFT JOIN (SELECT * FROM b_products WHERE batch_date > {_FIRST}) c USING (product_id)),
  f0 AS (SELECT f.* FROM latest_order_items f JOIN latest_orders o USING (order_id)
         WHERE o.customer_id IN (SELECT customer_id FROM dim_customer)
           AND o.store_id IN (SELECT store_id FROM dim_store)),
  f1 AS (SELECT f0.*, line_total - quantity * unit_cost_at_sale AS profit FROM f0
         WHERE product_id IN (SELECT product_id FROM p1)),
  f2 AS (SELECT f0.*, line_total - quantity * unit_cost_at_sale AS profit FROM f0
         WHERE product_id IN (SELECT product_id FROM p2))"""


def _changed(table: str, old: str, new: str, key: str, columns: list[tuple[str, str]]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{name}' AS column_name, count(a.{key} + b.{key}) AS compared, "
        f"count(*) FILTER (a.{key} IS NULL) AS added, count(*) FILTER (b.{key} IS NULL) AS removed, "
        f"count(*) FILTER (a.{key} IS NOT NULL AND b.{key} IS NOT NULL AND a.{col} IS DISTINCT FROM b.{col}) AS changed "
        f"FROM {old} a FULL JOIN {new} b ON a.{key} = b.{key}" for name, col in columns)


ORACLE["price_invariance"] = with_models(
    _changed("dim_product", "p1", "p2", "product_id", [(c, c) for c in ("unit_cost", "unit_price", "updated_at")])
    + " UNION ALL "
    + _changed("fact_sales", "f1", "f2", "order_item_id", [
        ("unit_cost", "unit_cost_at_sale"), ("line_total", "line_total"), ("profit", "profit")]), extra=_PRICES)

# ------------------------------------------------------------------ written zones
_add("bronze_from_landing", """
SELECT order_item_id, order_id, product_id, quantity, unit_price_at_sale, unit_cost_at_sale, discount_amount,
       line_total, created_at, TIMESTAMP '2026-07-02 01:00:00' AS ingestion_timestamp, DATE '2026-07-02' AS batch_date,
       'postgres' AS source_system, 'order_items/batch_date=2026-07-02' AS source_file
FROM dedupe_order_items""")
_TABLES = ["customers", "products", "stores", "orders", "order_items", "payments"]


def _rows_of(names: dict[str, str]) -> str:
    return " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {frm}" for t, frm in names.items())


_add("published_batch", _rows_of({t: f"dedupe_{t}" for t in _TABLES}
                                 | {"fx_rates": "fx_rates_typed WHERE exchange_rate IS NOT NULL"}))
_add("silver_zone", _rows_of({t: f"silver_{t}" for t in _TABLES} | {"reject_customers": "reject_customers"}))
_add("streamed_silver", f"SELECT {_RAW_CUSTOMERS}, batch_date FROM dedupe_customers")
_add("mart_from_views", """
SELECT d.date_key, d.year, d.month_name, d.day_name, m.total_orders, m.total_items_sold, m.total_revenue
FROM dim_date d LEFT JOIN (
  SELECT date_key, count(DISTINCT order_id) AS total_orders, cast(sum(quantity) AS bigint) AS total_items_sold,
         """ + sum_money("line_total") + """ AS total_revenue
  FROM fact_sales GROUP BY date_key) m USING (date_key)""")
