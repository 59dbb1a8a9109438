"""DuckDB SQL mirrors of the models, used as the correctness oracle.

Every query is ``WITH <adapter and model CTEs> SELECT ...`` over the
pre-registered test views (``customer``, ``orders``, ``lineitem``, ...). The
adapter column expressions come from ``lakeforge.sources.fixtures`` (common
subset of both dialects); everything after the adapters is written here in
DuckDB SQL independently of the Spark code.
"""

from __future__ import annotations

from lakeforge.functions.cleanse import EMAIL_PATTERN, PHONE_STRIP_PATTERN, STATE_CANONICAL
from lakeforge.schemas import SPECS
from lakeforge.sources import fixtures as FX


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def initcap(e: str) -> str:
    """Spark's initcap: words split on single spaces, first letter upper, rest lower."""
    return (f"array_to_string(list_transform(string_split({e}, ' '), "
            f"lambda w: upper(w[1]) || lower(w[2:])), ' ')")


def clean_name(e: str) -> str:
    return initcap(f"trim({e})")


def canonical_state(e: str) -> str:
    norm = f"lower(replace({e}, ' ', ''))"
    whens = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in STATE_CANONICAL.items())
    return f"CASE {norm} {whens} ELSE {clean_name(e)} END"


def email_valid(e: str) -> str:
    return f"regexp_matches({e}, {q(EMAIL_PATTERN)})"


PAYMENT_METHOD_NORM = "replace(trim(payment_method), '_', ' ')"

SUM_MONEY = "cast(sum(cast({c} AS decimal(18,4))) AS double)"
AVG_MONEY = "(cast(sum(cast({c} AS decimal(18,4))) AS double) / count({c}))"


def sum_money(c: str) -> str:
    return SUM_MONEY.format(c=c)


def avg_money(c: str) -> str:
    return AVG_MONEY.format(c=c)


_BASE_FROM = {
    "customers": ("customer JOIN nation ON c_nationkey = n_nationkey", "c_custkey"),
    "products": ("part", "p_partkey"),
    "stores": ("supplier JOIN nation ON s_nationkey = n_nationkey "
               "JOIN region ON n_regionkey = r_regionkey", "s_suppkey"),
    "orders": ("orders", "o_orderkey"),
    "payments": ("orders", "o_orderkey"),
    "order_items": ("lineitem", None),
}


def adapter_cte(name: str) -> str:
    frm, vkey = _BASE_FROM[name]
    cols = ",\n    ".join(f"{e} AS {n}" for n, e in FX.columns(name, "timestamp"))
    if vkey:
        src = (f"(SELECT *, 1 AS v FROM {frm} UNION ALL "
               f"SELECT *, 2 AS v FROM {frm} WHERE {vkey} % 10 = 0)")
    else:
        src = f"(SELECT * FROM {frm})"
    return f"b_{name} AS (\n  SELECT\n    {cols}\n  FROM {src} src\n)"


def _fx_raw_cte() -> str:
    vals = ", ".join(f"({q(FX.FX_BASE)}, {q(t)}, {q(r)}, {q(FX.FX_LAST_UPDATED)})"
                     for t, r in FX.FX_RATES)
    return (f"fx_raw AS (SELECT * FROM (VALUES {vals}) "
            f"t(base_currency, target_currency, exchange_rate, last_updated))")


def _dedupe(table: str, load: str, until: str) -> str:
    spec = SPECS[table]
    order = ", ".join(f"{c} DESC NULLS LAST" for c in (*spec.order_by, *spec.tie_breakers))
    return (f"dedupe{load}_{table} AS (SELECT * FROM b_{table} WHERE batch_date <= DATE '{until}' "
            f"QUALIFY row_number() OVER (PARTITION BY {spec.key} ORDER BY {order}) = 1)")


def _loads() -> list[tuple[str, str]]:
    """(suffix of the model names, date) per load; the last load has the plain names."""
    dates = FX.LOAD_DATES
    return [(str(i + 1), d) for i, d in enumerate(dates[:-1])] + [("", dates[-1])]


def _stg(table: str) -> str:
    cols = ", ".join(SPECS[table].staging)
    parts = [f"SELECT {cols}, DATE '{d}' AS load_date FROM silver{n}_{table}" for n, d in _loads()]
    return f"stg_{table} AS ({' UNION ALL '.join(parts)})"


def _newest(table: str, key: str, *order: str) -> str:
    """Subquery: of each key the row with the greatest order columns."""
    return f"(SELECT unnest(max_by(t, row({', '.join(order)}))) FROM {table} t GROUP BY {key})"


def _silver(n: str, until: str) -> list[str]:
    mand = " AND ".join(f"{c} IS NOT NULL" for c in SPECS["orders"].mandatory)
    return [_dedupe(t, n, until) for t in SPECS] + [
        f"orders{n}_mandatory AS (SELECT * FROM dedupe{n}_orders WHERE {mand})",
        f"silver{n}_orders AS (SELECT o.*, r.exchange_rate FROM orders{n}_mandatory o "
        "LEFT JOIN fx_rates_typed r ON o.currency_code = r.target_currency)",
        f"clean{n}_customers AS (SELECT * REPLACE ("
        f"{clean_name('first_name')} AS first_name, {clean_name('last_name')} AS last_name, "
        f"{canonical_state('state')} AS state, {clean_name('country')} AS country, "
        f"regexp_replace(phone, {q(PHONE_STRIP_PATTERN)}, '', 'g') AS phone) "
        f"FROM dedupe{n}_customers)",
        f"silver{n}_customers AS (SELECT * FROM clean{n}_customers WHERE {email_valid('email')})",
        f"silver{n}_products AS (SELECT * REPLACE ({clean_name('product_name')} AS product_name, "
        f"{clean_name('category')} AS category) FROM dedupe{n}_products)",
        f"silver{n}_stores AS (SELECT * REPLACE ({clean_name('store_name')} AS store_name, "
        f"{clean_name('region')} AS region, {clean_name('country')} AS country) FROM dedupe{n}_stores)",
        f"silver{n}_order_items AS (SELECT * FROM dedupe{n}_order_items)",
        f"silver{n}_payments AS (SELECT * REPLACE ("
        f"{initcap(PAYMENT_METHOD_NORM)} AS payment_method) FROM dedupe{n}_payments)",
    ]


def model_ctes() -> list[str]:
    ctes = [adapter_cte(n) for n in FX.ADAPTERS] + [_fx_raw_cte()]
    ctes.append(
        "fx_rates_typed AS (SELECT target_currency, max(try_cast(exchange_rate AS double)) AS exchange_rate "
        "FROM fx_raw GROUP BY target_currency)")
    for n, until in _loads():
        ctes += _silver(n, until)
    ctes += [
        f"reject_customers AS (SELECT *, 'Invalid Email' AS reject_reason FROM clean_customers "
        f"WHERE NOT {email_valid('email')})",
        "unknown_customers AS (SELECT * FROM clean_customers WHERE email IS NULL)",
    ]
    ctes += [_stg(t) for t in SPECS]
    ctes += [
        "dim_customer AS (SELECT customer_id AS customer_key, customer_id, first_name, last_name, "
        "email, phone, address, city, state, country, signup_date, is_active, created_at, "
        "updated_at, batch_date FROM "
        + _newest("stg_customers", "customer_id", "updated_at", "ingestion_timestamp", "load_date") + ")",
        "dim_product AS (SELECT product_id AS product_key, product_id, product_name, category, "
        "sub_category, unit_price, unit_cost, is_active, created_at, updated_at, batch_date "
        "FROM " + _newest("stg_products", "product_id", "updated_at", "ingestion_timestamp", "load_date") + ")",
        "dim_store AS (SELECT store_id AS store_key, store_id, store_name, store_type, store_size, "
        "region, country, opened_date, created_at, batch_date FROM "
        + _newest("stg_stores", "store_id", "created_at", "ingestion_timestamp", "load_date") + ")",
        "dim_date AS (SELECT DISTINCT cast(order_date AS date) AS date_key, "
        "cast(order_date AS date) AS full_date, cast(year(order_date) AS integer) AS year, "
        "cast(quarter(order_date) AS integer) AS quarter, cast(month(order_date) AS integer) AS month, "
        "strftime(order_date, '%b') AS month_name, cast(day(order_date) AS integer) AS day, "
        "cast(dayofweek(order_date) AS integer) AS day_of_week, "
        "strftime(order_date, '%a') AS day_name FROM stg_orders)",
        "latest_orders AS (SELECT * FROM "
        + _newest("stg_orders", "order_id", "batch_date", "ingestion_timestamp", "load_date") + ")",
        "latest_order_items AS (SELECT * FROM "
        + _newest("stg_order_items", "order_item_id", "batch_date", "ingestion_timestamp", "load_date",
                  "product_id") + ")",
        "fact_sales AS (SELECT oi.order_item_id, o.order_id, c.customer_key, p.product_key, "
        "s.store_key, cast(o.order_date AS date) AS date_key, oi.quantity, "
        "oi.unit_price_at_sale AS unit_price, oi.unit_cost_at_sale AS unit_cost, "
        "oi.discount_amount, oi.line_total, "
        "cast(oi.line_total - oi.quantity * oi.unit_cost_at_sale AS decimal(18,4)) AS profit, "
        "o.order_status, o.currency_code, oi.batch_date "
        "FROM latest_order_items oi JOIN latest_orders o ON oi.order_id = o.order_id "
        "JOIN dim_customer c ON o.customer_id = c.customer_id "
        "JOIN dim_product p ON oi.product_id = p.product_id "
        "JOIN dim_store s ON o.store_id = s.store_id)",
    ]
    return ctes


def with_models(select: str, extra: str | None = None) -> str:
    ctes = model_ctes() + ([extra] if extra else [])
    return "WITH\n" + ",\n".join(ctes) + "\n" + select
