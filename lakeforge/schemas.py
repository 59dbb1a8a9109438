"""Table schemas and per-table specs of the retail model."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

LINEAGE = ["ingestion_timestamp", "batch_date", "source_system", "source_file"]

LINEAGE_FIELDS = [
    T.StructField("ingestion_timestamp", T.TimestampNTZType()),
    T.StructField("batch_date", T.DateType()),
    T.StructField("source_system", T.StringType()),
    T.StructField("source_file", T.StringType()),
]


def _s(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields])


TS = T.TimestampNTZType()
M2 = T.DecimalType(10, 2)
M4 = T.DecimalType(18, 4)

# --- fixed values: raw (source) schemas, what the extract lands before lineage ---
RAW_SCHEMAS: dict[str, T.StructType] = {
    "customers": _s(("customer_id", T.LongType()), ("first_name", T.StringType()),
                    ("last_name", T.StringType()), ("email", T.StringType()),
                    ("phone", T.StringType()), ("address", T.StringType()),
                    ("city", T.StringType()), ("state", T.StringType()),
                    ("country", T.StringType()), ("signup_date", T.DateType()),
                    ("is_active", T.BooleanType()), ("created_at", TS), ("updated_at", TS)),
    "products": _s(("product_id", T.LongType()), ("product_name", T.StringType()),
                   ("category", T.StringType()), ("sub_category", T.StringType()),
                   ("unit_price", M2), ("unit_cost", M4), ("is_active", T.BooleanType()),
                   ("created_at", TS), ("updated_at", TS)),
    "stores": _s(("store_id", T.LongType()), ("store_name", T.StringType()),
                 ("store_type", T.StringType()), ("store_size", T.StringType()),
                 ("region", T.StringType()), ("country", T.StringType()),
                 ("opened_date", T.DateType()), ("created_at", TS)),
    "orders": _s(("order_id", T.LongType()), ("customer_id", T.LongType()),
                 ("store_id", T.LongType()), ("order_date", TS),
                 ("order_status", T.StringType()), ("currency_code", T.StringType()),
                 ("created_at", TS)),
    "order_items": _s(("order_item_id", T.LongType()), ("order_id", T.LongType()),
                      ("product_id", T.LongType()), ("quantity", T.IntegerType()),
                      ("unit_price_at_sale", M2), ("unit_cost_at_sale", M4),
                      ("discount_amount", M4), ("line_total", M4), ("created_at", TS)),
    "payments": _s(("payment_id", T.LongType()), ("order_id", T.LongType()),
                   ("payment_method", T.StringType()), ("payment_status", T.StringType()),
                   ("amount", T.DecimalType(12, 2)), ("currency_code", T.StringType()),
                   ("payment_date", TS), ("created_at", TS)),
}

# --- end of fixed values -------------------------------------------------------

#: Landed CSV: what is written reads back alike, blanks at the ends, quotes, backslashes and
#: line feeds included (a file is then read by one task; a landing has as many files as tasks).
#: Only an empty text can't be told from a null there, and is one.
CSV_OPTIONS = {"header": True, "escape": '"', "multiLine": True, "ignoreLeadingWhiteSpace": False,
               "ignoreTrailingWhiteSpace": False}

FX_RAW_SCHEMA = _s(("base_currency", T.StringType()), ("target_currency", T.StringType()),
                   ("exchange_rate", T.StringType()), ("last_updated", T.StringType()))

FX_PAYLOAD_SCHEMA = "base_code string, time_last_update_utc string, rates map<string,double>"


def bronze_schema(table: str) -> T.StructType:
    return T.StructType(RAW_SCHEMAS[table].fields + LINEAGE_FIELDS)


@dataclass(frozen=True)
class TableSpec:
    """How the silver layer treats one table."""
    name: str
    key: str
    order_by: tuple[str, ...] = ("ingestion_timestamp",)
    tie_breakers: tuple[str, ...] = ()
    mandatory: tuple[str, ...] = ()
    staging: tuple[str, ...] = field(default_factory=tuple)


# --- fixed values: staging projections and mandatory columns ------------------
ORDER_MANDATORY = ("order_id", "customer_id", "store_id", "order_date", "order_status",
                   "currency_code", "created_at", "ingestion_timestamp", "batch_date",
                   "source_system", "source_file")
RAW_REQUIRED_ORDER_COLUMNS = ("order_id", "customer_id", "store_id", "order_date",
                              "order_status", "currency_code")

SPECS: dict[str, TableSpec] = {
    "customers": TableSpec(
        "customers", "customer_id",
        staging=("customer_id", "first_name", "last_name", "email", "phone", "address", "city",
                 "state", "country", "signup_date", "is_active", "created_at", "updated_at",
                 *LINEAGE)),
    "products": TableSpec(
        "products", "product_id",
        staging=("product_id", "product_name", "category", "sub_category", "unit_price",
                 "unit_cost", "is_active", "created_at", "updated_at", *LINEAGE)),
    "stores": TableSpec(
        "stores", "store_id",
        staging=("store_id", "store_name", "store_type", "store_size", "region", "country",
                 "opened_date", "created_at", *LINEAGE)),
    "orders": TableSpec(
        "orders", "order_id", mandatory=ORDER_MANDATORY,
        staging=("order_id", "customer_id", "store_id", "order_date", "order_status",
                 "currency_code", "exchange_rate", "created_at", *LINEAGE)),
    "order_items": TableSpec(
        "order_items", "order_item_id", tie_breakers=("product_id",),
        staging=("order_item_id", "order_id", "product_id", "quantity", "unit_price_at_sale",
                 "unit_cost_at_sale", "discount_amount", "line_total", "created_at", *LINEAGE)),
    "payments": TableSpec(
        "payments", "payment_id",
        staging=("payment_id", "order_id", "payment_method", "payment_status", "amount",
                 "currency_code", "payment_date", "created_at", *LINEAGE)),
}
# --- end of fixed values -------------------------------------------------------

SOURCE_TABLES = tuple(SPECS)


def staging_schema(table: str) -> T.StructType:
    """Declared columns of a staging table: its projection and the date of the load."""
    types = {f.name: f.dataType for f in bronze_schema(table).fields}
    types["exchange_rate"] = T.DoubleType()
    return T.StructType([T.StructField(c, types[c]) for c in SPECS[table].staging]
                        + [T.StructField("load_date", T.DateType())])
