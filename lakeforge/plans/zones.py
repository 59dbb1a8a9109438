"""Queries that take the source tables through written zones and read them back: landing,
publishing, bronze, silver, quarantine, views and streams. Each writes below a folder of its
own in the cluster's shared checkpoint folder."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import RAW_SCHEMAS, SPECS
from ..session import scratch_path
from ..sinks.writers import land_csv, write_keyed, write_ordered
from ..sources.files import batch_path, read_bronze, read_landed, read_raw_csv, read_silver
from ..sources.fx import fx_rates_typed
from ..streaming.ingest import read_current, stream_bronze, stream_silver
from .bronze import run_bronze
from .catalog import entry
from .pipeline import FX_TABLE, Zones, publish_batch
from .registry import Context, register_views
from .silver import SILVER_OUTPUTS

BATCH = "2026-07-02"
INGESTED = "2026-07-02 01:00:00"


def _folder(ctx: Context, name: str) -> str:
    return scratch_path(ctx.spark, f"{name}-{uuid.uuid4().hex}")


def _source(ctx: Context, table: str) -> DataFrame:
    """The source system's rows: the newest version per key, no lineage."""
    return ctx.ref(f"dedupe_{table}").select(*RAW_SCHEMAS[table].fieldNames())


def _counted(parts: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(t).alias("table_name"), "row_count")
        for t, df in parts.items()])


@entry("bronze_from_landing")
def bronze_from_landing(ctx: Context) -> DataFrame:
    """Order items landed as CSV, read back by header into bronze with their lineage."""
    zones = Zones(_folder(ctx, "bronze-zones"))
    land_csv(_source(ctx, "order_items"), zones.raw, "order_items", BATCH, sort_by=["order_item_id"])
    run_bronze(ctx.spark, zones.raw, zones.bronze, "order_items", BATCH, ingestion_ts=INGESTED)
    folder = F.regexp_extract("source_file", r"raw/(.*)/[^/]*$", 1)
    return read_bronze(ctx.spark, zones.bronze, "order_items").withColumn("source_file", folder)


@entry("published_batch")
def published_batch(ctx: Context) -> DataFrame:
    """Rows per table of a batch that landed, passed the gate and was published: rows whose
    key, and rates whose value, read back as their type."""
    zones = Zones(_folder(ctx, "published-zones"))
    publish_batch(ctx.spark, lambda t: _source(ctx, t), ctx.source("fx_rates"), zones, BATCH, ingestion_ts=INGESTED)
    raw = {t: read_raw_csv(ctx.spark, zones.raw, t, BATCH).where(F.col(SPECS[t].key).isNotNull()) for t in SPECS}
    rates = fx_rates_typed(read_landed(ctx.spark, batch_path(zones.raw, FX_TABLE, BATCH)))
    return _counted(raw | {"fx_rates": rates.where("exchange_rate is not null")})


@entry("silver_zone")
def silver_zone(ctx: Context) -> DataFrame:
    """Rows per dataset of the written silver zone and its quarantine, each written twice."""
    zones = Zones(_folder(ctx, "silver-zones"))
    for _ in range(2):  # the second write replaces the first
        for t, m in SILVER_OUTPUTS.items():
            write_keyed(ctx.ref(m), f"{zones.silver}/{t}")
        write_keyed(ctx.ref("reject_customers"), f"{zones.reject}/customers")
    return _counted({t: read_silver(ctx.spark, zones.silver, t) for t in SPECS}
                    | {"reject_customers": read_silver(ctx.spark, zones.reject, "customers")})


@entry("streamed_silver")
def streamed_silver(ctx: Context) -> DataFrame:
    """Customers streamed batch by batch from landed CSV into bronze and silver."""
    zones = Zones(_folder(ctx, "stream-zones"))
    source = ctx.source("customers")
    for (day,) in sorted(source.select(F.col("batch_date").cast("string")).distinct().collect()):  # a row per batch
        batch = source.where(F.col("batch_date") == F.lit(day).cast("date"))
        land_csv(batch.select(*RAW_SCHEMAS["customers"].fieldNames()), zones.raw, "customers", day)
        stream_bronze(ctx.spark, zones.raw, zones.bronze, "customers", f"{zones.state}/bronze").awaitTermination()
        stream_silver(ctx.spark, zones.bronze, zones.silver, "customers", f"{zones.state}/silver").awaitTermination()
    return read_current(ctx.spark, zones.silver, "customers").select(*RAW_SCHEMAS["customers"].fieldNames(), "batch_date")


@entry("mart_from_views")
def mart_from_views(ctx: Context) -> DataFrame:
    """The daily mart, written in order and read through views of the mart and its calendar."""
    prefix = f"v{uuid.uuid4().hex}_"
    path = f"{_folder(ctx, 'mart')}/gold_sales_analytics"
    write_ordered(ctx.ref("gold_sales_analytics"), path, ["date_key"])
    ctx.spark.read.parquet(path).createOrReplaceTempView(f"{prefix}mart")
    register_views(ctx, ["dim_date"], prefix)
    return ctx.spark.sql(f"""
        SELECT d.date_key, d.year, d.month_name, d.day_name, m.total_orders, m.total_items_sold, m.total_revenue
        FROM {prefix}dim_date d LEFT JOIN {prefix}mart m ON m.date_key = d.date_key""")

