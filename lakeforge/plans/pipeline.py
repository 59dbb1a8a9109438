"""One daily run as a single Spark application, zone by zone.

    extract (snapshot / increment) -> land CSV -> gate -> publish to raw -> bronze parquet
      -> silver parquet (+ quarantine) -> staging (append by name)
      -> dimensions, fact, marts -> expectations -> advance watermark

Every hand-off between zones is a written parquet/CSV dataset under
``root``: lineage is cut at each zone (an executor lost late in the run only
recomputes from the last written zone). Nothing reaches the raw zone before the gate has
passed. Running a published batch again starts from its raw folders, and replaces its
partitions of the later zones with the same rows, also when newer batches are there.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.quality import CORE_EXPECTATIONS, check_batch, run_expectations
from ..schemas import (CSV_OPTIONS, FX_PAYLOAD_SCHEMA, FX_RAW_SCHEMA, RAW_REQUIRED_ORDER_COLUMNS, RAW_SCHEMAS, SPECS,
                       staging_schema)
from ..session import delete_path, list_names, path_exists
from ..sinks.publish import Batch, publish, published, record, watermark_before
from ..sinks.writers import align_by_name, land_csv, replace_partition, write_full, write_observed, write_ordered
from ..sources.extract import read_incremental, read_with_lookback
from ..sources.files import batch_path, read_bronze, read_corrupt_count, read_landed, read_raw_csv
from ..sources.fx import STATUS_DEGRADED, STATUS_SUCCESS, fx_rows, latest_good_fx
from ..sources.watermark import advance_watermark, read_state, write_state
from .bronze import run_bronze
from .registry import Context, parquet_context
from .silver import SILVER_OUTPUTS

ORDERS_PIPELINE = "orders_pipeline"
CORE_MODELS = ["dim_customer", "dim_product", "dim_store", "dim_date", "fact_sales"]
FX_TABLE, FX_PAYLOAD, FX_STATUS = "currency", "currency_payload", "currency_status"
MART_MODELS = ["gold_sales_analytics", "gold_customer_analytics", "gold_product_analytics"]

# marts that are written in the order of a column (product marts are ordered at read time)
MART_ORDER = {"gold_sales_analytics": ["date_key"]}


@dataclass
class Zones:
    root: str

    @property
    def published(self) -> str:
        return f"{self.state}/published"

    def __getattr__(self, name: str) -> str:  # landing, raw, bronze, silver, reject, staging, gold, state
        return f"{self.root.rstrip('/')}/{name}"


def extract_and_land(spark: SparkSession, source: Callable[[str], DataFrame], zones: Zones, batch_date: str,
                     done: Batch | None = None, lookback: str | None = None) -> dict:
    """Full snapshots of five tables and the orders increment, landed as CSV.

    The orders increment is read past the high-water mark of the batches before this one;
    for a batch that was published before (``done``) also up to its own. With ``lookback``
    (an interval, e.g. "3 days") rows that came late and changes inside it are read too.
    The source orders are read once: the landing write counts them and takes their
    newest date, and a landing without rows is removed again.
    """
    for t in SPECS:
        if t != "orders":
            land_csv(source(t).select(*RAW_SCHEMAS[t].fieldNames()), zones.landing, t, batch_date,
                     sort_by=[SPECS[t].key])
    low = done.low if done else watermark_before(spark, zones.published, batch_date)
    # as a landing has them: empty texts are nulls
    orders = source("orders").select(*[
        F.nullif(F.col(f.name), F.lit("")).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
        for f in RAW_SCHEMAS["orders"].fields])
    if done is not None:
        orders = (orders.where(F.col("order_date") <= F.lit(done.high).cast("timestamp_ntz"))
                  if done.high else orders.where(F.lit(False)))
    if lookback:
        earlier = read_bronze(spark, zones.bronze, "orders").where(F.col("batch_date") < F.lit(batch_date).cast("date"))
        orders = read_with_lookback(orders, "order_id", "order_date", low, lookback, earlier, ["batch_date"])
    else:
        orders = read_incremental(orders, "order_date", low)
    landed = Observation("landed_orders")
    path = land_csv(orders.observe(landed, F.count(F.lit(1)).alias("rows"), F.max("order_date").alias("newest")),
                    zones.landing, "orders", batch_date, sort_by=["order_date"])
    has_orders = landed.get["rows"] > 0
    if not has_orders:
        delete_path(spark, path)
    reached = [x for x in (low, landed.get["newest"]) if x is not None]
    return {"low": low, "high": max(reached, default=None), "has_orders": has_orders}


def land_fx(spark: SparkSession, snapshots: DataFrame, zones: Zones, batch_date: str) -> str:
    """Land the newest good snapshot up to the batch date: its rates as CSV, its payload and
    the feed's status as JSON; returns the status.

    SUCCESS is the day's own snapshot, DEGRADED an older one; without any this raises.
    """
    day = spark.createDataFrame([(batch_date,)], "d string").select(F.col("d").cast("date").alias("batch_date"))
    picked = latest_good_fx(day, snapshots, strict=True)
    (fx_rows(picked).withColumn("exchange_rate", F.col("exchange_rate").cast("string"))
     .write.mode("overwrite").options(**CSV_OPTIONS).csv(batch_path(zones.landing, FX_TABLE, batch_date)))
    picked.select("payload").write.mode("overwrite").text(batch_path(zones.landing, FX_PAYLOAD, batch_date))
    status = picked.select(F.col("fx_status").alias("status"), F.col("snapshot_date").cast("string"))
    status.write.mode("overwrite").json(batch_path(zones.landing, FX_STATUS, batch_date))
    return status.first()[0]


def check_feed(spark: SparkSession, zones: Zones, batch_date: str) -> DataFrame:
    """Checks of the landed feed as ``check_batch`` rows: the payload parses and has rates, and
    the status is one that lets the batch go on."""
    schema = T.StructType.fromDDL(FX_PAYLOAD_SCHEMA)
    payload = batch_path(zones.landing, FX_PAYLOAD, batch_date)
    corrupt = read_corrupt_count(spark, payload, schema, fmt="json").first()["corrupt_rows"]
    rates = spark.read.schema(schema).json(payload).where(F.size("rates") > 0)
    status = spark.read.schema("status string").json(batch_path(zones.landing, FX_STATUS, batch_date))
    status = status.where(F.col("status").isin(STATUS_SUCCESS, STATUS_DEGRADED))
    return (check_batch(rates, "fx_payload", ["base_code", "rates"]).withColumn("passed", F.col("passed") & F.lit(corrupt == 0))
            .unionByName(check_batch(status, "fx_status", ["status"])))


def gate(spark: SparkSession, zones: Zones, batch_date: str, has_orders: bool, fx_path: str,
         feed: bool = False) -> DataFrame:
    """Raw checks of the landed batch and the FX rows; raises if a mandatory one fails.

    With ``feed`` the feed's payload and status have landed too and are checked.

    The files are read as text under the names of their header, so a column that is
    missing there is reported as missing.
    """
    parts = []
    for t in SPECS:
        if t == "orders" and not has_orders:
            parts.append(check_batch(None, t, RAW_REQUIRED_ORDER_COLUMNS, optional=True))
            continue
        df = read_landed(spark, batch_path(zones.landing, t, batch_date))
        req = RAW_REQUIRED_ORDER_COLUMNS if t == "orders" else ()
        parts.append(check_batch(df, t, req, optional=(t == "orders")))
    corrupt = read_corrupt_count(spark, fx_path, FX_RAW_SCHEMA).first()["corrupt_rows"]
    parts.append(check_batch(read_landed(spark, fx_path), "fx_rates", FX_RAW_SCHEMA.fieldNames())
                 .withColumn("passed", F.col("passed") & F.lit(corrupt == 0)))
    if feed:
        parts.append(check_feed(spark, zones, batch_date))
    report = parts[0]
    for p in parts[1:]:
        report = report.unionByName(p)
    failed = report.where(~F.col("passed")).select("table_name").collect()  # <= 9 rows
    if failed:
        raise RuntimeError(f"raw checks failed for {[r.table_name for r in failed]}")
    return report


def publish_batch(spark: SparkSession, source: Callable[[str], DataFrame], fx_raw: DataFrame | None, zones: Zones,
                  batch_date: str, ingestion_ts: str | None = None, fx_snapshots: DataFrame | None = None,
                  lookback: str | None = None, refresh: bool = False) -> Batch:
    """Extract, land, check and publish one batch into the raw zone; returns its record.

    A batch that is published already is left as it is, unless ``refresh`` asks to read the
    source again or a folder of it is missing (a refresh that was cut off); even then the
    orders stay within the interval that the batch covers. A failed check raises and leaves
    the raw zone untouched.
    """
    done = published(spark, zones.published, batch_date)
    if done is not None and not refresh:
        held = [t for t in (*SPECS, FX_TABLE) if t != "orders" or done.has_orders]
        if all(path_exists(spark, batch_path(zones.raw, t, batch_date)) for t in held):
            return done
    landed = extract_and_land(spark, source, zones, batch_date, done, lookback)
    fx_path = batch_path(zones.landing, FX_TABLE, batch_date)
    if fx_snapshots is None:
        fx_raw.write.mode("overwrite").options(**CSV_OPTIONS).csv(fx_path)
        fx_status = "GIVEN"
    else:
        fx_status = land_fx(spark, fx_snapshots, zones, batch_date)
    feed = fx_snapshots is not None
    gate(spark, zones, batch_date, landed["has_orders"], fx_path, feed)
    mandatory = [t for t in SPECS if t != "orders"] + [FX_TABLE] + ([FX_PAYLOAD, FX_STATUS] if feed else [])
    publish(spark, zones.landing, zones.raw, batch_date, mandatory, ["orders"])
    now = spark.range(1).select(F.current_timestamp().cast("timestamp_ntz").cast("string")).first()[0]
    batch = Batch(batch_date, landed["low"], landed["high"], landed["has_orders"], fx_status,
                  (done.ingestion_ts if done else None) or ingestion_ts or now)
    record(spark, zones.published, batch)
    return batch


def run_pipeline(spark: SparkSession, source: Callable[[str], DataFrame], fx_raw: DataFrame | None,
                 root: str, batch_date: str, ingestion_ts: str | None = None,
                 fx_snapshots: DataFrame | None = None, lookback: str | None = None,
                 refresh: bool = False) -> DataFrame:
    """Run one batch end to end; returns the expectation report.

    Exchange rates are the finished rows ``fx_raw``, or come from the feed's daily
    ``fx_snapshots`` (snapshot_date, status, payload): then the last good one is used and
    its status is kept in the audit trail. ``lookback`` and ``refresh`` are those of
    ``extract_and_land`` and ``publish_batch``.
    """
    z = Zones(root)
    batch = publish_batch(spark, source, fx_raw, z, batch_date, ingestion_ts, fx_snapshots, lookback, refresh)

    # bronze: one partition per batch, with the ingestion time of its publication
    for t in SPECS:
        if t == "orders" and not batch.has_orders:
            delete_path(spark, batch_path(z.bronze, t, batch_date))
            continue
        run_bronze(spark, z.raw, z.bronze, t, batch_date, ingestion_ts=batch.ingestion_ts)

    # silver: all bronze batches -> latest per key, cleansed; full overwrite. Bronze of an older
    # batch is what it was, so silver is too, and only that batch's load is made again
    ctx = parquet_context(spark, z.bronze, batch_path(z.raw, FX_TABLE, batch_date))
    batches = {n.removeprefix("batch_date=") for t in SPECS for n in list_names(spark, f"{z.bronze}/{t}")
               if n.startswith("batch_date=")}
    newest = batch_date >= max(batches)
    if newest or refresh:
        counts = {}
        for t, m in SILVER_OUTPUTS.items():
            counts[f"silver_{t}"] = write_observed(ctx.ref(m), f"{z.silver}/{t}", f"silver_{t}")
        counts["reject_customers"] = write_observed(ctx.ref("reject_customers"),
                                                    f"{z.reject}/customers", "reject_customers")
        # audit trail of the run: rows written per silver output, one partition per batch
        audit = spark.createDataFrame(sorted(counts.items()), "table_name string, row_count bigint")
        replace_partition(audit.withColumn("fx_status", F.lit(batch.fx_status)), f"{z.state}/layer_counts", batch_date)

    # staging: append this load by name into the declared columns (one partition per load
    # date, rerun-safe)
    for t in SPECS:
        loaded = (spark.read.parquet(f"{z.silver}/{t}") if newest
                  else ctx.as_of(batch_date).ref(SILVER_OUTPUTS[t]))
        replace_partition(align_by_name(loaded, staging_schema(t)), f"{z.staging}/{t}", batch_date, "load_date")

    def staging_loader(t: str) -> DataFrame:
        return spark.read.schema(staging_schema(t)).parquet(f"{z.staging}/{t}")

    core = Context(spark, ctx.bronze, {"staging_loader": staging_loader})
    for m in CORE_MODELS:
        write_full(core.ref(m), f"{z.gold}/{m}")
    written = Context(spark, ctx.bronze, {"staging_loader": staging_loader})
    for m in CORE_MODELS:
        written._cache[m] = spark.read.parquet(f"{z.gold}/{m}")
    for m in MART_MODELS:
        if m in MART_ORDER:
            write_ordered(written.ref(m), f"{z.gold}/{m}", MART_ORDER[m])
        else:
            write_full(written.ref(m), f"{z.gold}/{m}")

    report = run_expectations(written.ref, CORE_EXPECTATIONS)
    # all zones done: only now move the orders high-water mark
    if batch.has_orders:
        raw = read_raw_csv(spark, z.raw, "orders", batch_date)
        state = read_state(spark, z.state + "/etl_watermark")
        write_state(advance_watermark(state, raw, ORDERS_PIPELINE, "order_date"), z.state + "/etl_watermark")
    return report
