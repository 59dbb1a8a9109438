"""Sources, sinks, watermark, the two-batch pipeline run and streaming ingestion."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from lakeforge.operators.latest import latest_by_key
from lakeforge.plans.bronze import run_bronze, with_lineage
from lakeforge.plans.pipeline import run_pipeline
from lakeforge.schemas import RAW_SCHEMAS, SPECS
from lakeforge.sinks.writers import land_csv
from lakeforge.sources import fixtures
from lakeforge.sources.extract import read_incremental
from lakeforge.sources.files import latest_batch, read_bronze, read_corrupt_count, read_raw_csv
from lakeforge.sources.watermark import advance_watermark, get_watermark, STATE_SCHEMA


def test_csv_schema_enforced(spark, tmpdir_run):
    d = os.path.join(tmpdir_run, "raw", "customers", "batch_date=2026-07-01")
    os.makedirs(d)
    with open(os.path.join(d, "customers.csv"), "w") as f:
        f.write("customer_id,first_name,last_name,email,phone,address,city,state,country,"
                "signup_date,is_active,created_at,updated_at\n")
        f.write("1,a,b,a@b.com,9876543210,x,c,TN,in,2020-01-01,true,2020-01-01 00:00:00,"
                "2026-07-01 00:00:00.123\n")
        f.write("2,,b,,,x,c,KA,in,2020-01-02,false,2020-01-01 00:00:00,2026-07-01 00:00:00\n")
    df = read_raw_csv(spark, os.path.join(tmpdir_run, "raw"), "customers", "2026-07-01")
    assert dict(df.dtypes)["phone"] == "string"  # digits-only phone stays text
    rows = df.orderBy("customer_id").collect()
    assert rows[0].phone == "9876543210" and rows[1].first_name is None
    assert rows[0].updated_at == dt.datetime(2026, 7, 1, 0, 0, 0, 123000)


def test_land_bronze_idempotent(spark, tmpdir_run):
    raw, bronze = os.path.join(tmpdir_run, "raw"), os.path.join(tmpdir_run, "bronze")
    src = fixtures.adapter(spark, SF_SMALL, "stores").where("batch_date = date'2026-07-01'")
    src = src.select(*RAW_SCHEMAS["stores"].fieldNames())
    for b in ["2026-07-01", "2026-07-02"]:
        land_csv(src, raw, "stores", b, sort_by=["store_id"])
        run_bronze(spark, raw, bronze, "stores", b, ingestion_ts=f"{b} 01:00:00")
    # rerun of one batch replaces only that batch
    run_bronze(spark, raw, bronze, "stores", "2026-07-02", ingestion_ts="2026-07-02 02:00:00")
    df = read_bronze(spark, bronze, "stores")
    counts = {r.batch_date: r.n for r in df.groupBy("batch_date").agg(F.count("*").alias("n")).collect()}
    assert counts == {dt.date(2026, 7, 1): src.count(), dt.date(2026, 7, 2): src.count()}
    lb = latest_batch(df)
    assert lb.select("batch_date").distinct().collect()[0][0] == dt.date(2026, 7, 2)
    assert lb.select(F.max("ingestion_timestamp")).collect()[0][0] == dt.datetime(2026, 7, 2, 2, 0)
    assert df.select("source_file").first()[0].endswith(".csv")


def test_corrupt_record_count(spark, tmpdir_run):
    p = os.path.join(tmpdir_run, "fx.json")
    with open(p, "w") as f:
        f.write('{"base_code": "USD", "time_last_update_utc": "t", "rates": {"INR": 83.0}}\n')
        f.write('{not json\n')
    from lakeforge.schemas import FX_PAYLOAD_SCHEMA
    from pyspark.sql.types import _parse_datatype_string
    r = read_corrupt_count(spark, p, _parse_datatype_string(FX_PAYLOAD_SCHEMA), fmt="json").collect()[0]
    assert (r.rows, r.corrupt_rows) == (2, 1)


def test_watermark_lookup_and_advance(spark):
    state = spark.createDataFrame([], STATE_SCHEMA)
    orders = spark.createDataFrame(
        [(1, dt.datetime(2026, 1, 1)), (2, dt.datetime(2026, 1, 5))], "id int, order_date timestamp_ntz")
    # no state row: full load
    assert read_incremental(orders, "order_date", get_watermark(state, "p")).count() == 2
    s1 = advance_watermark(state, orders, "p", "order_date", updated_at="2026-01-06 00:00:00")
    assert get_watermark(s1, "p").collect()[0].last_watermark == dt.datetime(2026, 1, 5)
    # strict '>' : nothing new
    inc = read_incremental(orders, "order_date", get_watermark(s1, "p"))
    assert inc.count() == 0
    # an empty batch keeps the previous watermark and timestamp
    s2 = advance_watermark(s1, inc, "p", "order_date", updated_at="2026-01-07 00:00:00")
    r = s2.collect()[0]
    assert (r.last_watermark, r.updated_at) == (dt.datetime(2026, 1, 5), dt.datetime(2026, 1, 6))


def test_lineage_constant_timestamp(spark):
    df = with_lineage(spark.range(3), "2026-07-01", source_file="f")
    assert df.select("ingestion_timestamp").distinct().count() == 1
    assert df.select("batch_date").first()[0] == dt.date(2026, 7, 1)


def _source_at(spark, version_date):
    """OLTP state as of a batch: newest version per key up to that batch date."""
    def source(t):
        df = fixtures.adapter(spark, SF_SMALL, t)
        if t != "order_items":
            df = df.where(F.col("batch_date") <= F.lit(version_date).cast("date"))
        spec = SPECS[t]
        df = latest_by_key(df, spec.key, list(spec.order_by), list(spec.tie_breakers))
        return df.select(*RAW_SCHEMAS[t].fieldNames())
    return source


def test_pipeline_two_batches(spark, tmpdir_run):
    root = os.path.join(tmpdir_run, "lake")
    good = '{"base_code": "USD", "time_last_update_utc": "Wed, 01 Jul 2026 00:00:01 +0000", "rates": {"INR": 83.25}}'
    feed = spark.createDataFrame(
        [(dt.date(2026, 7, 1), "SUCCESS", good), (dt.date(2026, 7, 1), "SUCCESS", good),
         (dt.date(2026, 7, 2), "FAILED", None)], "snapshot_date date, status string, payload string")
    rep1 = run_pipeline(spark, _source_at(spark, "2026-07-01"), None, root, "2026-07-01",
                        ingestion_ts="2026-07-01 01:00:00", fx_snapshots=feed)
    assert all(r.passed for r in rep1.collect())
    # keep the first run's fact: the second run overwrites the gold zone
    spark.read.parquet(f"{root}/gold/fact_sales").write.parquet(f"{tmpdir_run}/fact1")
    fact1 = spark.read.parquet(f"{tmpdir_run}/fact1")
    assert fact1.count() > 0
    rep2 = run_pipeline(spark, _source_at(spark, "2026-07-02"), None, root, "2026-07-02",
                        ingestion_ts="2026-07-02 01:00:00", fx_snapshots=feed)
    audit = spark.read.parquet(f"{root}/state/layer_counts")
    status = {r.batch_date: r.fx_status for r in audit.select("batch_date", "fx_status").distinct().collect()}
    assert status == {dt.date(2026, 7, 1): "SUCCESS", dt.date(2026, 7, 2): "DEGRADED"}
    rates = spark.read.parquet(f"{root}/silver/orders").select("currency_code", "exchange_rate").distinct()
    assert {r.currency_code: r.exchange_rate for r in rates.collect()}["INR"] == 83.25
    assert all(r.passed for r in rep2.collect())
    dim = spark.read.parquet(f"{root}/gold/dim_customer")
    # customer 10 moved in the second batch: the dimension holds the new city
    moved = dim.where("customer_id = 10").collect()
    assert moved and moved[0].city.endswith("moved")
    assert dim.groupBy("customer_key").count().where("count > 1").count() == 0
    # the second run found no order newer than the watermark (strict '>')
    assert not os.path.exists(f"{root}/raw/orders/batch_date=2026-07-02")
    wm = spark.read.parquet(f"{root}/state/etl_watermark").collect()
    assert len(wm) == 1 and wm[0].pipeline_name == "orders_pipeline"
    # snapshot prices: profit of the fact does not move when product costs change
    fact2 = spark.read.parquet(f"{root}/gold/fact_sales")
    a = fact1.select("order_item_id", "profit").exceptAll(fact2.select("order_item_id", "profit"))
    assert a.count() == 0
    marts = spark.read.parquet(f"{root}/gold/gold_sales_analytics")
    assert marts.count() > 0


def test_streaming_bronze_and_silver(spark, tmpdir_run):
    from lakeforge.streaming.ingest import compact, read_current, stream_bronze, stream_silver
    raw, bronze, silver = (os.path.join(tmpdir_run, x) for x in ("raw", "bronze", "silver"))
    ck = os.path.join(tmpdir_run, "ck")
    cust = fixtures.adapter(spark, SF_SMALL, "customers")
    for b in ["2026-07-01", "2026-07-02"]:
        land_csv(cust.where(F.col("batch_date") == F.lit(b).cast("date"))
                 .select(*RAW_SCHEMAS["customers"].fieldNames()), raw, "customers", b)
        q = stream_bronze(spark, raw, bronze, "customers", ck + "/b")
        q.awaitTermination()
        q = stream_silver(spark, bronze, silver, "customers", ck + "/s")
        q.awaitTermination()
    b = spark.read.parquet(f"{bronze}/customers")
    assert b.count() == cust.count()  # each landed file ingested exactly once
    cur = read_current(spark, silver, "customers")
    assert cur.count() == cust.select("customer_id").distinct().count()
    assert cur.where("customer_id = 10").first().city.endswith("moved")
    # nothing new: another run adds nothing
    stream_silver(spark, bronze, silver, "customers", ck + "/s").awaitTermination()
    assert spark.read.parquet(f"{silver}/customers").count() == cust.count()
    # compacted, then read from there and the log's later batches
    base = os.path.join(tmpdir_run, "base1")
    compact(spark, silver, "customers", base)
    late = cust.where("customer_id = 1 and batch_date = date'2026-07-01'").withColumn("city", F.lit("late"))
    land_csv(late.select(*RAW_SCHEMAS["customers"].fieldNames()), raw, "customers", "2026-07-03")
    stream_bronze(spark, raw, bronze, "customers", ck + "/b").awaitTermination()
    stream_silver(spark, bronze, silver, "customers", ck + "/s").awaitTermination()
    now, whole = (read_current(spark, silver, "customers", b) for b in (base, None))
    assert now.where("customer_id = 1").first().city == "late"
    assert now.exceptAll(whole.select(*now.columns)).count() == 0 and now.count() == whole.count() == cur.count()
    assert read_current(spark, silver, "stores") is None


def test_landed_csv_is_read_by_name(spark, tmpdir_run):
    from lakeforge.operators.quality import check_batch
    from lakeforge.schemas import RAW_REQUIRED_ORDER_COLUMNS
    from lakeforge.sources.files import batch_path, read_landed, uncastable
    path = batch_path(tmpdir_run, "orders", "2026-07-01")
    os.makedirs(path)
    with open(f"{path}/a.csv", "w") as f:
        f.write("customer_id,order_id,extra,order_date,order_status,currency_code\n"
                "7,1,x,2026-07-01 00:00:00,done,USD\nbad,2,y,2026-07-01 00:00:00,done,USD\n")
    landed = read_landed(spark, path)
    report = check_batch(landed, "orders", RAW_REQUIRED_ORDER_COLUMNS).first()
    assert (report.missing_columns, report.passed) == ("store_id", False)
    assert landed.agg(uncastable(landed, RAW_SCHEMAS["orders"]).alias("n")).first().n == 1
    rows = read_raw_csv(spark, tmpdir_run, "orders", "2026-07-01").orderBy("order_id").collect()
    assert [(r.order_id, r.customer_id, r.store_id, r.order_status) for r in rows] == [
        (1, 7, None, "done"), (2, None, None, "done")]
    with open(f"{path}/b.csv", "w") as f:
        f.write("order_id,customer_id,extra,order_date,order_status,currency_code\n3,8,z,,done,USD\n")
    with pytest.raises(Exception, match="CSV header"):
        read_landed(spark, path).collect()


def test_landed_text_comes_back_alike(spark, tmpdir_run):
    hard = [" blanks  ", "", None, 'a "quoted" one', "comma, and \\", '\\"', "two\nlines\r\nthree", "'", "ü€", "\t"]
    moment = dt.datetime(2026, 7, 1, 1, 2, 3, 123456)
    rows = [(i, t, t, moment) for i, t in enumerate(hard)]
    df = spark.createDataFrame(rows, "customer_id long, first_name string, address string, created_at timestamp_ntz")
    land_csv(df.repartition(2), tmpdir_run, "customers", "2026-07-01")
    back = read_raw_csv(spark, tmpdir_run, "customers", "2026-07-01").select(*df.columns)
    assert sorted(map(tuple, back.collect())) == [(i, t or None, t or None, m) for i, t, _, m in rows]


def test_stream_refuses_another_header(spark, tmpdir_run):
    from lakeforge.streaming.ingest import stream_bronze
    path = os.path.join(tmpdir_run, "raw", "stores", "batch_date=2026-07-01")
    os.makedirs(path)
    with open(f"{path}/a.csv", "w") as f:
        f.write("store_name,store_id,store_type,store_size,region,country,opened_date,created_at\nx,1,a,b,c,d,,\n")
    query = stream_bronze(spark, f"{tmpdir_run}/raw", f"{tmpdir_run}/bronze", "stores", f"{tmpdir_run}/ck")
    with pytest.raises(Exception, match="CSV header|FAILED_READ_FILE|STREAM_FAILED"):
        query.awaitTermination()


def test_first_run_without_orders(spark, tmpdir_run):
    source = _source_at(spark, "2026-07-01")
    run_pipeline(spark, lambda t: source(t).where("false") if t == "orders" else source(t),
                 fixtures.fx_rates_raw(spark), f"{tmpdir_run}/lake", "2026-07-01")
    orders = spark.read.parquet(f"{tmpdir_run}/lake/silver/orders")
    assert orders.count() == 0 and "exchange_rate" in orders.columns


def test_state_survives_a_broken_write(spark, tmpdir_run):
    from lakeforge.sources.watermark import read_state, write_state
    path = f"{tmpdir_run}/state"
    assert read_state(spark, path).count() == 0
    for day in (1, 2, 3):
        write_state(spark.createDataFrame([("p", dt.datetime(2026, 7, day), None)], STATE_SCHEMA), path)
    os.makedirs(f"{path}/version=9")  # a write that never finished
    assert read_state(spark, path).first().last_watermark == dt.datetime(2026, 7, 3)
    assert sorted(os.listdir(path)) == ["version=1", "version=2", "version=9"]


def test_views_snapshot_and_table_append(spark, tmpdir_run):
    from lakeforge.plans.registry import fixture_context, preview, register_views
    from lakeforge.sinks.writers import append_to_table
    from lakeforge.sources.extract import read_snapshot
    from lakeforge.sources.files import read_silver
    ctx = fixture_context(spark, SF_SMALL)
    register_views(ctx, ["dim_store"], "v_")
    n = spark.table("v_dim_store").count()
    ctx.ref("dim_store").write.parquet(f"{tmpdir_run}/silver/stores")
    assert read_silver(spark, f"{tmpdir_run}/silver", "stores").count() == n
    assert read_snapshot(spark, "stores", path=f"{tmpdir_run}/silver/stores").count() == n
    preview(ctx.ref("dim_store"), 1, enabled=True)
    spark.sql(f"CREATE TABLE appended (A int, b string) USING parquet LOCATION '{tmpdir_run}/appended'")
    append_to_table(spark.createDataFrame([("x", 1)], "B string, a int"), "appended")
    assert [tuple(r) for r in spark.table("appended").collect()] == [(1, "x")]
    spark.sql("DROP TABLE appended")


def test_cli_over_written_bronze_matches_fixture_run(spark, tmpdir_run):
    from lakeforge.__main__ import main
    from lakeforge.plans.catalog import CATALOG
    from lakeforge.plans.registry import fixture_context
    from lakeforge.sinks.writers import write_bronze
    bronze = os.path.join(tmpdir_run, "bronze")
    for t in SPECS:
        write_bronze(fixtures.adapter(spark, SF_SMALL, t), bronze, t)
    fx = os.path.join(tmpdir_run, "fx")
    fixtures.fx_rates_raw(spark).write.option("header", True).csv(fx)
    out = os.path.join(tmpdir_run, "gold")
    main(["--bronze", bronze, "--fx", fx, "--out", out,
          "--models", "gold_sales_analytics", "expectation_report"])
    got = spark.read.parquet(f"{out}/gold_sales_analytics")
    want = CATALOG["gold_sales_analytics"](fixture_context(spark, SF_SMALL))
    assert got.count() == want.count() > 0
    assert got.exceptAll(want.select(*got.columns)).count() == 0
    rep = spark.read.parquet(f"{out}/expectation_report")
    assert rep.where("NOT passed").count() == 0
