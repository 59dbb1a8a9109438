"""Loads in one pass, late rows, publishing and reruns, tables, file layout, table differences."""

import datetime as dt
import os
import random
import re

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from lakeforge.operators.diff import diff_counts, table_diff
from lakeforge.operators.latest import at_loads, latest_by_key, latest_by_load
from lakeforge.operators.profile import concentration, magnitude_block, running_before
from lakeforge.operators.quality import CORE_EXPECTATIONS, run_expectations
from lakeforge.plans import zones
from lakeforge.plans.catalog import CATALOG
from lakeforge.plans.pipeline import run_pipeline
from lakeforge.plans.registry import Context, fixture_context
from lakeforge.plans.tables import save_sources, table_context, with_fact_tables
from lakeforge.schemas import SPECS
from lakeforge.sinks.writers import replace_partition, write_full, write_keyed, write_ordered, write_partitioned
from lakeforge.sources import fixtures
from lakeforge.sources.extract import key_ranges, read_snapshot, read_with_lookback
from test_io_pipeline import _source_at


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# ---------------------------------------------------------------- loads
LOADS = ("2026-07-01", "2026-07-03", "2026-07-06")


def test_latest_by_load_equals_a_pass_per_load(spark):
    r = random.Random(11)
    rows = [(r.choice([None, *range(40)]), dt.date(2026, 7, r.randrange(1, 9)), r.choice([None, *range(6)]), i)
            for i in range(600)] + [(1, None, 9, 1000)]
    df = spark.createDataFrame(rows, "k int, batch_date date, ts int, id int")
    got = at_loads(latest_by_load(df, "k", ["ts"], ["id"], "batch_date", LOADS), LOADS)
    want = None
    for d in LOADS:
        part = latest_by_key(df.where(F.col("batch_date") <= F.lit(d).cast("date")), "k", ["ts"], ["id"])
        part = part.withColumn("load_date", F.lit(d).cast("date"))
        want = part if want is None else want.unionByName(part)
    assert got.count() == want.count() > 100
    assert got.select(*want.columns).exceptAll(want).count() == 0


def test_versions_and_their_newest_take_one_shuffle(spark):
    df = spark.createDataFrame([(i % 9, dt.date(2026, 7, 1 + i % 7), i % 5, i) for i in range(200)]
                               + [(None, dt.date(2026, 7, 2), None, 200)], "k int, batch_date date, ts int, id int")
    got = latest_by_load(df, "k", ["ts"], ["id"], "batch_date", LOADS)
    assert _plan(latest_by_key(got, "k", ["ts"], ["id"])).count("Exchange hashpartitioning") == 1
    hot = latest_by_load(df, "k", ["ts"], ["id"], "batch_date", LOADS, hot_keys=True)
    assert got.count() == hot.count() > 9 and got.exceptAll(hot.select(*got.columns)).count() == 0


def test_a_tie_goes_to_the_later_load(spark):
    df = spark.createDataFrame([(1, dt.date(2026, 7, 1), 5, "a"), (1, dt.date(2026, 7, 3), 5, "b")],
                               "k int, batch_date date, ts int, v string")
    got = at_loads(latest_by_load(df, "k", ["ts"], [], "batch_date", LOADS), LOADS)
    assert sorted((str(r.load_date), r.v) for r in got.collect()) == [
        ("2026-07-01", "a"), ("2026-07-03", "b"), ("2026-07-06", "b")]


def test_staging_over_three_loads_equals_silver_as_of_each(spark):
    loads = ("2026-06-30", "2026-07-01", "2026-07-02")
    ctx = fixture_context(spark, SF_SMALL, loads=loads)
    for t, silver in [("customers", "silver_customers"), ("orders", "silver_orders")]:
        staged = ctx.ref(f"stg_{t}")
        for d in loads:
            part = staged.where(F.col("load_date") == F.lit(d).cast("date")).drop("load_date")
            want = ctx.as_of(d).ref(silver).select(*part.columns)
            assert part.count() == want.count() and part.exceptAll(want).count() == 0


def test_plan_of_the_fact_does_not_grow_with_loads(spark):
    def nodes(n):
        loads = tuple(str(dt.date(2026, 7, 1) + dt.timedelta(days=i)) for i in range(n))
        df = fixture_context(spark, SF_SMALL, loads=loads).ref("fact_sales")
        text = df._jdf.queryExecution().optimizedPlan().toString()
        return text.count("Relation ["), len(re.findall(r"Window \[", text))
    assert nodes(2) == nodes(9)
    assert nodes(2)[0] <= 8


def test_dim_date_reads_no_rates(spark):
    ctx = fixture_context(spark, SF_SMALL)
    text = ctx.ref("dim_date")._jdf.queryExecution().optimizedPlan().toString()
    assert "exchange_rate" not in text and "Join" not in text


# ---------------------------------------------------------------- late rows
def test_lookback_finds_late_rows_and_changes_once(spark):
    def day(n):
        return dt.datetime(2026, 7, n)
    shape = "id int, ts timestamp_ntz, status string, note string"
    landed = spark.createDataFrame([
        (1, day(1), "open", None, 1), (2, day(8), "open", None, 1), (3, day(8), "open", "x", 1),
        (4, day(8), "open", None, 1), (4, day(8), "done", None, 2), (5, day(9), None, "a", 1), (7, day(9), "open", "", 1)],
        shape + ", batch int")
    source = spark.createDataFrame([
        (1, day(1), "done", None),   # changed before the overlap: not seen
        (2, day(8), "open", None),   # as landed
        (3, day(8), "done", "x"),    # changed
        (4, day(8), "open", None),   # changed back
        (5, day(9), "a", None),      # a value moved to another column
        (6, day(8), "open", None),   # late
        (7, day(9), "open", None),   # empty became null
        (8, day(11), "open", None),  # new
        (9, day(1), "late", None)],  # too late
        shape)
    got = read_with_lookback(source, "id", "ts", day(10), "3 days", landed, ["batch"])
    assert sorted(r.id for r in got.collect()) == [3, 4, 5, 6, 7, 8]
    again = landed.unionByName(got.withColumn("batch", F.lit(3)))
    assert read_with_lookback(source, "id", "ts", day(11), "4 days", again, ["batch"]).count() == 0
    assert read_with_lookback(source, "id", "ts", None, "3 days", landed, ["batch"]).count() == 9
    plan = _plan(read_with_lookback(spark.read.parquet(f"{SF_SMALL}/orders.parquet"), "o_orderkey", "o_orderdate",
                                    dt.datetime(1996, 1, 1), "3 days",
                                    spark.read.parquet(f"{SF_SMALL}/orders.parquet"), ["o_orderdate"]))
    assert plan.count("PushedFilters: [IsNotNull(o_orderdate), GreaterThan(o_orderdate") == 3


# ---------------------------------------------------------------- publishing
def _rows(spark, path, drop=()):
    df = spark.read.parquet(path)
    return sorted(map(str, df.drop(*drop).collect()))


def _raw(root):
    out = {}
    for folder, _, names in os.walk(f"{root}/raw"):
        for n in names:
            if n.endswith(".csv"):
                with open(f"{folder}/{n}") as f:
                    out.setdefault(os.path.relpath(folder, root), []).extend(sorted(f.read().splitlines()))
    return {k: sorted(v) for k, v in out.items()}


def test_rerun_of_an_older_day_changes_nothing(spark, tmpdir_run):
    root = f"{tmpdir_run}/lake"
    fx = fixtures.fx_rates_raw(spark)

    def orders_until(day, cut):
        source = _source_at(spark, day)
        return lambda t: source(t).where(F.col("order_date") <= F.lit(cut).cast("timestamp_ntz")) if t == "orders" else source(t)
    first, second = orders_until("2026-07-01", "1996-06-01"), orders_until("2026-07-02", "1999-01-01")
    run_pipeline(spark, first, fx, root, "2026-07-01", ingestion_ts="2026-07-01 01:00:00")
    run_pipeline(spark, second, fx, root, "2026-07-02", ingestion_ts="2026-07-02 01:00:00")

    def state():
        zones = {f"bronze/{t}": () for t in SPECS} | {f"staging/{t}": () for t in SPECS}
        zones |= {f"silver/{t}": () for t in SPECS} | {f"gold/{m}": () for m in (
            "fact_sales", "dim_customer", "gold_sales_analytics", "gold_customer_analytics")}
        return _raw(root), {z: _rows(spark, f"{root}/{z}", ["source_file"]) for z in zones}
    before = state()
    assert any(k.startswith("raw/orders/batch_date=2026-07-02") for k in before[0])
    # the source has moved on; a rerun without an ingestion time of its own, then a fresh read
    run_pipeline(spark, second, fx, root, "2026-07-01")
    assert state() == before
    run_pipeline(spark, orders_until("2026-07-01", "1999-01-01"), fx, root, "2026-07-01", refresh=True)
    assert state() == before


def test_a_failed_gate_leaves_raw_untouched(spark, tmpdir_run):
    root = f"{tmpdir_run}/lake"
    source, fx = _source_at(spark, "2026-07-01"), fixtures.fx_rates_raw(spark)
    with pytest.raises(RuntimeError, match="stores"):
        run_pipeline(spark, lambda t: source(t).where("false") if t == "stores" else source(t), fx, root, "2026-07-01")
    assert not os.path.exists(f"{root}/raw") and not os.path.exists(f"{root}/state")
    bad = spark.createDataFrame([(dt.date(2026, 7, 1), "SUCCESS", "{broken")],
                                "snapshot_date date, status string, payload string")
    with pytest.raises(RuntimeError, match="fx_payload"):
        run_pipeline(spark, source, None, root, "2026-07-01", fx_snapshots=bad)
    assert not os.path.exists(f"{root}/raw")


def test_an_interrupted_publication_is_made_again(spark, tmpdir_run):
    from lakeforge.plans.pipeline import Zones, publish_batch
    root, fx = f"{tmpdir_run}/lake", fixtures.fx_rates_raw(spark)
    source = _source_at(spark, "2026-07-01")
    z = Zones(root)
    publish_batch(spark, source, fx, z, "2026-07-01")
    whole = _raw(root)
    os.rename(z.published, f"{tmpdir_run}/record")          # the record was never written
    os.rename(f"{root}/raw/payments", f"{tmpdir_run}/gone")  # and a table never moved
    batch = publish_batch(spark, source, fx, z, "2026-07-01")
    assert _raw(root) == whole and batch.has_orders and batch.low is None
    os.rename(f"{root}/raw/stores", f"{tmpdir_run}/gone-stores")  # a refresh was cut off between two moves
    assert publish_batch(spark, source, fx, z, "2026-07-01").high == batch.high and _raw(root) == whole


def test_late_orders_arrive_through_the_pipeline(spark, tmpdir_run):
    root, fx = f"{tmpdir_run}/lake", fixtures.fx_rates_raw(spark)
    source = _source_at(spark, "2026-07-01")
    late = "order_date > timestamp_ntz'1998-07-01' and order_id % 7 = 3"

    def without(t):
        return source(t).where(f"not ({late})") if t == "orders" else source(t)
    run_pipeline(spark, without, fx, root, "2026-07-01", ingestion_ts="2026-07-01 01:00:00")
    run_pipeline(spark, source, fx, root, "2026-07-02", ingestion_ts="2026-07-02 01:00:00", lookback="60 days")
    newest = source("orders").agg(F.max("order_date")).first()[0]
    want = source("orders").where(late).where(F.col("order_date") > F.lit(newest - dt.timedelta(days=50)))
    landed = spark.read.parquet(f"{root}/bronze/orders").where("batch_date = date'2026-07-02'")
    ids = {r.order_id for r in landed.collect()}
    assert {r.order_id for r in want.collect()} <= ids
    assert all(i % 7 == 3 for i in ids) and landed.count() == len(ids) > 0


# ---------------------------------------------------------------- writers
def test_files_do_not_grow_with_tasks(spark, tmpdir_run):
    wide = spark.range(0, 20_000, 1, 200).withColumn("batch_date", F.lit("2026-07-01").cast("date"))
    write_full(wide, f"{tmpdir_run}/a")
    write_partitioned(wide, f"{tmpdir_run}/b")
    replace_partition(wide, f"{tmpdir_run}/c", "2026-07-01")
    for folder in (f"{tmpdir_run}/a", f"{tmpdir_run}/b/batch_date=2026-07-01", f"{tmpdir_run}/c/batch_date=2026-07-01"):
        assert len([n for n in os.listdir(folder) if n.endswith(".parquet")]) <= 2
    assert spark.read.parquet(f"{tmpdir_run}/c").count() == 20_000


def test_silver_is_not_shuffled_again_to_be_written(spark, tmpdir_run, monkeypatch):
    plans = []

    def kept(df, path, *args):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        write_keyed(df, path, *args)

    monkeypatch.setattr(zones, "write_keyed", kept)
    CATALOG["silver_zone"](fixture_context(spark, SF_SMALL)).collect()
    assert len(plans) == 14 and not any("Rebalance" in p for p in plans)
    df = latest_by_key(spark.range(0, 20_000, 1, 50).selectExpr("id % 5000 as k", "id"), "k", ["id"])
    write_keyed(df, f"{tmpdir_run}/k")
    write_keyed(df, f"{tmpdir_run}/k")
    assert spark.read.parquet(f"{tmpdir_run}/k").count() == 5000
    assert len([n for n in os.listdir(f"{tmpdir_run}/k") if n.endswith(".parquet")]) <= 4


def test_an_empty_rerun_empties_its_partition(spark, tmpdir_run):
    df = spark.range(5).withColumn("batch_date", F.lit("2026-07-01").cast("date"))
    replace_partition(df, tmpdir_run, "2026-07-01")
    replace_partition(df, tmpdir_run, "2026-07-02")
    replace_partition(df.where("false"), tmpdir_run, "2026-07-01")
    assert spark.read.parquet(tmpdir_run).groupBy("batch_date").count().collect() == [(dt.date(2026, 7, 2), 5)]


def test_ordered_files_do_not_overlap(spark, tmpdir_run):
    mart = fixture_context(spark, SF_SMALL).ref("gold_sales_analytics")
    write_ordered(mart, f"{tmpdir_run}/mart", ["date_key"], files=5)
    spans = []
    for n in sorted(n for n in os.listdir(f"{tmpdir_run}/mart") if n.endswith(".parquet")):
        meta = pq.ParquetFile(f"{tmpdir_run}/mart/{n}").metadata
        at = [meta.schema.column(i).name for i in range(meta.num_columns)].index("date_key")
        spans += [(s.min, s.max) for i in range(meta.num_row_groups) for s in [meta.row_group(i).column(at).statistics]]
    assert len(spans) == 5 and all(a[1] < b[0] for a, b in zip(spans, spans[1:], strict=False))


# ---------------------------------------------------------------- catalog tables
def test_items_meet_orders_without_a_shuffle(spark, tmpdir_run):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ctx = fixture_context(spark, SF_SMALL)
        tables = with_fact_tables(ctx, "fact_test", 4, f"{tmpdir_run}/tables")
        items, heads = tables.ref("latest_order_items"), tables.ref("latest_order_heads")
        plan = _plan(items.join(heads, "order_id"))
        assert "Exchange" not in plan and plan.count("Bucketed: true") == 2
        fact = tables.ref("fact_sales")
        assert "hashpartitioning(order_id" not in _plan(fact)
        want = ctx.ref("fact_sales").select(*fact.columns)
        assert fact.count() == want.count() and fact.exceptAll(want).count() == 0
        for n in ("latest_order_items", "latest_order_heads"):
            assert len([f for f in os.listdir(f"{tmpdir_run}/tables/{n}") if f.endswith(".parquet")]) <= 4
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_fact_tables_shuffle_no_item_by_customer_and_drop_unknown_products(spark, tmpdir_run):
    plain = fixture_context(spark, SF_SMALL)
    ctx = Context(spark, lambda t: plain.source(t).where("product_id % 7 <> 3") if t == "products"
                  else plain.source(t), plain.options)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fact = with_fact_tables(ctx, "fact_unknown", 4, f"{tmpdir_run}/tables").ref("fact_sales")
        assert "hashpartitioning(customer" not in _plan(fact) and "hashpartitioning(store" not in _plan(fact)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "hashpartitioning(product" not in _plan(fact.select("*", F.lit(1)))  # few unknown products
    want = ctx.ref("fact_sales").select(*fact.columns)
    assert plain.ref("fact_sales").count() > fact.count() == want.count() > 0
    assert fact.exceptAll(want).count() == 0


def test_models_over_source_tables(spark, tmpdir_run):
    ctx = fixture_context(spark, SF_SMALL)
    save_sources(ctx, "bronze_test", 4, f"{tmpdir_run}/sources")
    tables = table_context(spark, "bronze_test", fixtures.fx_rates_raw(spark), **ctx.options)
    assert "Exchange" not in _plan(tables.ref("dedupe_orders"))
    for m in ("gold_customer_analytics", "stg_orders"):
        got, want = tables.ref(m), ctx.ref(m)
        assert got.count() == want.count() and got.exceptAll(want.select(*got.columns)).count() == 0


# ---------------------------------------------------------------- expectations, ranks, differences
def test_expectations_run_nothing_before_the_action(spark):
    ctx = fixture_context(spark, SF_SMALL)
    for t in SPECS:
        ctx.source(t)  # opening a file reads its footer
    spark.sparkContext.setJobGroup("expectations", "plan only")
    try:
        report = CATALOG["expectation_report"](ctx)
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("expectations")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert report.where("passed").count() == len(CORE_EXPECTATIONS)


def test_expectations_read_each_model_once_and_count(spark, tmpdir_run):
    frames = {"dim_customer": ("customer_key long", [(1,), (2,), (2,), (2,), (None,), (None,)]),
              "dim_product": ("product_key long", [(1,)]), "dim_store": ("store_key long", [(5,), (6,)]),
              "dim_date": ("date_key date", [(dt.date(2026, 7, 1),), (dt.date(2026, 7, 1),)]),
              "fact_sales": ("order_item_id long, customer_key long, product_key long, store_key long",
                             [(1, 1, 1, 5), (2, 3, 1, 7), (2, 3, None, 7), (None, None, 2, 7), (None, 2, 1, 6)])}
    for m, (shape, rows) in frames.items():
        spark.createDataFrame(rows, shape).write.parquet(f"{tmpdir_run}/{m}")
    df = run_expectations(lambda m: spark.read.parquet(f"{tmpdir_run}/{m}"), CORE_EXPECTATIONS)
    assert _plan(df).count("FileScan parquet") == 5
    got = {r.test_name: r.failures for r in df.collect()}
    assert got == {
        "unique_dim_customer_customer_key": 1, "not_null_dim_customer_customer_key": 2,
        "unique_dim_product_product_key": 0, "not_null_dim_product_product_key": 0,
        "unique_dim_store_store_key": 0, "not_null_dim_store_store_key": 0,
        "unique_dim_date_date_key": 1, "not_null_dim_date_date_key": 0,
        "unique_fact_sales_order_item_id": 1, "not_null_fact_sales_order_item_id": 2,
        "relationships_fact_sales_customer_key__dim_customer_customer_key": 2,
        "relationships_fact_sales_product_key__dim_product_product_key": 1,
        "relationships_fact_sales_store_key__dim_store_store_key": 3}


def test_running_sums_by_magnitude(spark):
    r = random.Random(2)
    values = sorted({r.randrange(0, 1 << r.randrange(1, 62)) for _ in range(400)} | set(range(300)) | {(1 << 62) - 1})
    df = spark.createDataFrame([(v, i % 9) for i, v in enumerate(values)], "c long, n long")
    blocks = [b for _, b in sorted((x.c, x.b) for x in df.select("c", magnitude_block(F.col("c")).alias("b")).collect())]
    assert blocks == sorted(blocks) and blocks[:128] == list(range(128)) and blocks[-1] < 7500
    got = {x.c: (x.n_before, x.n_all) for x in running_before(df, "c", ["n"]).collect()}
    total = 0
    for i, v in enumerate(values):
        assert got[v] == (total, sum(j % 9 for j in range(len(values))))
        total += i % 9


def test_concentration_orders_no_histogram_in_one_task(spark):
    plan = _plan(concentration(spark.range(1000).selectExpr("id * id as lines"), "lines", [("top", 1, True)]))
    windows = [x for x in plan.splitlines() if "Window [" in x]
    assert any("__block" in w for w in windows)
    # the only windows over everything are those of the blocks' sums
    assert all("windowspecdefinition(0" not in w or "__n" in w or "__held" in w for w in windows)


def test_table_diff(spark):
    shape = "k string, a int, b string"
    before = spark.createDataFrame([("1", 1, "x"), ("2", 1, None), ("3", 3, "z"), (None, 7, "n"), ("5", None, "q")], shape)
    after = spark.createDataFrame([("1", 1, "x"), ("2", 2, ""), ("4", 4, "w"), (None, 8, "n"), ("5", None, "q")], shape)
    got = {r.k: (r.change, r.changed_columns) for r in table_diff(before, after, "k").collect()}
    assert got == {"2": ("changed", ["a", "b"]), "3": ("removed", []), "4": ("added", []), None: ("changed", ["a"])}
    counts = {r.column_name: (r.compared, r.added, r.removed, r.changed)
              for r in diff_counts(before, after, ["k"], ["a", "b"]).collect()}
    assert counts == {"a": (4, 1, 1, 2), "b": (4, 1, 1, 1)}
    assert table_diff(before, before, "k").count() == 0


# ---------------------------------------------------------------- snapshot ranges
def test_key_ranges_of_a_skewed_key(spark, tmpdir_run):
    skewed = spark.range(40_000).select(F.expr("cast(pow(id, 3) / 1e6 as long)").alias("k")).unionByName(
        spark.createDataFrame([(None,)] * 50, "k long"))
    skewed.write.parquet(f"{tmpdir_run}/t")
    df = read_snapshot(spark, "t", path=f"{tmpdir_run}/t")
    predicates = key_ranges(df, "k", 8)
    parts = [df.where(p) for p in predicates]
    sizes = [p.count() for p in parts]
    assert len(sizes) == 8 and sum(sizes) == df.count() and max(sizes) <= 2 * min(sizes)
    spans = [p.agg(F.min("k"), F.max("k")).first() for p in parts]
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:], strict=False))
    hot = spark.range(1000).select(F.when(F.col("id") < 900, 7).otherwise(F.col("id")).alias("k"))
    sizes = [hot.where(p).count() for p in key_ranges(hot, "k", 4)]
    assert sum(sizes) == 1000 and 900 in sizes
    for df in (hot.where("false"), spark.createDataFrame([(None,)], "k long")):
        assert [df.where(p).count() for p in key_ranges(df, "k", 4)] == [df.count()]
    days = spark.range(100).select(F.expr("date'2026-01-01' + cast(id as int)").alias("k"))
    assert sum(days.where(p).count() for p in key_ranges(days, "k", 3)) == 100


def test_context_options_are_not_shared(spark):
    ctx = Context(spark, lambda t: spark.range(1))
    assert ctx.over_loads(("2026-07-01",)).options == {"over_loads": ("2026-07-01",)} and ctx.options == {}
