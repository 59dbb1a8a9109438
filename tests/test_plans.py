"""Plan shapes the design relies on (checked on the executed plan)."""

from conftest import SF_SMALL
from lakeforge.plans.catalog import CATALOG
from lakeforge.plans.registry import fixture_context
from lakeforge.session import cluster_conf


def _plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_silver_orders_broadcasts_rates_and_limits_window(spark):
    plan = _plan(CATALOG["orders_fx"](fixture_context(spark, SF_SMALL)))
    assert "BroadcastHashJoin" in plan and "LeftOuter" in plan
    assert "WindowGroupLimit" in plan


def test_fact_prunes_dimension_columns(spark):
    df = CATALOG["fact_sales"](fixture_context(spark, SF_SMALL))
    plan = _plan(df)
    # the product dimension contributes only its key column to the star join
    assert "ReadSchema: struct<p_partkey:bigint>" in plan


def test_mart_aggregates_partially_before_shuffle(spark):
    plan = _plan(CATALOG["gold_sales_analytics"](fixture_context(spark, SF_SMALL)))
    assert plan.count("HashAggregate") >= 4  # partial + final for distinct and totals


def _analysed(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_core_picks_the_latest_of_several_loads(spark):
    ctx = fixture_context(spark, SF_SMALL)
    for staged, core, key in [("stg_customers", "dim_customer", "customer_id"),
                              ("stg_products", "dim_product", "product_id"),
                              ("stg_stores", "dim_store", "store_id"), ("stg_orders", "latest_orders", "order_id"),
                              ("stg_order_items", "latest_order_items", "order_item_id")]:
        stage, one = ctx.ref(staged), ctx.ref(core)
        assert _analysed(one).count("Window ") > _analysed(stage).count("Window ")
        assert stage.groupBy(key).count().where("count > 1").count() > 0
        assert one.groupBy(one[key]).count().where("count > 1").count() == 0


def test_latest_load_does_not_depend_on_the_order_of_loads(spark):
    import datetime as dt

    from lakeforge.plans.core import latest_load
    same = dt.date(2026, 7, 1), dt.datetime(2026, 7, 1, 1)
    rows = [(1, *same, dt.date(2026, 7, 1), 1.0), (1, *same, dt.date(2026, 7, 2), 2.0)]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "order_id long, batch_date date, ingestion_timestamp timestamp_ntz, "
                                          "load_date date, exchange_rate double")
        assert latest_load(df, "order_id").first().exchange_rate == 2.0


def test_fact_has_no_rate_join(spark):
    assert "exchange_rate" not in _analysed(CATALOG["fact_sales"](fixture_context(spark, SF_SMALL)))


def test_watermark_and_newest_batch_reach_the_scan(spark, tmpdir_run):
    import datetime as dt

    from lakeforge.sources.extract import read_incremental
    from lakeforge.sources.files import latest_batch
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    plan = read_incremental(orders, "o_orderdate", dt.datetime(1995, 1, 1))._jdf.queryExecution().executedPlan()
    assert "GreaterThan(o_orderdate" in plan.toString()
    spark.range(10).selectExpr("id", "date'2026-07-01' + cast(id % 3 as int) as batch_date").write.partitionBy(
        "batch_date").parquet(f"{tmpdir_run}/t")
    newest = latest_batch(spark.read.parquet(f"{tmpdir_run}/t"))
    assert {r.id for r in newest.collect()} == {2, 5, 8}
    filters = [x for x in newest._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: ")[1:]]
    assert any("(batch_date" in f[:120] and "=" in f[:120] for f in filters)


def test_cluster_conf_scales_with_input():
    small = cluster_conf(10 << 30, 64)
    big = cluster_conf(100 << 40, 8000)
    assert int(small["spark.sql.shuffle.partitions"]) == 128
    assert int(big["spark.sql.shuffle.partitions"]) == 409600


def _items_and_orders(ctx, dim, key):
    """``ctx`` whose fact still holds keys that the dimension has lost since."""
    ctx.ref("fact_orders")
    ctx._cache[dim] = ctx.ref(dim).where(f"{key} % 3 <> 0")
    return ctx


def test_orphans_of_the_fact_are_found_before_its_join(spark):
    for dim, key in (("customer", "customer_key"), ("store", "store_key")):
        full = fixture_context(spark, SF_SMALL)
        fact, parents = full.ref("fact_sales"), full.ref(f"dim_{dim}").where(f"{key} % 3 <> 0")
        want = fact.where(f"{key} % 3 = 0")
        ctx = _items_and_orders(fixture_context(spark, SF_SMALL), f"dim_{dim}", key)
        got = CATALOG[f"rel_fact_{dim}"](ctx)
        plan = _analysed(got)
        assert plan.index("LeftAnti") > plan.index("order_id#")  # below the join of items and orders
        assert got.columns == want.columns and got.count() == want.count() > 0
        assert got.exceptAll(want).count() == 0
        full._cache["dim_" + dim] = parents  # a fact that is there already is checked as it is
        assert CATALOG[f"rel_fact_{dim}"](full).exceptAll(got).count() == 0


def test_marts_count_orders_without_a_distinct_aggregate(spark):
    shape = ("order_item_id long, order_id long, product_key long, quantity int, line_total decimal(18,4), "
             "profit decimal(18,4)")
    rows = [(1, 1, 1, 1), (2, 1, 1, 2), (3, 2, 1, 1), (4, 2, 2, 1), (5, None, 2, 1), (6, None, 1, 1), (None, 2, 2, 5)]
    ctx = fixture_context(spark, SF_SMALL)
    ctx._cache["fact_sales"] = spark.createDataFrame([(*r, None, None) for r in rows], shape)
    df = CATALOG["gold_product_analytics"](ctx)
    got = {r.product_key: (r.total_orders, r.units_sold) for r in df.collect()}
    assert got == {1: (2, 5), 2: (1, 7)}
    text = _analysed(df)
    assert "count(distinct" not in text and "Aggregate [product_key" in text
    assert not any("order_id" in line for line in text.split("\n") if "Aggregate [" in line)
