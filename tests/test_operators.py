"""Operator semantics on hand-written edge rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakeforge.functions import cleanse as C
from lakeforge.functions.dates import calendar_columns
from lakeforge.operators.asof import asof_latest
from lakeforge.operators.enrich import convert_to_base, enrich_fx
from lakeforge.operators.joins import orphans
from lakeforge.operators.latest import apply_scd1, latest_by_key
from lakeforge.operators.profile import bucketize, concentration
from lakeforge.operators.quality import (Expectation, check_batch, duplicate_keys, null_counts,
                                         rule_audit, run_expectations)
from lakeforge.operators.quarantine import drop_missing, split_valid
from lakeforge.sinks.writers import align_by_name, append_by_name
from lakeforge.sources.fx import fx_rates_typed, fx_rows, latest_good_fx
from lakeforge.sources import fixtures


def test_latest_by_key_tie_breakers(spark):
    df = spark.createDataFrame(
        [(1, "2026-07-01", 5, "a"), (1, "2026-07-01", 7, "b"), (1, "2026-06-30", 9, "c"),
         (2, None, 1, "n"), (2, "2026-01-01", 1, "d")],
        "k int, ts string, tb int, v string")
    out = {r.k: r.v for r in latest_by_key(df, "k", ["ts"], ["tb"]).collect()}
    # tie on ts resolved by the larger tie-breaker; NULL timestamps sort last
    assert out == {1: "b", 2: "d"}


def test_latest_by_key_plans_partial_group_limit(spark):
    df = spark.range(1000).select((F.col("id") % 10).alias("k"), F.col("id").alias("ts"))
    plan = latest_by_key(df, "k", ["ts"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_split_valid_three_way(spark):
    df = spark.createDataFrame([("a@b.com",), ("bad.example.com",), (None,)], "email string")
    s = split_valid(df, C.email_is_valid("email"), "Invalid Email")
    assert [r.email for r in s.valid.collect()] == ["a@b.com"]
    rej = s.rejected.collect()
    assert [(r.email, r.reject_reason) for r in rej] == [("bad.example.com", "Invalid Email")]
    assert s.unknown.count() == 1
    s2 = split_valid(df, C.email_is_valid("email"), "Invalid Email", null_as_reject=True)
    assert s2.rejected.count() == 2


def test_cleansers(spark):
    df = spark.createDataFrame(
        [("  tn ", "+91 (123) 555-1000", "net_banking", " mary-jane  smith"),
         ("Tamil Nadu", None, " upi", "x"), ("  kerala ", "1.2x3", "credit_card", None),
         ("K A", "(0) 1", "paypal", "a")],
        "state string, phone string, pm string, name string")
    r = df.select(C.canonical_state("state").alias("s"), C.clean_phone("phone").alias("p"),
                  C.clean_payment_method("pm").alias("m"), C.clean_name("name").alias("n")).collect()
    assert [x.s for x in r] == ["Tamil Nadu", "Tamil Nadu", "Kerala", "Karnataka"]
    assert [x.p for x in r] == ["911235551000", None, "1.2x3", "01"]
    assert [x.m for x in r] == ["Net Banking", "Upi", "Credit Card", "Paypal"]
    # initcap splits on spaces only
    assert r[0].n == "Mary-jane  Smith"


def test_drop_missing_and_null_counts(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (None, "c")], "a int, b string")
    assert drop_missing(df, ["a", "b"]).count() == 1
    row = null_counts(df, ["a", "b"]).collect()[0]
    assert (row.a, row.b) == (1, 1)


def test_enrich_fx_keeps_unmatched(spark):
    orders = spark.createDataFrame([(1, "USD"), (2, "XXX"), (3, "GBP")], "id int, currency_code string")
    rates = fx_rates_typed(fixtures.fx_rates_raw(spark))
    out = {r.id: r.exchange_rate for r in enrich_fx(orders, rates).collect()}
    assert out == {1: 1.0, 2: None, 3: None}  # XXX has no row, GBP does not parse
    conv = enrich_fx(orders, rates).withColumn("amt", F.lit(10.0)) \
        .select("id", convert_to_base("amt").alias("base")).collect()
    assert {r.id: r.base for r in conv} == {1: 10.0, 2: None, 3: None}


def test_fx_rates_typed_dedupes_on_currency(spark):
    raw = spark.createDataFrame(
        [("USD", "INR", "80", "Tue, 30 Jun 2026 00:00:01 +0000"),
         ("USD", "INR", "83.25", "Wed, 01 Jul 2026 00:00:01 +0000")],
        "base_currency string, target_currency string, exchange_rate string, last_updated string")
    rows = fx_rates_typed(raw).collect()
    assert [(r.target_currency, r.exchange_rate) for r in rows] == [("INR", 83.25)]


def test_fx_payload_explode(spark):
    payload = '{"base_code": "USD", "time_last_update_utc": "t", "rates": {"USD": 1, "INR": 83.1}}'
    df = spark.createDataFrame([(payload,)], "payload string")
    rows = sorted((r.target_currency, r.exchange_rate, r.base_currency) for r in fx_rows(df).collect())
    assert rows == [("INR", 83.1, "USD"), ("USD", 1.0, "USD")]


def test_latest_good_fx_asof(spark):
    d = dt.date
    snaps = spark.createDataFrame(
        [(d(2025, 12, 30), "SUCCESS", "p1"), (d(2026, 1, 2), "FAILED", None),
         (d(2026, 1, 3), "SUCCESS", "p3")], "snapshot_date date, status string, payload string")
    batches = spark.createDataFrame(
        [(d(2025, 12, 29),), (d(2025, 12, 30),), (d(2026, 1, 2),), (d(2026, 1, 3),), (d(2026, 1, 9),)],
        "batch_date date")
    out = {r.batch_date: (r.snapshot_date, r.fx_status, r.payload)
           for r in latest_good_fx(batches, snaps).collect()}
    assert out[d(2025, 12, 29)] == (None, "UNAVAILABLE", None)
    assert out[d(2025, 12, 30)] == (d(2025, 12, 30), "SUCCESS", "p1")
    # crosses a year boundary through the per-year carry
    assert out[d(2026, 1, 2)] == (d(2025, 12, 30), "DEGRADED", "p1")
    assert out[d(2026, 1, 3)] == (d(2026, 1, 3), "SUCCESS", "p3")
    assert out[d(2026, 1, 9)] == (d(2026, 1, 3), "DEGRADED", "p3")
    with pytest.raises(RuntimeError):
        latest_good_fx(batches, snaps, strict=True)


def test_asof_matches_brute_force(spark):
    import random
    rnd = random.Random(7)
    base = dt.date(2020, 1, 1)
    right = sorted({base + dt.timedelta(days=rnd.randrange(0, 1500)) for _ in range(60)})
    left = [base + dt.timedelta(days=rnd.randrange(-30, 1600)) for _ in range(200)]
    r = spark.createDataFrame([(x, i) for i, x in enumerate(right)], "rd date, v int")
    l_ = spark.createDataFrame([(x, i) for i, x in enumerate(left)], "ld date, id int")
    got = {row.id: row.v for row in asof_latest(l_, "ld", r, "rd", ["v"]).collect()}
    for i, x in enumerate(left):
        cands = [j for j, y in enumerate(right) if y <= x]
        assert got[i] == (cands[-1] if cands else None)


def test_scd1_partial_changes(spark):
    base = spark.createDataFrame([(1, "a", "x", "2026-07-01"), (2, "b", "y", "2026-07-01")],
                                 "id int, name string, city string, updated_at string")
    changes = spark.createDataFrame([(1, "z", "2026-07-02"), (3, "w", "2026-07-02")],
                                    "id int, city string, updated_at string")
    out = {r.id: (r.name, r.city, r.updated_at)
           for r in apply_scd1(base, changes, "id", "updated_at").collect()}
    assert out == {1: ("a", "z", "2026-07-02"), 2: ("b", "y", "2026-07-01"),
                   3: (None, "w", "2026-07-02")}


def test_append_by_name_case_insensitive(spark):
    existing = spark.createDataFrame([(1, "a", 1.5)], "customer_id long, name string, score double")
    incoming = spark.createDataFrame([(2, "b", "extra")], "CUSTOMER_ID int, Name string, other string")
    out = append_by_name(existing, incoming).orderBy("customer_id").collect()
    assert [tuple(r) for r in out] == [(1, "a", 1.5), (2, "b", None)]
    assert align_by_name(incoming, existing.schema).columns == ["customer_id", "name", "score"]


def test_expectations_and_orphans(spark):
    dim = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k int")
    fact = spark.createDataFrame([(1,), (3,), (None,)], "k int")
    assert [tuple(r) for r in duplicate_keys(dim, "k").collect()] == [(2, 2)]
    assert [r.k for r in orphans(fact, "k", dim).collect()] == [3]
    models = {"dim": dim, "fact": fact}
    rep = run_expectations(models.__getitem__, [
        Expectation("unique", "dim", "k"), Expectation("not_null", "dim", "k"),
        Expectation("relationships", "fact", "k", "dim", "k")])
    res = {r.kind: (r.failures, r.passed) for r in rep.collect()}
    assert res == {"unique": (1, False), "not_null": (1, False), "relationships": (1, False)}


def test_rule_audit_long_form(spark):
    df = spark.createDataFrame([(1, -1.0, None), (2, 5.0, "x"), (3, -2.0, "y")],
                               "id int, cost double, email string")
    out = rule_audit(df, "t", "id", [("cost", "negative cost", F.col("cost") < 0),
                                      ("email", "null email", F.col("email").isNull())])
    got = sorted((r.row_key, r.field) for r in out.collect())
    assert got == [(1, "cost"), (1, "email"), (3, "cost")]


def test_check_batch(spark):
    df = spark.createDataFrame([(1, "x")], "order_id int, customer_id string")
    r = check_batch(df, "orders", ["order_id", "customer_id", "store_id"]).collect()[0]
    assert (r.row_count, r.missing_columns, r.passed) == (1, "store_id", False)
    r = check_batch(None, "orders", ["order_id"], optional=True).collect()[0]
    assert (r.batch_present, r.passed) == (False, True)


def test_concentration_matches_brute_force(spark):
    import math
    import random
    rnd = random.Random(3)
    counts = [int(1000 / (i + 1) ** 0.8) + rnd.randrange(0, 3) for i in range(337)] + [0] * 13
    df = spark.createDataFrame([(c,) for c in counts], "lines long")
    got = {r.segment: (r.covered, r.lines) for r in
           concentration(df, "lines", [("top", 1, True), ("top5", 5, True), ("bottom", 50, False)]).collect()}
    s = sorted(counts, reverse=True)
    for name, pct, top in [("top", 1, True), ("top5", 5, True), ("bottom", 50, False)]:
        n = math.ceil(len(counts) * pct / 100)
        expect = sum(s[:n]) if top else sum(sorted(counts)[:n])
        assert got[name] == (n, expect)


def test_bucketize(spark):
    df = spark.createDataFrame([(0,), (2,), (3,), (50,)], "n int")
    b = [("dormant", 0), ("light", 2), ("regular", 7), ("vip", None)]
    assert [r.s for r in df.select(bucketize(F.col("n"), b).alias("s")).collect()] == \
        ["dormant", "light", "regular", "vip"]


def test_calendar_columns(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 7, 7, 10, 0),)], "ts timestamp_ntz")
    r = df.select(*calendar_columns("ts")).collect()[0]
    assert (r.year, r.quarter, r.month, r.month_name, r.day, r.day_of_week, r.day_name) == \
        (2024, 3, 7, "Jul", 7, 0, "Sun")
