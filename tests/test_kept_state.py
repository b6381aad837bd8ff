"""State that is kept up to date instead of being built anew: masters and marts; reconciliation by content."""

import datetime as dt
import os
import random

from pyspark.sql import functions as F

from conftest import rows
from daybook.operators.dedupe import latest_master
from daybook.operators.quality import reconcile_content
from daybook.plans import marts
from daybook.plans.masters import master_table, refresh_master
from daybook.sinks.tables import PartitionedTable


def test_masters_equal_the_ranking_after_backfills_and_reruns(spark, tmp_dir):
    rng, days = random.Random(4), {}
    schema = "k int, name string, ingest_ts timestamp, processing_date string"
    t = master_table(spark, os.path.join(tmp_dir, "m"), spark.createDataFrame([], schema).schema, "k")
    for day in ("2024-01-03", "2024-01-01", "2024-01-05", "2024-01-03", "2024-01-02", "2024-01-05", "2024-01-01"):  # some run twice
        days[day] = [(rng.choice([None, *range(25)]), rng.choice("abc"), dt.datetime(2024, 1, 9, rng.randrange(3)), day) for _ in range(rng.randrange(3, 25))]
        curated = spark.createDataFrame([r for d in days.values() for r in d], schema)
        refresh_master(t, curated, "k", day)
        assert rows(t.read()) == rows(latest_master(curated, "k").select(*t.read().columns))
    days["2024-01-05"] = []  # a rerun without rows: its keys fall back to older days, or go
    curated = spark.createDataFrame([r for d in days.values() for r in d], schema)
    refresh_master(t, curated, "k", "2024-01-05")
    assert rows(t.read()) == rows(latest_master(curated, "k").select(*t.read().columns))


def test_masters_take_new_columns(spark, tmp_dir):
    path, old = os.path.join(tmp_dir, "m"), spark.createDataFrame([(1, "a", "2024-01-01")], "k int, name string, processing_date string").withColumn(
        "ingest_ts", F.lit("2024-01-01 00:00:00").cast("timestamp"))
    refresh_master(master_table(spark, path, old.schema, "k"), old, "k", "2024-01-01")
    new = old.withColumn("tier", F.lit(None).cast("string")).unionByName(
        old.withColumns({"k": F.lit(2), "processing_date": F.lit("2024-01-02"), "tier": F.lit("gold")}))
    t = master_table(spark, path, new.schema, "k")
    refresh_master(t, new, "k", "2024-01-02")
    assert rows(t.read(), "k", "tier") == [(1, None), (2, "gold")]


def test_marts_of_rewritten_months_equal_a_full_build(spark, tmp_dir):
    rng = random.Random(6)
    schema = "order_item_id string, order_number long, order_date date, product_code string, quantity_ordered int, gross_amount decimal(18,4)"
    facts = PartitionedTable(spark, os.path.join(tmp_dir, "f"), spark.createDataFrame([], schema).schema, "order_month",
                             by=F.date_format("order_date", "yyyy-MM"), zone=["order_number"])
    sales, sold = marts.sales_table(spark, os.path.join(tmp_dir, "s")), marts.product_months_table(spark, os.path.join(tmp_dir, "p"))

    def batch(n):
        from decimal import Decimal

        out = {}
        for _ in range(n):
            order = rng.randrange(30)
            day = rng.choice([None, dt.date(2024, 1 + rng.randrange(5), 3)])
            out[f"{order}|{rng.randrange(3)}"] = (order, day, rng.choice(["A", "B", "C"]), rng.randrange(9), Decimal(rng.randrange(10_000)) / 100)
        return spark.createDataFrame([(k, *v) for k, v in out.items()], schema)

    facts.replace(batch(50), ["order_item_id"])
    months = None
    for n in (0, 6, 3, 25):
        if n:
            months = facts.merge(batch(n), ["order_item_id"])
        got = marts.refresh_months(sales, facts, marts.mart_monthly_sales, months), marts.refresh_months(sold, facts, marts.product_months, months)
        assert sorted(map(tuple, got[0].collect()), key=str) == sorted(map(tuple, marts.mart_monthly_sales(facts.read()).collect()), key=str)
        assert sorted(map(tuple, got[1].collect()), key=str) == sorted(map(tuple, marts.product_months(facts.read()).collect()), key=str)
    assert months and len(months) <= 6


def test_product_performance_from_months(spark):
    dim = spark.createDataFrame([(p, p, "l", "v") for p in "ABCD"], "product_code string, product_name string, product_line string, product_vendor string")
    items = spark.createDataFrame([("A", dt.date(2024, 1, 1), 2, 1.5), ("A", dt.date(2024, 2, 1), None, 2.25), ("B", None, 1, 0.5)],
                                  "product_code string, order_date date, quantity_ordered int, g double").withColumn("gross_amount", F.col("g").cast("decimal(18,4)"))
    stars = spark.createDataFrame([("A", dt.datetime(2024, 1, 1), r) for r in (1, 2, 2)] + [("A", dt.datetime(2024, 3, 1), None), ("C", dt.datetime(2024, 3, 1), None)],
                                  "product_code string, rating_timestamp timestamp, product_rating int")
    want = marts.mart_product_performance(dim, items, stars)
    got = marts.product_performance(dim, marts.product_months(items), marts.rating_months(stars))
    assert got.schema == want.schema and sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_reconcile_sees_what_counts_do_not(spark):
    schema = "day string, k int, v string"
    source = spark.createDataFrame([("a", 1, "x"), ("a", 2, None), ("b", 1, "x"), ("b", 1, "x"), ("b", 2, "y"), ("c", 1, "x"), ("d", 1, "x")], schema)
    valid = spark.createDataFrame([("a", 2, None), ("b", 1, "x"), ("b", 2, "y"), ("c", 1, "X")], schema)
    rejected = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y"), ("e", 1, "x")], schema)
    got = {r.day: (r.source_rows, r.result_rows, r.status) for r in reconcile_content(source, [valid, rejected], ["k", "v"], ["day"]).collect()}
    assert got == {"a": (2, 2, "match"), "b": (3, 3, "content differs"), "c": (1, 1, "content differs"), "d": (1, 0, "rows differ"), "e": (0, 1, "rows differ")}
