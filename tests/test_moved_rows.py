"""What merges and slices move: rows that cannot match stay out of the joins, derived columns out of the shuffles."""

import os
import random

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from conftest import plan_text, rows
from daybook.functions import surrogate_key
from daybook.operators.prefilter import split_by_key
from daybook.plans import star
from daybook.sinks.tables import PartitionedTable

FACTS = ("order_item_id string, order_number long, order_line_number int, customer_number long, product_code string, order_date_key int, "
         "order_date date, order_status string, quantity_ordered int, price_each decimal(18,2), gross_amount decimal(18,4)")


def facts(spark, lines):
    """Lines (order, line, day, quantity) as facts."""
    df = spark.createDataFrame(lines, "o long, l int, day string, q int")
    return df.select(surrogate_key(F.col("o"), F.col("l")).alias("order_item_id"), F.col("o").alias("order_number"), F.col("l").alias("order_line_number"),
                     F.lit(1).cast("long").alias("customer_number"), F.lit("p").alias("product_code"), F.expr("cast(date_format(cast(day as date), 'yyyyMMdd') as int)").alias("order_date_key"),
                     F.col("day").cast("date").alias("order_date"), F.lit("SHIPPED").alias("order_status"), F.col("q").alias("quantity_ordered"),
                     F.lit("1.00").cast("decimal(18,2)").alias("price_each"), F.col("q").cast("decimal(18,4)").alias("gross_amount"))


def test_split_keeps_every_row_and_every_match(spark):
    rng = random.Random(3)
    drawn = [(rng.choice([None, *range(4000)]), rng.choice([None, "x", "y"]), i) for i in range(3000)]
    df, keys = spark.createDataFrame(drawn, "a long, b string, i int"), spark.createDataFrame([r[:2] for r in drawn[:150]], "a long, b string")
    may, rest = split_by_key(df, keys, ["a", "b"], 150)
    held = {r[:2] for r in drawn[:150] if None not in r[:2]}
    assert rows(may.union(rest)) == rows(df) and may.columns == df.columns == rest.columns
    assert {r.i for r in may.collect()} >= {i for a, b, i in drawn if (a, b) in held}
    assert may.count() < 600 and rest.filter("a is null or b is null").count() == df.filter("a is null or b is null").count()
    for other in (keys.withColumn("a", F.col("a").cast("int")), keys.withColumn("a", F.col("a").cast("double"))):  # equal values may hash otherwise
        assert split_by_key(df, other, ["a", "b"], 150)[0].count() == 3000
    assert split_by_key(df, keys, ["a", "b"], 10**9)[1].count() == 0  # too large for a filter


def test_a_merge_moves_neither_rows_that_cannot_match_nor_derived_columns(spark, tmp_dir, monkeypatch):
    """Four thousand lines of two months, ten of them sent again: one to the other month, one new, one without a number."""
    lines = [(o, n, f"2024-0{1 + o % 2}-15", 1) for o in range(1000) for n in range(4)]
    table = star.fact_order_items_table(spark, os.path.join(tmp_dir, "f"), StructType.fromDDL(FACTS))
    table.replace(facts(spark, [*lines, (None, 7, "2024-01-15", 1)]), ["order_item_id"])
    source = facts(spark, [*((o, 1, f"2024-0{1 + o % 2}-15", 9) for o in range(8)), (10, 2, "2024-02-15", 9), (5000, 1, "2024-01-15", 9), (None, 7, "2024-01-15", 9)])
    moved, write, upserted = [], PartitionedTable._write, []
    import daybook.operators.upsert as u
    real = u.upsert
    monkeypatch.setattr(u, "upsert", lambda target, *a, **kw: (upserted.append(target.count()), real(target, *a, **kw))[1])
    monkeypatch.setattr(PartitionedTable, "_write", lambda self, df, keys: (moved.append(df), write(self, df, keys))[1])
    assert sorted(table.merge(source, ["order_item_id"])) == ["2024-01", "2024-02"]
    assert upserted[0] < 400 and "order_item_id" not in moved[0].columns and "order_date_key" not in moved[0].columns
    assert table.searched["keys"] == 0  # both months are the source's own
    want = {(o, n): (o, n, d, q) for o, n, d, q in lines} | {(o, 1): (o, 1, f"2024-0{1 + o % 2}-15", 9) for o in range(8)}
    want |= {(10, 2): (10, 2, "2024-02-15", 9), (5000, 1): (5000, 1, "2024-01-15", 9)}
    assert rows(table.read()) == rows(facts(spark, [*want.values(), (None, 7, "2024-01-15", 1), (None, 7, "2024-01-15", 9)]))


def test_a_summary_of_another_key_is_not_asked(spark, tmp_dir):
    """Facts written before their key was derived: their filters hold hashes of it, not of order and line."""
    schema, path = StructType.fromDDL(FACTS), os.path.join(tmp_dir, "f")
    old = PartitionedTable(spark, path, schema, "order_month", by=F.date_format("order_date", "yyyy-MM"), zone=["order_number"])
    old.replace(facts(spark, [(o, 1, f"2024-0{1 + o % 3}-15", 1) for o in range(3000)]), ["order_item_id"])
    table = star.fact_order_items_table(spark, path, schema)
    table.merge(facts(spark, [(0, 1, "2024-03-15", 9)]), ["order_item_id"])
    assert table.read().count() == 3000 and rows(table.read().filter("order_number = 0"), "quantity_ordered") == [(9,)]


def test_lines_are_dealt_once_for_ranking_and_join(spark):
    curated = spark.createDataFrame([(1, "p", 2, 1.5, 1, "2024-01-01 00:00:00", "2024-01-01", "s")],
                                    "orderNumber long, productCode string, quantityOrdered int, priceEach double, orderLineNumber int, ingest_ts string, processing_date string, source string")
    orders = spark.createDataFrame([(1, "2024-01-01", "2024-01-02", None, "Shipped", 4, "2024-01-01 00:00:00", "2024-01-01", "s")],
                                   "orderNumber long, orderDate string, requiredDate string, shippedDate string, status string, customerNumber long, ingest_ts string, processing_date string, source string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = star.fact_order_items_of(curated, orders)
        assert plan_text(df).split("(1) ")[0].count("Exchange") == 2
        assert df.count() == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_rows_that_stay_are_not_gathered_again_until_their_files_are_many(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(PartitionedTable, "FILES", 1)
    gathered, gather = [], PartitionedTable._gathered
    monkeypatch.setattr(PartitionedTable, "_gathered", lambda self, df: (gathered.append(df.count()), gather(self, df))[1])
    table = star.fact_order_items_table(spark, os.path.join(tmp_dir, "f"), StructType.fromDDL(FACTS))
    table.replace(facts(spark, [*((o, 1, f"2024-0{1 + o % 2}-15", 1) for o in range(400)), (3000, 1, None, 1)]), ["order_item_id"])
    want, files = dict.fromkeys([*range(400), 3000], 1), []
    for n in range(6):
        table.merge(facts(spark, [(2 * n, 1, "2024-01-15", 5), (1000 + n, 1, "2024-01-15", 5), (2000 + n, 1, None, 5)]), ["order_item_id"])
        want |= {2 * n: 5, 1000 + n: 5, 2000 + n: 5}
        assert dict(rows(table.read(), "order_number", "quantity_ordered")) == want
        files.append(len([f for f in spark.table(table.name).filter("order_month = '2024-01'").inputFiles()]))
    assert gathered[1] < 30 and max(gathered[1:]) >= 200 and max(files) <= 4
