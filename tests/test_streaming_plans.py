"""Structured Streaming ingest, plan shape (pushdown, partition pruning) and the golden seed result."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from daybook.operators.dedupe import latest_by
from daybook.plans import marts, presentation, staging, star
from daybook.sources import testdata as td
from daybook.sources.files import window_scan
from daybook.streaming.ingest import (dedupe_stream, message_files, ratings_files, start_notification_ingest,
                                      start_ratings_ingest)


def _write_json(path, name, objs):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as fh:
        json.dump(objs, fh)


def test_available_now_file_ingest_merges_each_batch(spark, tmp_dir):
    from daybook.plans import ratings
    from daybook.operators.upsert import upsert

    landing = os.path.join(tmp_dir, "landing")
    _write_json(landing, "a.json", [
        {"customerNumber": "101", "productCode": "S10_001", "productRating": "5", "ratingTimestamp": "2026-09-09T10:15:00"},
        {"customerNumber": "102", "productCode": "S10_002", "productRating": "4", "ratingTimestamp": "2026-09-09T11:30:00"},
        {"customerNumber": "103", "productCode": "S20_001", "productRating": "9", "ratingTimestamp": "2026-09-09T14:45:00"}])
    state = {}

    def handle(batch, epoch):
        from daybook.operators.typing import type_ratings
        from daybook.operators.validate import split
        from daybook.spec import RATING_RULES

        valid, _ = split(type_ratings(batch, "2026-09-09"), RATING_RULES, "first")
        kept = latest_by(valid, ["customerNumber", "productCode", "ratingTimestamp"], ["ingest_ts", "source"])
        cur = state.get("t")
        merged = kept if cur is None else upsert(cur, kept, ["customerNumber", "productCode", "ratingTimestamp"])
        state["t"] = spark.createDataFrame(merged.collect(), merged.schema)

    ck = os.path.join(tmp_dir, "ck")
    q = start_ratings_ingest(ratings_files(spark, landing), handle, ck)
    q.awaitTermination(120)
    assert rows(state["t"], "customerNumber", "productRating") == [(101, 5), (102, 4)]
    # a re-sent file with a changed rating updates the stored event on the next trigger
    _write_json(landing, "b.json", [{"customerNumber": "101", "productCode": "S10_001", "productRating": "3",
                                     "ratingTimestamp": "2026-09-09T10:15:00"}])
    q = start_ratings_ingest(ratings_files(spark, landing), handle, ck)
    q.awaitTermination(120)
    assert rows(state["t"], "customerNumber", "productRating") == [(101, 3), (102, 4)]


def test_stream_dedupe_within_watermark(spark, tmp_dir):
    src = os.path.join(tmp_dir, "ev")
    os.makedirs(src)
    spark.createDataFrame([(1, "P", dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, 1)),
                           (1, "P", dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, 2)),
                           (2, "P", dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, 3))],
                          "customerNumber long, productCode string, ratingTimestamp timestamp, ingest_ts timestamp"
                          ).write.mode("overwrite").parquet(src)
    stream = spark.readStream.schema(spark.read.parquet(src).schema).parquet(src)
    q = (dedupe_stream(stream).writeStream.format("memory").queryName("dedup_out")
         .option("checkpointLocation", os.path.join(tmp_dir, "ck")).trigger(availableNow=True).start())
    q.awaitTermination(120)
    assert spark.table("dedup_out").count() == 2


def test_notification_stream_quarantines(spark, tmp_dir):
    inbox = os.path.join(tmp_dir, "inbox")
    os.makedirs(inbox)
    good = json.dumps({"Records": [{"eventTime": "2026-09-09T10:00:00Z",
                                    "s3": {"bucket": {"name": "b"}, "object": {"key": "in/x%2By.json"}}}]})
    with open(os.path.join(inbox, "m.txt"), "w") as fh:
        fh.write(good + "\n" + good[:25] + "\n")
    rec, bad = os.path.join(tmp_dir, "rec"), os.path.join(tmp_dir, "bad")
    q = start_notification_ingest(message_files(spark, inbox), rec, bad, os.path.join(tmp_dir, "ck"))
    q.awaitTermination(120)
    assert [r.key for r in spark.read.parquet(rec).collect()] == ["in/x+y.json"]
    assert spark.read.parquet(bad).count() == 1


def test_window_scan_pushes_both_bounds(spark):
    df = window_scan(td.table(spark, SF_SMALL, "orders"), "o_orderdate", "1998-03-01", "1998-04-01")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "GreaterThanOrEqual(o_orderdate" in plan and "LessThan(o_orderdate" in plan


def test_latest_partition_prunes(spark, tmp_dir):
    td.orders(spark, SF_SMALL).write.partitionBy("processing_date").parquet(tmp_dir, mode="overwrite")
    t = spark.read.parquet(tmp_dir)
    out = presentation.latest_partition(t)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(processing_date" in plan and "Subquery" in plan
    assert out.select("processing_date").distinct().count() == 1


def test_column_pruning_reaches_scan(spark):
    df = marts.mart_monthly_sales(star.fact_order_items(staging.stg_orderdetails(td.orderdetails(spark, SF_SMALL)),
                                                        staging.stg_orders(td.orders(spark, SF_SMALL))))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "l_suppkey" not in plan and "l_returnflag" not in plan


def test_golden_seed_month(spark):
    """Seed rows of the reference (FIXTURES 1): order_count 3, units 7, gross 602.00, avg 150.50."""
    d = dt.date(2026, 9, 9)
    ts = dt.datetime(2026, 9, 9, 10)
    orders = spark.createDataFrame(
        [(10001, d, None, None, "Shipped", 101, ts, "2026-09-09", "landing_rds"),
         (10002, d, None, None, "In Process", 102, ts, "2026-09-09", "landing_rds"),
         (10003, d, None, None, "Resolved", 103, ts, "2026-09-09", "landing_rds")],
        "orderNumber long, orderDate date, requiredDate string, shippedDate string, status string, "
        "customerNumber long, ingest_ts timestamp, processing_date string, source string")
    lines = spark.createDataFrame(
        [(10001, "S10_001", 2, 90.0, 1, ts, "2026-09-09", "landing_rds"),
         (10001, "S10_002", 1, 105.0, 2, ts, "2026-09-09", "landing_rds"),
         (10002, "S20_001", 3, 75.0, 1, ts, "2026-09-09", "landing_rds"),
         (10003, "S10_001", 1, 92.0, 1, ts, "2026-09-09", "landing_rds")],
        "orderNumber long, productCode string, quantityOrdered int, priceEach double, orderLineNumber int, "
        "ingest_ts timestamp, processing_date string, source string")
    m = marts.mart_monthly_sales(star.fact_order_items(staging.stg_orderdetails(lines),
                                                       staging.stg_orders(orders))).first()
    assert (m.order_count, m.units_sold, float(m.gross_sales), float(m.average_order_line_amount)) == \
        (3, 7, 602.0, 150.5)


def test_entry_contract(spark):
    import __spark_entry__ as E

    from daybook.catalog import QUERIES

    assert set(QUERIES) <= set(E.queries()) and set(QUERIES) <= set(E.oracle_sql()) <= set(E.queries())
    df = E.entry(spark)
    assert df.count() > 0 and "order_count" in df.columns
