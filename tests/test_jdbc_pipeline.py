"""JDBC incremental scan against embedded (in-process) Derby, and one full daily run of the stages."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import plan_text, rows
from daybook.context import RunContext
from daybook.sources.files import incremental_jdbc

URL = "jdbc:derby:memory:daybook_src;create=true"


def _derby(spark, statements):
    conn = spark._jvm.java.sql.DriverManager.getConnection(URL)
    try:
        st = conn.createStatement()
        for s in statements:
            st.execute(s)
    finally:
        conn.close()


def test_incremental_jdbc_window_is_half_open_and_pushed(spark):
    _derby(spark, [
        "CREATE TABLE customers (customerNumber INT PRIMARY KEY, customerName VARCHAR(100), "
        "creditLimit DECIMAL(10,2), updated_at TIMESTAMP NOT NULL)",
        "INSERT INTO customers VALUES (101, 'Alpha Retail', 50000.00, TIMESTAMP('2026-09-09 10:00:00'))",
        "INSERT INTO customers VALUES (102, 'Beta Stores', 75000.00, TIMESTAMP('2026-09-09 23:59:59'))",
        "INSERT INTO customers VALUES (103, 'Gamma Traders', 40000.00, TIMESTAMP('2026-09-10 00:00:00'))",
        "INSERT INTO customers VALUES (110, 'Delta', 1.00, TIMESTAMP('2026-09-09 00:00:00'))",
        "INSERT INTO customers VALUES (104, 'Old', 1.00, TIMESTAMP('2026-09-08 23:59:59'))",
    ])
    ctx = RunContext("2026-09-09")
    df = incremental_jdbc(spark, URL, "customers", ctx, "customerNumber", num_partitions=2,
                          properties={"driver": "org.apache.derby.jdbc.EmbeddedDriver"})
    assert df.rdd.getNumPartitions() == 2  # the day's keys, cut in two
    plan = plan_text(df)
    assert "PushedFilters" in plan and "GREATERTHANOREQUAL(UPDATED_AT" in plan.upper() and "LESSTHAN(UPDATED_AT" \
        in plan.upper()
    assert rows(df, "CUSTOMERNUMBER") == [(101,), (102,), (110,)]


def test_daily_run_end_to_end(spark, tmp_dir):
    """Two days through every stage: landing, curation, ratings merge, gate, presentation, models."""
    from daybook.operators.audit import fold
    from daybook.plans.stages import Lake, ratings_for_ml_table, ratings_state_table, run_pipeline

    lake = Lake(os.path.join(tmp_dir, "lake"))
    d1 = dt.datetime(2026, 9, 9, 10)
    src = {
        "customers": spark.createDataFrame([(101, "Alpha Retail", "NY", 50000.0, d1), (102, "Beta", "MA", 75000.0, d1),
                                            (103, "Gamma", "IL", 40000.0, d1)],
                                           "customerNumber int, customerName string, state string, "
                                           "creditLimit double, updated_at timestamp"),
        "products": spark.createDataFrame([("S10_001", "Classic Cars", 100, 45.0, 95.0, d1),
                                           ("S10_002", "Classic Cars", 75, 52.0, 110.0, d1),
                                           ("S20_001", "Motorcycles", 50, 35.0, 80.0, d1)],
                                          "productCode string, productLine string, quantityInStock int, "
                                          "buyPrice double, MSRP double, updated_at timestamp"),
        "orders": spark.createDataFrame([(10001, dt.date(2026, 9, 9), "Shipped", 101, d1),
                                         (10002, dt.date(2026, 9, 9), "In Process", 102, d1),
                                         (10003, dt.date(2026, 9, 9), "Resolved", 103, d1)],
                                        "orderNumber int, orderDate date, status string, customerNumber int, "
                                        "updated_at timestamp"),
        "orderdetails": spark.createDataFrame([(10001, "S10_001", 2, 90.0, 1, d1), (10001, "S10_002", 1, 105.0, 2, d1),
                                               (10002, "S20_001", 3, 75.0, 1, d1), (10003, "S10_001", 1, 92.0, 1, d1),
                                               (10003, "S10_001", 0, 92.0, 2, d1)],
                                              "orderNumber int, productCode string, quantityOrdered int, "
                                              "priceEach double, orderLineNumber int, updated_at timestamp"),
    }
    rdir = os.path.join(tmp_dir, "ratings_in")
    os.makedirs(rdir)
    with open(os.path.join(rdir, "r.json"), "w") as fh:
        json.dump([{"customerNumber": "101", "productCode": "S10_001", "productRating": "5",
                    "ratingTimestamp": "2026-09-09T10:15:00"},
                   {"customerNumber": "102", "productCode": "S10_002", "productRating": "4",
                    "ratingTimestamp": "2026-09-09T11:30:00"},
                   {"customerNumber": "999", "productCode": "S20_001", "productRating": "3",
                    "ratingTimestamp": "2026-09-09T14:45:00"}], fh)
    ctx = RunContext("2026-09-09", run_id="r1", run_ts=dt.datetime(2026, 9, 10, 2))
    run_pipeline(spark, ctx, lake, src, rdir, audit_table="audit_e2e")
    mart = spark.read.parquet(lake.models("mart_monthly_sales")).first()
    assert (mart.order_count, mart.units_sold, float(mart.gross_sales)) == (3, 7, 602.0)
    rfml = ratings_for_ml_table(spark, lake).read()
    assert rows(rfml, "customerNumber", "productRating") == [(101, 5), (102, 4)]
    assert set(spark.table(lake.catalog("customers")).toDF(*spark.table(lake.catalog("customers")).columns).select("run_id").distinct().collect()[0]) == {"r1"}
    state = fold(spark.table("audit_e2e"))
    metrics = {r.stage: r.metrics for r in state.collect()}
    assert metrics["ratings_json_landing"]["row_count"] == "3" and metrics["ratings_for_ml_transform"]["valid_rows"] == "2"
    assert metrics["ratings_for_ml_transform"]["rejected_rows"] == "1" and metrics["ratings_iceberg_merge"]["merged_rows"] == "2"
    assert metrics["curated_quality_checks"]["check_count"] == "7" and metrics["curated_quality_checks"]["failed_checks"] == "0"
    assert metrics["models"]["test_count"] == "20" and metrics["models"]["failed_tests"] == "0"
    assert spark.table("audit_e2e_runs").first().status == "SUCCEEDED"
    assert {r.stage: r.status for r in state.collect()}["batch_transform"] == "SUCCEEDED_WITH_REJECTS"
    from daybook.plans.stages import register_views

    assert "stg_orders" in register_views(spark, lake)
    assert spark.sql("select count(*) as n from stg_orderdetails").first().n == 4
    # rerun of the same day gives the same tables (idempotent)
    run_pipeline(spark, RunContext("2026-09-09", run_id="r2", run_ts=dt.datetime(2026, 9, 10, 3)), lake, src, rdir,
                 audit_table="audit_e2e")
    assert spark.read.parquet(lake.models("fact_order_items")).count() == 4
    assert rows(ratings_state_table(spark, lake).read(), "customerNumber", "productRating") == \
        [(101, 5), (102, 4)]


def test_streamed_ratings_reach_the_event_table(spark, tmp_dir):
    """Rating files arriving in an inbox are merged into ratings_for_ml by the streaming path."""
    from daybook.plans.stages import Lake, stream_ratings
    from daybook.plans.stages import ratings_for_ml_table, ratings_state_table

    lake = Lake(os.path.join(tmp_dir, "lake"))
    ts = dt.datetime(2026, 9, 9, 1)
    spark.createDataFrame([(101, "A", ts, "2026-09-09"), (102, "B", ts, "2026-09-09")],
                          "customerNumber long, customerName string, ingest_ts timestamp, processing_date string"
                          ).write.partitionBy("processing_date").parquet(lake.curated("customers"))
    spark.createDataFrame([("S10_001", "Car", "Classic Cars", ts, "2026-09-09")],
                          "productCode string, productName string, productLine string, ingest_ts timestamp, "
                          "processing_date string").write.partitionBy("processing_date").parquet(
        lake.curated("products"))
    inbox = os.path.join(tmp_dir, "inbox")
    os.makedirs(inbox)
    with open(os.path.join(inbox, "r1.json"), "w") as fh:
        json.dump([{"customerNumber": "101", "productCode": "S10_001", "productRating": "5",
                    "ratingTimestamp": "2026-09-09T10:15:00"},
                   {"customerNumber": "999", "productCode": "S10_001", "productRating": "4",
                    "ratingTimestamp": "2026-09-09T11:30:00"}], fh)
    ctx = RunContext("2026-09-09", run_id="s1", run_ts=dt.datetime(2026, 9, 10, 2))
    stream_ratings(spark, ctx, lake, inbox, os.path.join(tmp_dir, "ck")).awaitTermination(180)
    rfml = ratings_for_ml_table(spark, lake).read()
    assert rows(rfml, "customerNumber", "productRating", "productName") == [(101, 5, "Car")]


def test_later_day_late_event_and_backfill(spark, tmp_dir):
    """Day 2 changes a customer and brings a late rating; a backfill of day 0 arrives afterwards.
    The late rating must not overwrite newer state and the backfill must not regress dims."""
    from daybook.plans.stages import Lake, run_pipeline
    from daybook.plans.stages import ratings_for_ml_table, ratings_state_table

    lake = Lake(os.path.join(tmp_dir, "lake"))
    c_schema = "customerNumber int, customerName string, creditLimit double, updated_at timestamp"
    p_schema = "productCode string, productName string, quantityInStock int, buyPrice double, MSRP double, " \
               "updated_at timestamp"
    o_schema = "orderNumber int, orderDate date, status string, customerNumber int, updated_at timestamp"
    d_schema = "orderNumber int, productCode string, quantityOrdered int, priceEach double, orderLineNumber int, " \
               "updated_at timestamp"

    def day(date, customers, ratings_json):
        t = dt.datetime.fromisoformat(date) + dt.timedelta(hours=9)
        src = {
            "customers": spark.createDataFrame([(n, name, credit, t) for n, name, credit in customers], c_schema),
            "products": spark.createDataFrame([("P1", "Widget", 5, 1.0, 2.0, t)], p_schema),
            "orders": spark.createDataFrame([(1, dt.date.fromisoformat(date), "Shipped", 101, t)], o_schema),
            "orderdetails": spark.createDataFrame([(1, "P1", 2, 2.0, 1, t)], d_schema),
        }
        rdir = os.path.join(tmp_dir, f"in-{date}")
        os.makedirs(rdir, exist_ok=True)
        with open(os.path.join(rdir, "r.json"), "w") as fh:
            json.dump(ratings_json, fh)
        run_pipeline(spark, RunContext(date, run_id=f"run-{date}", run_ts=t + dt.timedelta(hours=20)), lake, src,
                     rdir, audit_table="audit_days")

    day("2026-09-09", [(101, "Alpha", 100.0)],
        [{"customerNumber": "101", "productCode": "P1", "productRating": "3", "ratingTimestamp": "2026-09-09T10:00:00"}])
    day("2026-09-10", [(101, "Alpha", 900.0)],
        [{"customerNumber": "101", "productCode": "P1", "productRating": "1", "ratingTimestamp": "2026-09-08T10:00:00"}])
    state = ratings_state_table(spark, lake).read()
    assert rows(state, "customerNumber", "productRating") == [(101, 3)]          # late event ignored
    dim = spark.read.parquet(lake.models("dim_customers"))
    assert [float(r.credit_limit) for r in dim.collect()] == [900.0]
    # back-filled older day after the newer one: the dimension keeps the newer version
    day("2026-09-01", [(101, "Alpha OLD", 5.0)], [])
    dim = spark.read.parquet(lake.models("dim_customers"))
    assert [(r.customer_name, float(r.credit_limit)) for r in dim.collect()] == [("Alpha", 900.0)]


def test_failing_model_test_stops_the_run(spark, tmp_dir):
    """An order with a status outside the accepted list passes the gate and fails the models stage, whose
    results and counts are stored."""
    from daybook.plans.stages import GateFailure, Lake, run_pipeline

    lake = Lake(os.path.join(tmp_dir, "lake"))
    t = dt.datetime(2026, 9, 9, 10)
    src = {
        "customers": spark.createDataFrame([(101, "A", 1.0, t)], "customerNumber int, customerName string, creditLimit double, updated_at timestamp"),
        "products": spark.createDataFrame([("P1", "W", 5, 1.0, 2.0, t)], "productCode string, productName string, quantityInStock int, "
                                          "buyPrice double, MSRP double, updated_at timestamp"),
        "orders": spark.createDataFrame([(1, dt.date(2026, 9, 9), "Lost", 101, t)], "orderNumber int, orderDate date, status string, "
                                        "customerNumber int, updated_at timestamp"),
        "orderdetails": spark.createDataFrame([(1, "P1", 2, 2.0, 1, t)], "orderNumber int, productCode string, quantityOrdered int, "
                                              "priceEach double, orderLineNumber int, updated_at timestamp"),
    }
    rdir = os.path.join(tmp_dir, "in")
    os.makedirs(rdir)
    with open(os.path.join(rdir, "r.json"), "w") as fh:
        json.dump([], fh)
    ctx = RunContext("2026-09-09", run_id="bad", run_ts=dt.datetime(2026, 9, 10, 2))
    with pytest.raises(GateFailure, match="order_status:accepted_values"):
        run_pipeline(spark, ctx, lake, src, rdir, audit_table="audit_bad")
    assert spark.read.json(lake.quality(ctx, "models")).filter("failures > 0").count() == 1
    from daybook.operators.audit import fold

    last = fold(spark.table("audit_bad")).filter("stage = 'models'").first()
    assert last.status == "FAILED" and last.metrics["failed_tests"] == "1"
    assert spark.table("audit_bad_runs").first().failed_stages == ["models"]


def test_arrivals_of_two_dates_are_ingested_under_their_own_day(spark, tmp_dir):
    from daybook.plans.stages import Lake, ratings_for_ml_table, stream_arrivals

    lake = Lake(os.path.join(tmp_dir, "lake"))
    ts = dt.datetime(2026, 9, 9, 1)
    spark.createDataFrame([(101, "A", ts, "2026-09-09")], "customerNumber long, customerName string, ingest_ts timestamp, "
                          "processing_date string").write.partitionBy("processing_date").parquet(lake.curated("customers"))
    spark.createDataFrame([("P1", "Car", "Cars", ts, "2026-09-09")], "productCode string, productName string, productLine string, "
                          "ingest_ts timestamp, processing_date string").write.partitionBy("processing_date").parquet(lake.curated("products"))
    incoming, queue = os.path.join(tmp_dir, "incoming"), os.path.join(tmp_dir, "queue")
    os.makedirs(os.path.join(incoming, "in"))
    os.makedirs(queue)
    bodies = []
    for name, day, rating in (("a b.json", "2026-09-09", "5.0"), ("c.json", "2026-09-10", "4")):
        with open(os.path.join(incoming, "in", name), "w") as fh:
            json.dump([{"customerNumber": "101", "productCode": "P1", "productRating": rating, "ratingTimestamp": f"{day}T10:00:00"}], fh)
        bodies.append(json.dumps({"Records": [{"eventTime": f"{day}T11:00:00Z", "s3": {
            "bucket": {"name": "b"}, "object": {"key": "in/" + name.replace(" ", "+")}}}]}))
    with open(os.path.join(queue, "q.txt"), "w") as fh:
        fh.write("\n".join([*bodies, bodies[0], "not json"]) + "\n")
    ctx = RunContext("2026-09-30", run_id="q1", run_ts=dt.datetime(2026, 9, 30, 2))
    stream_arrivals(spark, ctx, lake, queue, incoming, os.path.join(tmp_dir, "ck")).awaitTermination(180)
    got = ratings_for_ml_table(spark, lake).read()
    assert rows(got, "processing_date", "productRating") == [("2026-09-09", 5), ("2026-09-10", 4)]
    assert spark.read.parquet(f"{lake.root}/quarantine/notifications/run_id=q1").count() == 1
    assert os.listdir(f"{lake.root}/_staging") == []  # what the stage staged went with it


def test_jdbc_ranges_follow_the_data(spark):
    """90 % of the rows lie in 1 % of the range: quantile cuts give every task about as many."""
    from daybook.sources.files import jdbc_table

    _derby(spark, ["CREATE TABLE skewed (id INT, happened TIMESTAMP, d DATE)"])
    rows_ = [(i % 100 if i % 10 else 100 + i * 9, i) for i in range(1, 1001)] + [(None, 1), (None, 2)]
    stamp = dt.datetime(2024, 1, 1)
    for lo in range(0, len(rows_), 250):
        values = ", ".join(f"({'NULL' if v is None else v}, TIMESTAMP('{stamp + dt.timedelta(minutes=(v or 0))}'), DATE('{(stamp + dt.timedelta(days=(v or 0) // 10)).date()}'))"
                           for v, _ in rows_[lo:lo + 250])
        _derby(spark, [f"INSERT INTO skewed VALUES {values}"])
    for column in ("id", "happened", "d"):
        df = jdbc_table(spark, URL, "skewed", column, num_partitions=8, properties={"driver": "org.apache.derby.jdbc.EmbeddedDriver"})
        sizes = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 1002 and len(sizes) >= 6 and max(sizes) < 2 * 1002 / len(sizes)
        even = jdbc_table(spark, URL, "skewed", column, num_partitions=8, properties={"driver": "org.apache.derby.jdbc.EmbeddedDriver"}, even=True)
        assert max(r["count"] for r in even.groupBy(F.spark_partition_id()).count().collect()) > 800 and even.count() == 1002
        assert sorted(map(str, df.collect())) == sorted(map(str, even.collect()))
