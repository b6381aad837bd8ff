"""What the refresh of month tables and the day's slice move: lines of a month once, of an order its number, of history
only lines that the slice can hold."""

import datetime as dt
import os
import random
from decimal import Decimal

from pyspark.sql import functions as F

from conftest import plan_text, rows
from daybook.plans import marts, star
from daybook.sinks.tables import PartitionedTable

FACTS = "order_item_id string, order_number long, order_date date, product_code string, quantity_ordered int, gross_amount decimal(18,4)"
LINES = ("orderNumber long, productCode string, quantityOrdered int, priceEach double, orderLineNumber int, ingest_ts string, processing_date string, "
         "source string")
ORDERS = ("orderNumber long, orderDate string, requiredDate string, shippedDate string, status string, customerNumber long, ingest_ts string, "
          "processing_date string, source string")


def drawn(spark, n, products, seed=1):
    rng = random.Random(seed)
    return spark.createDataFrame([(str(i), rng.choice([None, *range(n // 3)]), rng.choice([None, *(dt.date(2024, m, d) for m in (1, 2, 3) for d in (1, 17))]),
                                   rng.choice([None, *map(str, range(products))]), rng.choice([None, 1, 2, 50]), rng.choice([None, Decimal("1.2345"), Decimal("99.5")]))
                                  for i in range(n)], FACTS)


def test_stored_sales_equal_the_mart_and_move_no_totals_by_order(spark):
    for facts in (drawn(spark, 300, 9), drawn(spark, 300, 9).union(drawn(spark, 300, 9)), drawn(spark, 300, 9).filter("false")):
        got, want = marts.sales_of_stored(facts), marts.mart_monthly_sales(facts)
        assert got.dtypes == want.dtypes and rows(got) == rows(want)
    empty = spark.createDataFrame([(None, None, None, "a", None, None), ("1", 1, None, "a", None, None)], FACTS)  # sums of nothing stay NULL
    assert rows(marts.sales_of_stored(empty)) == rows(marts.mart_monthly_sales(empty)) == [(None, None, 1, None, None, None)]


def test_dealt_product_months_equal_the_grouped_ones(spark):
    facts = drawn(spark, 400, 60)
    want = marts.product_months(facts)
    for shares in (1, 3):
        got = marts.product_months(facts, shares)
        assert plan_text(got).split("(1) ")[0].count("Exchange") == 1
        assert got.dtypes == want.dtypes and rows(got) == rows(want)
    assert marts.product_shares(facts) == 0 and marts.product_shares(facts.filter("false")) == 0  # months hold most products twice
    sparse = drawn(spark, 400, 5000)
    assert marts.product_shares(sparse) == 1 and marts.product_shares(sparse, most=30) > 1


def test_a_refresh_shuffles_the_lines_of_a_month_once(spark, tmp_dir, monkeypatch):
    """Nearly every line is of another product: the month table is written from the tasks that the lines were dealt to."""
    facts = PartitionedTable(spark, os.path.join(tmp_dir, "f"), spark.createDataFrame([], FACTS).schema, "order_month",
                             by=F.date_format("order_date", "yyyy-MM"), zone=["order_number"])
    facts.replace(drawn(spark, 600, 5000), ["order_item_id"])
    written, write = [], PartitionedTable._write
    monkeypatch.setattr(PartitionedTable, "_write", lambda self, df, keys: (written.append(plan_text(df).split("(1) ")[0]), write(self, df, keys))[1])
    sold = marts.product_months_table(spark, os.path.join(tmp_dir, "p"))
    got = marts.refresh_months(sold, facts, marts.product_months, None)
    assert rows(got) == rows(marts.product_months(facts.read()))
    months = facts.merge(drawn(spark, 50, 5000, seed=2), ["order_item_id"])
    got = marts.refresh_months(sold, facts, marts.product_months, months)
    assert rows(got) == rows(marts.product_months(facts.read()))
    assert written[0].count("Exchange") == written[2].count("Exchange") == 1
    assert spark.table(sold.name).filter("month = '2024-01'").select(F.input_file_name()).distinct().count() == 1


def test_a_merge_takes_a_source_without_derived_columns(spark, tmp_dir):
    from pyspark.sql.types import StructType

    from test_moved_rows import FACTS as WHOLE
    from test_moved_rows import facts

    table = star.fact_order_items_table(spark, os.path.join(tmp_dir, "f"), StructType.fromDDL(WHOLE))
    table.replace(facts(spark, [(o, 1, "2024-01-15", 1) for o in range(20)]), ["order_item_id"])
    table.merge(facts(spark, [(3, 1, "2024-02-15", 9), (30, 1, None, 9)]).drop(*table.derived), ["order_item_id"])
    assert rows(table.read()) == rows(facts(spark, [*((o, 1, "2024-01-15", 1) for o in range(20) if o != 3), (3, 1, "2024-02-15", 9), (30, 1, None, 9)]))


def test_a_slice_ranks_no_other_lines_of_orders_that_got_a_line(spark):
    """Orders 0 to 999 have lines 0 to 3 of an older day; of each tenth order a line is sent again on the day, every hundredth order is sent itself,
    and lines without a number come too."""
    day, old = "2024-01-02", "2024-01-01"
    lines = [(o, f"p{n}", 1, 2.5, n, f"{old} 00:00:00", old, "s") for o in range(1000) for n in range(4)]
    lines += [(o, "new", 7, 1.5, 1, f"{day} 00:00:00", day, "s") for o in range(0, 1000, 10)]
    lines += [(5, "a", 1, 1.0, None, f"{old} 00:00:00", old, "s"), (5, "b", 2, 1.0, None, f"{day} 00:00:00", day, "s"), (None, "c", 1, 1.0, 1, f"{day} 00:00:00", day, "s")]
    lines += [(10, "older", 9, 1.0, 1, f"{old} 05:00:00", "2024-01-03", "s")]  # a newer version than the day's: not in the slice
    orders = [(o, "2024-01-01", None, None, "Shipped", 4, f"{old} 00:00:00", old, "s") for o in range(1000)]
    orders += [(o, "2024-01-01", None, None, "Done", 4, f"{day} 00:00:00", day, "s") for o in range(0, 1000, 100)]
    d, o = spark.createDataFrame(lines, LINES), spark.createDataFrame(orders, ORDERS)
    got, want = star.fact_order_items_slice(d, o, day), star.fact_order_items_of(d, o, day)
    assert rows(got) == rows(want) and got.count() == 100 - 1 + 10 * 3 + 1
    of_day = [x.filter(F.col("processing_date") == day) for x in (d, o)]
    kept = star._lines_of_day(d, *of_day, *(x.count() for x in of_day))
    assert kept.columns == d.columns and kept.count() < 300  # 101 orders have more than 400 lines
    assert rows(kept.filter("orderNumber = 5 and orderLineNumber is null"), "productCode") == [("a",), ("b",)]
