"""Reporting marts over the star schema."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from daybook.sinks.tables import PartitionedTable

# Money totals keep the line scale with the widest precision: a month's or a product's sales at
# 100 TB exceed decimal(18,4)'s 10^14 (ANSI mode would fail the job on overflow).
TOTAL = "decimal(38,4)"


def mart_monthly_sales(fact_order_items: DataFrame) -> DataFrame:
    """Orders, units and sales per calendar month, over all history.

    ``count(distinct)`` is planned as a two-level aggregate (partial on (month, order) first),
    so a busy month never ships all of its lines to one task.
    """
    d = F.col("order_date")
    return (fact_order_items.groupBy(F.year(d).cast("int").alias("sales_year"),
                                     F.month(d).cast("int").alias("sales_month"))
            .agg(F.count_distinct("order_number").alias("order_count"),
                 F.sum("quantity_ordered").cast("bigint").alias("units_sold"),
                 F.sum("gross_amount").cast(TOTAL).alias("gross_sales"),
                 F.avg("gross_amount").cast("decimal(18,4)").alias("average_order_line_amount")))


def sales_of_stored(fact_order_items: DataFrame) -> DataFrame:
    """``mart_monthly_sales`` of facts that are written, and so can be read twice: the totals, and the months' orders.

    Of an order only its number is moved; the single aggregate would move its totals with it.
    """
    d = F.col("order_date")
    month = [F.year(d).cast("int").alias("sales_year"), F.month(d).cast("int").alias("sales_month")]
    totals = fact_order_items.groupBy(*month).agg(F.lit(0).cast("bigint").alias("order_count"), F.sum("quantity_ordered").cast("bigint").alias("units_sold"),
                                                  F.sum("gross_amount").cast(TOTAL).alias("gross_sales"), F.avg("gross_amount").cast("decimal(18,4)").alias("average_order_line_amount"))
    orders = fact_order_items.select(*month, "order_number").distinct().groupBy("sales_year", "sales_month").agg(F.count("order_number").alias("order_count"))
    # one row of either kind for each month, NULL among them
    return totals.unionByName(orders, allowMissingColumns=True).groupBy("sales_year", "sales_month").agg(
        F.max("order_count").alias("order_count"), *[F.max(c).alias(c) for c in ("units_sold", "gross_sales", "average_order_line_amount")])


def mart_product_performance(dim_products: DataFrame, fact_order_items: DataFrame,
                             fact_product_ratings: DataFrame) -> DataFrame:
    """Each product with its sales and rating totals; both sides aggregated before the joins."""
    sales = fact_order_items.groupBy("product_code").agg(
        F.sum("quantity_ordered").cast("bigint").alias("units_sold"),
        F.sum("gross_amount").cast(TOTAL).alias("gross_sales"))
    ratings = fact_product_ratings.groupBy("product_code").agg(
        F.count(F.lit(1)).alias("rating_count"),
        F.avg(F.col("product_rating").cast("decimal(10,2)")).cast("decimal(10,2)").alias("average_rating"))
    return _performance(dim_products, sales, ratings)


def _performance(dim_products: DataFrame, sales: DataFrame, ratings: DataFrame) -> DataFrame:
    return (dim_products.join(sales, "product_code", "left").join(ratings, "product_code", "left")
            .select("product_code", "product_name", "product_line", "product_vendor",
                    F.coalesce("units_sold", F.lit(0).cast("bigint")).alias("units_sold"),
                    F.coalesce("gross_sales", F.lit(0).cast(TOTAL)).alias("gross_sales"),
                    F.coalesce("rating_count", F.lit(0).cast("bigint")).alias("rating_count"),
                    "average_rating"))


# --- kept up to date from the months that a merge rewrote ---


def product_months(fact_order_items: DataFrame, shares: int = 0) -> DataFrame:
    """Units and sales of each product and month: what a month adds to ``mart_product_performance``.

    With ``shares`` the lines are dealt by month and that many shares of the products first, so that a
    month's rows lie in as many tasks."""
    totals = [F.sum("quantity_ordered").cast("bigint").alias("units_sold"), F.sum("gross_amount").cast(TOTAL).alias("gross_sales")]
    if not shares:
        return fact_order_items.groupBy(F.date_format("order_date", "yyyy-MM").alias("month"), "product_code").agg(*totals)
    lines = fact_order_items.select("product_code", F.trunc("order_date", "month").alias("_first"), "quantity_ordered", "gross_amount")
    by = ["_first"]
    if shares > 1:
        lines, by = lines.withColumn("_share", F.pmod(F.xxhash64("product_code"), F.lit(shares))), ["_first", "_share"]
    found = lines.repartition(*by).groupBy(*by, "product_code").agg(*totals)
    return found.select(F.date_format("_first", "yyyy-MM").alias("month"), "product_code", "units_sold", "gross_sales")


def product_shares(fact_order_items: DataFrame, most: int = 1_000_000) -> int:
    """Into how many shares ``product_months`` best deals a month's lines, for about ``most`` lines a share; 0 where
    months hold most of their products twice: then partial sums are fewer than the lines."""
    months = fact_order_items.groupBy(F.date_format("order_date", "yyyy-MM")).agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct("product_code").alias("products"))
    found = months.agg(F.sum("n").alias("n"), F.max("n").alias("largest"), F.sum("products").alias("products")).first()
    return 0 if not found.n or found.n >= 2 * found.products else -(-found.largest // most)


def rating_months(fact_product_ratings: DataFrame) -> DataFrame:
    """Number of ratings, of those with a value, and their sum, of each product and month."""
    return fact_product_ratings.groupBy(F.date_format("rating_timestamp", "yyyy-MM").alias("month"), "product_code").agg(
        F.count(F.lit(1)).alias("rating_count"), F.count("product_rating").alias("rated"), F.sum("product_rating").cast("bigint").alias("stars"))


def product_performance(dim_products: DataFrame, sales_months: DataFrame, ratings_months: DataFrame) -> DataFrame:
    """``mart_product_performance`` from the products' months: a few rows for each product instead of all facts."""
    sales = sales_months.groupBy("product_code").agg(F.sum("units_sold").cast("bigint").alias("units_sold"),
                                                     F.sum("gross_sales").cast(TOTAL).alias("gross_sales"))
    whole = [F.sum(c).cast("decimal(20,0)") for c in ("stars", "rated")]
    ratings = ratings_months.groupBy("product_code").agg(
        F.sum("rating_count").cast("bigint").alias("rating_count"),
        F.when(F.sum("rated") > 0, (whole[0] / whole[1]).cast("decimal(14,6)").cast("decimal(10,2)")).alias("average_rating"))
    return _performance(dim_products, sales, ratings)


def sales_table(spark: SparkSession, path: str) -> PartitionedTable:
    """``mart_monthly_sales`` as a table that is replaced month by month."""
    schema = StructType.fromDDL(f"sales_year int, sales_month int, order_count bigint, units_sold bigint, gross_sales {TOTAL}, "
                                "average_order_line_amount decimal(18,4)")
    month = F.when(F.col("sales_year").isNotNull(), F.format_string("%04d-%02d", "sales_year", "sales_month"))
    return PartitionedTable(spark, path, schema, "month", by=month)


def product_months_table(spark: SparkSession, path: str) -> PartitionedTable:
    return PartitionedTable(spark, path, StructType.fromDDL(f"month string, product_code string, units_sold bigint, gross_sales {TOTAL}"), "month")


def rating_months_table(spark: SparkSession, path: str) -> PartitionedTable:
    return PartitionedTable(spark, path, StructType.fromDDL("month string, product_code string, rating_count bigint, rated bigint, stars bigint"), "month")


def refresh_months(table: PartitionedTable, facts: PartitionedTable, build: Callable[[DataFrame], DataFrame], months: list | None) -> DataFrame:
    """Bring a table of months up to date with the facts: ``months``, the partitions of the facts that changed,
    are built anew from those partitions alone, all of them if the table is new or ``months`` is null.

    The facts are written, so they can be read twice: ``mart_monthly_sales`` and ``product_months`` are built
    in the way that moves least (``sales_of_stored``, ``product_shares``)."""
    whole = months is None or not table.exists()
    stored = facts.read() if whole else facts.read_partitions(months)
    shares = product_shares(stored) if build is product_months else 0
    built = sales_of_stored(stored) if build is mart_monthly_sales else build(stored, shares) if shares else build(stored)
    if whole:
        table.replace(built, dealt=shares > 0)
    else:
        table.replace_partitions(built, months, dealt=shares > 0)
    return table.read()
