"""Presentation tables refreshed from curated data (newest batch only, as the reports define it)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_partition(df: DataFrame, column: str = "processing_date") -> DataFrame:
    """Rows of the newest partition.

    The scalar ``max`` is an uncorrelated subquery; on a partitioned table it becomes a
    ``PartitionFilters`` entry and the max itself is answered from partition metadata.
    """
    return df.filter(F.col(column) == df.select(F.max(column)).scalar())


def sales_report(orders: DataFrame, orderdetails: DataFrame) -> DataFrame:
    """Monthly sales of the newest orders batch; lines must come from the same batch as their order."""
    o = latest_partition(orders).alias("o")
    od = orderdetails.alias("od")
    j = o.join(od, (F.col("o.orderNumber") == F.col("od.orderNumber"))
               & (F.col("o.processing_date") == F.col("od.processing_date")), "inner")
    # summed exactly (the order of additions cannot show), cast to double at the end
    line = F.col("od.quantityOrdered").cast("decimal(18,0)") * F.col("od.priceEach").cast("decimal(18,6)")
    return (j.groupBy(F.year("o.orderDate").cast("int").alias("sales_year"),
                      F.month("o.orderDate").cast("int").alias("sales_month"))
            .agg(F.count_distinct("o.orderNumber").alias("order_count"),
                 F.sum(line).cast("double").alias("gross_sales"),
                 (F.sum(line).cast("double") / F.count(line)).alias("average_order_line_amount")))


def ratings_per_product(products: DataFrame, ratings_for_ml: DataFrame) -> DataFrame:
    """Products of the newest products batch with the count and mean of all their ratings ever.

    Ratings are aggregated per product before the join (partial aggregation; a product with a
    third of all ratings is combined map-side instead of being joined row by row).
    """
    p = latest_partition(products).select("productCode", "productName")
    r = ratings_for_ml.groupBy("productCode").agg(
        F.count("productRating").alias("rating_count"),
        F.sum(F.col("productRating").cast("double")).alias("_sum"))
    return (p.join(r, "productCode", "left")
            .groupBy("productCode", "productName")
            .agg(F.coalesce(F.sum("rating_count"), F.lit(0)).cast("bigint").alias("rating_count"),
                 F.try_divide(F.sum("_sum"), F.sum("rating_count")).alias("average_rating")))


def presentation_ratings(ratings: DataFrame) -> DataFrame:
    """Copy of the current-state ratings without ``source``."""
    return ratings.select("customerNumber", "productCode", "productRating", "ratingTimestamp", "ingest_ts",
                          "processing_date")


def presentation_ratings_for_ml(ratings_for_ml: DataFrame) -> DataFrame:
    return ratings_for_ml.select("*")
