"""Staging views: newest version per key across all curated partitions, renamed and typed.

Rank first (by processing_date, then ingest_ts, then the full row), slice later: a back-filled old
day never replaces a newer version (the incremental models filter after this ranking).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.operators.dedupe import latest_by

MONEY = "decimal(18,2)"


def _latest(df: DataFrame, keys: list[str], order=("processing_date", "ingest_ts")) -> DataFrame:
    return latest_by(df, keys, list(order))


def stg_customers(curated: DataFrame) -> DataFrame:
    src = curated.filter(F.col("customerNumber").isNotNull())
    d = _latest(src, ["customerNumber"])
    return d.select(
        F.col("customerNumber").cast("bigint").alias("customer_number"),
        F.trim("customerName").alias("customer_name"),
        F.trim("contactFirstName").alias("contact_first_name"),
        F.trim("contactLastName").alias("contact_last_name"),
        F.trim("phone").alias("phone"),
        F.trim("city").alias("city"),
        F.trim("state").alias("state"),
        F.trim("country").alias("country"),
        F.col("creditLimit").cast(MONEY).alias("credit_limit"),
        F.col("ingest_ts").cast("timestamp").alias("ingest_ts"),
        "processing_date",
        "source",
    )


def stg_products(curated: DataFrame) -> DataFrame:
    src = curated.filter(F.col("productCode").isNotNull())
    d = _latest(src, ["productCode"])
    return d.select(
        F.trim("productCode").alias("product_code"),
        F.trim("productName").alias("product_name"),
        F.trim("productLine").alias("product_line"),
        F.trim("productVendor").alias("product_vendor"),
        F.col("quantityInStock").cast("int").alias("quantity_in_stock"),
        F.col("buyPrice").cast(MONEY).alias("buy_price"),
        F.col("MSRP").cast(MONEY).alias("msrp"),
        F.col("ingest_ts").cast("timestamp").alias("ingest_ts"),
        "processing_date",
        "source",
    )


def stg_orders(curated: DataFrame) -> DataFrame:
    src = curated.filter(F.col("orderNumber").isNotNull())
    d = _latest(src, ["orderNumber"])
    return d.select(
        F.col("orderNumber").cast("bigint").alias("order_number"),
        F.col("customerNumber").cast("bigint").alias("customer_number"),
        F.col("orderDate").try_cast("date").alias("order_date"),
        F.col("requiredDate").try_cast("date").alias("required_date"),
        F.col("shippedDate").try_cast("date").alias("shipped_date"),
        F.upper(F.trim("status")).alias("order_status"),
        F.col("ingest_ts").cast("timestamp").alias("ingest_ts"),
        "processing_date",
        "source",
    )


def stg_orderdetails(curated: DataFrame) -> DataFrame:
    src = curated.filter(F.col("orderNumber").isNotNull() & F.col("productCode").isNotNull())
    d = _latest(src, ["orderNumber", "orderLineNumber"])
    qty = F.col("quantityOrdered").cast(MONEY)
    price = F.col("priceEach").cast(MONEY)
    return d.select(
        F.col("orderNumber").cast("bigint").alias("order_number"),
        F.trim("productCode").alias("product_code"),
        F.col("quantityOrdered").cast("int").alias("quantity_ordered"),
        price.alias("price_each"),
        F.col("orderLineNumber").cast("int").alias("order_line_number"),
        (qty * price).cast("decimal(18,4)").alias("gross_amount"),
        F.col("ingest_ts").cast("timestamp").alias("ingest_ts"),
        "processing_date",
        "source",
    )


def stg_ratings(ratings_for_ml: DataFrame) -> DataFrame:
    src = ratings_for_ml.filter(F.col("customerNumber").isNotNull() & F.col("productCode").isNotNull())
    d = latest_by(src, ["customerNumber", "productCode", "ratingTimestamp"], ["processing_ts", "ingest_ts"])
    return d.select(
        F.col("customerNumber").cast("bigint").alias("customer_number"),
        F.trim("productCode").alias("product_code"),
        F.col("productRating").cast("int").alias("product_rating"),
        F.coalesce("ratingTimestamp", "ingest_ts").cast("timestamp").alias("rating_timestamp"),
        F.col("ingest_ts").cast("timestamp").alias("ingest_ts"),
        "processing_date",
        "source",
    )
