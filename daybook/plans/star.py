"""Star schema: facts and dimensions built from staging; incremental slices and merges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from daybook.functions import date_key, month_name, surrogate_key, ts_text, weekday_sun0
from daybook.operators.upsert import upsert
from daybook.sinks.tables import PartitionedTable
from daybook.spec import RATING_KEYS


def fact_order_items(stg_orderdetails: DataFrame, stg_orders: DataFrame, processing_date: str | None = None
                     ) -> DataFrame:
    """One row per order line joined to its order (lines without an order are dropped, as modelled).

    With ``processing_date`` only lines or orders of that day are kept (the OR across both sides).
    For a daily increment use ``fact_order_items_slice``, which avoids ranking all of history.
    """
    d = stg_orderdetails.alias("d")
    o = stg_orders.alias("o")
    joined = d.join(o, F.col("d.order_number") == F.col("o.order_number"), "inner")
    if processing_date is not None:
        day = F.lit(processing_date)
        joined = joined.filter((F.col("d.processing_date") == day) | (F.col("o.processing_date") == day))
    return joined.select(
        surrogate_key(F.col("d.order_number"), F.col("d.order_line_number")).alias("order_item_id"),
        F.col("d.order_number").alias("order_number"),
        F.col("d.order_line_number").alias("order_line_number"),
        F.col("o.customer_number").alias("customer_number"),
        F.col("d.product_code").alias("product_code"),
        date_key(F.col("o.order_date")).alias("order_date_key"),
        F.col("o.order_date").alias("order_date"),
        F.col("o.order_status").alias("order_status"),
        F.col("d.quantity_ordered").alias("quantity_ordered"),
        F.col("d.price_each").alias("price_each"),
        F.col("d.gross_amount").alias("gross_amount"),
    )


def fact_order_items_of(curated_orderdetails: DataFrame, curated_orders: DataFrame, processing_date: str | None = None) -> DataFrame:
    """``fact_order_items`` of curated tables. The lines are dealt by order before they are ranked, so that
    ranking and join share one shuffle."""
    from daybook.plans import staging

    return fact_order_items(staging.stg_orderdetails(curated_orderdetails.repartition("orderNumber")), staging.stg_orders(curated_orders), processing_date)


def fact_order_items_table(spark: SparkSession, path: str, schema: StructType) -> PartitionedTable:
    """Order lines by month of their order. A line's key holds its order number; key and day key follow one to one
    from the number of order and line, and from the day."""
    derived = {"order_item_id": (["order_number", "order_line_number"], surrogate_key(F.col("order_number"), F.col("order_line_number"))),
               "order_date_key": (["order_date"], date_key(F.col("order_date")))}
    return PartitionedTable(spark, path, schema, "order_month", by=F.date_format("order_date", "yyyy-MM"), zone=["order_number"], derived=derived)


def day_keys(curated: DataFrame, key: str, processing_date: str) -> DataFrame:
    """Distinct keys present in one day's partition (a pruned scan of that partition only)."""
    return curated.filter(F.col("processing_date") == processing_date).select(key).distinct()


def fact_order_items_slice(curated_orderdetails: DataFrame, curated_orders: DataFrame,
                           processing_date: str) -> DataFrame:
    """The day's fact slice without ranking all of history.

    A fact row can only be in the slice if its order number occurs in the day's partition of
    either table, so both curated tables are first semi-joined to that (small) key set: all
    versions of the affected orders survive, which is what the staging ranking needs, and the
    OR filter is applied after the join exactly as before. The key set is the day's distinct
    order numbers; AQE broadcasts it when small, so history is scanned but not shuffled. A larger set is asked
    through a filter first (sized by the day's rows, which are counted here): only affected orders are shuffled,
    and of the lines only those of the day's orders and all versions of the day's lines.
    """
    from daybook.operators.prefilter import split_by_key
    from daybook.plans import staging

    d, o = [df.filter(F.col("processing_date") == processing_date) for df in (curated_orderdetails, curated_orders)]
    n_lines, n_orders = d.count(), o.count()
    day = d.select("orderNumber").union(o.select("orderNumber"))
    keys = day.distinct()
    lines = _lines_of_day(curated_orderdetails, d, o, n_lines, n_orders).join(keys, "orderNumber", "left_semi")
    orders = split_by_key(curated_orders, day, ["orderNumber"], n_lines + n_orders)[0].join(keys, "orderNumber", "left_semi")
    return fact_order_items(staging.stg_orderdetails(lines), staging.stg_orders(orders), processing_date)


def _lines_of_day(lines: DataFrame, day_lines: DataFrame, day_orders: DataFrame, n_lines: int, n_orders: int) -> DataFrame:
    """Lines of the day's orders and all versions of the day's lines, with few others: what a slice ranks. A line of
    neither is never in the slice, even if another line of its order came on the day."""
    from daybook.operators.prefilter import flag_by_key

    # a line number may be NULL (versions of such lines are ranked together): both numbers as one hash, which never is
    line = F.xxhash64("orderNumber", "orderLineNumber").alias("_line")
    found = flag_by_key(lines.select("*", line), day_lines.select(line), ["_line"], n_lines, "_sent")
    found = found if found is None else flag_by_key(found, day_orders, ["orderNumber"], n_orders, "_ordered")
    return lines if found is None else found.filter("_sent or _ordered").select(*lines.columns)


def dim_slice(curated: DataFrame, key: str, processing_date: str, stage_fn, dim_fn) -> DataFrame:
    """The day's dimension slice (keys whose newest version belongs to the day), ranking only
    the keys present in that day's partition, with all of their versions."""
    affected = curated.join(day_keys(curated, key, processing_date), key, "left_semi")
    return dim_fn(stage_fn(affected), processing_date=processing_date)


def fact_product_ratings(stg_ratings: DataFrame, processing_date: str | None = None) -> DataFrame:
    src = stg_ratings if processing_date is None else stg_ratings.filter(F.col("processing_date") == processing_date)
    return src.select(
        surrogate_key(F.col("customer_number"), F.col("product_code"), ts_text(F.col("rating_timestamp")))
        .alias("rating_id"),
        "customer_number", "product_code", "product_rating", "rating_timestamp",
    )


def fact_product_ratings_slice(ratings_for_ml: DataFrame, processing_date: str) -> DataFrame:
    """The day's rating facts, ranking only the events whose key occurs in the day's partition."""
    from daybook.plans import staging

    keys = ratings_for_ml.filter(F.col("processing_date") == processing_date).select(*RATING_KEYS).distinct()
    affected = ratings_for_ml.join(keys, list(RATING_KEYS), "left_semi")
    return fact_product_ratings(staging.stg_ratings(affected), processing_date)


def dim_customers(stg_customers: DataFrame, processing_date: str | None = None) -> DataFrame:
    src = stg_customers if processing_date is None else stg_customers.filter(F.col("processing_date") == processing_date)
    return src.select("customer_number", "customer_name", "contact_first_name", "contact_last_name", "phone",
                      "city", "state", "country", "credit_limit")


def dim_products(stg_products: DataFrame, processing_date: str | None = None) -> DataFrame:
    src = stg_products if processing_date is None else stg_products.filter(F.col("processing_date") == processing_date)
    return src.select("product_code", "product_name", "product_line", "product_vendor", "quantity_in_stock",
                      "buy_price", "msrp")


def dim_date(fact: DataFrame) -> DataFrame:
    d = F.col("date_day")
    return (fact.select(F.col("order_date").alias("date_day")).filter(d.isNotNull()).distinct()
            .select(
                date_key(d).alias("date_key"),
                d,
                F.year(d).cast("int").alias("year_number"),
                F.month(d).cast("int").alias("month_number"),
                month_name(d).alias("month_name"),
                F.quarter(d).cast("int").alias("quarter_number"),
                weekday_sun0(d).alias("day_of_week_number"),
            ))


def build_incremental(existing: DataFrame | None, fresh_slice: DataFrame, unique_key: str,
                      check_unique: bool = True) -> DataFrame:
    """Incremental model: the first run is the full build; later runs merge the day's slice.

    Model rows built from staging are unique on their key by construction (staging keeps one row
    per business key and the joins are many-to-one), so callers may skip the duplicate-source pass.
    """
    if existing is None:
        return fresh_slice
    return upsert(existing, fresh_slice, [unique_key], check_unique=check_unique)
