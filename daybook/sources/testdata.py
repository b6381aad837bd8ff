"""Adaptation of the driver's TPC-H-like tables to the pipeline's source shapes.

Every shape reads whole tables and only re-expresses them (renames, derived versions, injected
defects computed from the rows themselves), so the work grows with the data. The DuckDB oracle
builds the same shapes in SQL (``oracle/shapes.py``); both sides must stay in step.

Fixed values of the adaptation (dates of the three master versions and which rows get a newer or
a back-filled version):
  base day 2024-01-01 (ingest 03:00), newer day 2024-01-02 (ingest 03:00),
  back-filled day 2023-12-31 arriving 2024-01-03 03:00;
  customers: BUILDING segment newer (+500 credit), MACHINERY back-filled (-250 credit, renamed);
  products:  ECONOMY type newer (+5 stock, +10 MSRP), STANDARD back-filled (renamed);
  orders:    open orders ('O') re-sent 30 days later in the same yearly batch with status 'Complete'.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook import fixed_values as FV

BASE_DAY, NEWER_DAY, BACKFILL_DAY = "2024-01-01", "2024-01-02", "2023-12-31"
BASE_TS, NEWER_TS, BACKFILL_TS = "2024-01-01 03:00:00", "2024-01-02 03:00:00", "2024-01-03 03:00:00"
CURATED_SOURCE = FV.SOURCE_CURATED
LANDING_SOURCE = FV.SOURCE_DATABASE


_READS: dict = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table. The inputs are read-only, so one session reuses the same scan DataFrame
    (saves the file listing and footer read on every query; plans are unaffected)."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (id(spark), spark.sparkContext.applicationId, path)
    df = _READS.get(key)
    if df is None:
        df = _READS[key] = spark.read.parquet(path)
    return df


def _ts(text: str) -> Column:
    return F.to_timestamp(F.lit(text))


def _version(df: DataFrame, day: str, ts: str, source: str = CURATED_SOURCE) -> DataFrame:
    return df.withColumns({"ingest_ts": _ts(ts), "processing_date": F.lit(day), "source": F.lit(source)})


def _year_batch(c: Column, add: int = 0) -> Column:
    """Batch day of a row = 31 December of its year (orders, lines and payments land yearly)."""
    return F.concat((F.year(c) + add).cast("string"), F.lit("-12-31"))


def unit_price_cents(ext: Column, qty: Column) -> Column:
    """Whole-cent unit price of a line (extended price in cents / quantity, rounded down)."""
    return F.floor(F.floor(ext * 100 + 0.5) / qty.cast("bigint"))


def cents_text(c: Column) -> Column:
    return F.concat(F.floor(c / 100).cast("string"), F.lit("."), F.lpad((c % 100).cast("string"), 2, "0"))


# ---------------------------------------------------------------- curated (typed) masters ----

def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    geo = n.join(r, n.n_regionkey == r.r_regionkey, "left").select("n_nationkey", "n_name", "r_name")
    base = c.join(geo, c.c_nationkey == geo.n_nationkey, "left")

    def shape(df: DataFrame, name: Column, credit: Column) -> DataFrame:
        return df.select(
            F.col("c_custkey").alias("customerNumber"),
            name.alias("customerName"),
            F.col("c_mktsegment").alias("contactLastName"),
            F.concat(F.lit(" Contact "), F.col("c_custkey").cast("string"), F.lit(" ")).alias("contactFirstName"),
            F.concat((F.col("c_nationkey") + 10).cast("string"), F.lit("-"),
                     F.lpad(F.col("c_custkey").cast("string"), 7, "0")).alias("phone"),
            F.concat(F.col("n_name"), F.lit(" CITY")).alias("city"),
            F.col("r_name").alias("state"),
            F.col("n_name").alias("country"),
            F.col("c_nationkey").cast("string").alias("salesRepEmployeeNumber"),
            credit.alias("creditLimit"),
        )

    v0 = _version(shape(base, F.col("c_name"), F.col("c_acctbal")), BASE_DAY, BASE_TS)
    v1 = _version(shape(base.filter(F.col("c_mktsegment") == "BUILDING"), F.col("c_name"),
                        F.col("c_acctbal") + 500.0), NEWER_DAY, NEWER_TS)
    v2 = _version(shape(base.filter(F.col("c_mktsegment") == "MACHINERY"),
                        F.concat(F.upper("c_name"), F.lit(" (OLD)")), F.col("c_acctbal") - 250.0),
                  BACKFILL_DAY, BACKFILL_TS)
    return v0.unionByName(v1).unionByName(v2)


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")

    def shape(df: DataFrame, name: Column, stock: Column, msrp: Column) -> DataFrame:
        return df.select(
            F.col("p_partkey").cast("string").alias("productCode"),
            name.alias("productName"),
            F.col("p_brand").alias("productLine"),
            F.concat(F.lit("1:"), F.col("p_size").cast("string")).alias("productScale"),
            F.col("p_type").alias("productVendor"),
            F.concat(F.col("p_name"), F.lit(" by "), F.col("p_brand")).alias("productDescription"),
            stock.alias("quantityInStock"),
            (F.col("p_retailprice") * 0.6).alias("buyPrice"),
            msrp.alias("MSRP"),
        )

    v0 = _version(shape(p, F.col("p_name"), F.col("p_size"), F.col("p_retailprice")), BASE_DAY, BASE_TS)
    v1 = _version(shape(p.filter(F.col("p_type") == "ECONOMY"), F.col("p_name"), F.col("p_size") + 5,
                        F.col("p_retailprice") + 10.0), NEWER_DAY, NEWER_TS)
    v2 = _version(shape(p.filter(F.col("p_type") == "STANDARD"), F.upper("p_name"), F.col("p_size"),
                        F.col("p_retailprice")), BACKFILL_DAY, BACKFILL_TS)
    return v0.unionByName(v1).unionByName(v2)


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    d = F.col("o_orderdate").cast("date")

    def shape(df: DataFrame, status: Column, ts: Column, batch: Column) -> DataFrame:
        return df.select(
            F.col("o_orderkey").alias("orderNumber"),
            d.alias("orderDate"),
            F.date_add(d, 7).cast("string").alias("requiredDate"),
            F.when(F.col("o_orderstatus") == "F", F.date_add(d, 2).cast("string")).alias("shippedDate"),
            status.alias("status"),
            F.col("o_orderpriority").alias("comments"),
            F.col("o_custkey").alias("customerNumber"),
            ts.alias("ingest_ts"),
            batch.alias("processing_date"),
            F.lit(CURATED_SOURCE).alias("source"),
        )

    status = (F.when(F.col("o_orderstatus") == "F", "Shipped").when(F.col("o_orderstatus") == "O", "In Process")
              .when(F.col("o_orderstatus") == "P", "On Hold"))
    ts = F.col("o_orderdate").cast("timestamp")
    v0 = shape(o, status, ts, _year_batch(F.col("o_orderdate")))
    v1 = shape(o.filter(F.col("o_orderstatus") == "O"), F.lit("Complete"), ts + F.expr("INTERVAL 30 DAYS"),
               _year_batch(F.col("o_orderdate")))
    return v0.unionByName(v1)


def orderdetails(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("orderNumber"),
        F.col("l_partkey").cast("string").alias("productCode"),
        F.col("l_quantity").cast("int").alias("quantityOrdered"),
        (unit_price_cents(F.col("l_extendedprice"), F.col("l_quantity")) / 100.0).alias("priceEach"),
        F.col("l_linenumber").alias("orderLineNumber"),
        F.col("l_shipdate").cast("timestamp").alias("ingest_ts"),
        _year_batch(F.col("l_shipdate")).alias("processing_date"),
        F.lit(CURATED_SOURCE).alias("source"),
    )


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_custkey").alias("customerNumber"),
        F.concat(F.lit("CHK-"), F.col("o_orderkey").cast("string")).alias("checkNumber"),
        F.col("o_orderdate").cast("date").alias("paymentDate"),
        F.col("o_totalprice").alias("amount"),
        F.col("o_orderdate").cast("timestamp").alias("ingest_ts"),
        _year_batch(F.col("o_orderdate")).alias("processing_date"),
        F.lit(CURATED_SOURCE).alias("source"),
    )


# ------------------------------------------------------------ landed (all-string) batches ----

def _code(expr: Column, modulus: int) -> Column:
    return expr % modulus


def landed_orderdetails(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as landed CSV text, with typing and rule defects injected by a row code."""
    li = table(spark, sf_dir, "lineitem")
    code = _code(F.col("l_orderkey") * 7 + F.col("l_linenumber"), 100)
    qty = F.col("l_quantity").cast("int").cast("string")
    price = cents_text(unit_price_cents(F.col("l_extendedprice"), F.col("l_quantity")))
    return li.select(
        F.when(code.isin(0, 11), F.lit(None)).otherwise(F.col("l_orderkey").cast("string")).alias("orderNumber"),
        F.col("l_partkey").cast("string").alias("productCode"),
        F.when(code == 2, "abc").when(code.isin(3, 8), "0").when(code.isin(4, 11), "-1").when(code == 5, " 12 ")
         .when(code == 10, "99999999999").otherwise(qty).alias("quantityOrdered"),
        F.when(code == 6, "-0.01").when(code == 7, "").when(code == 8, "-5.00").when(code == 9, "0")
         .otherwise(price).alias("priceEach"),
        F.when(code == 1, F.lit(None)).otherwise(F.col("l_linenumber").cast("string")).alias("orderLineNumber"),
        F.col("l_shipdate").cast("timestamp").cast("string").alias("ingest_ts"),
        F.lit(LANDING_SOURCE).alias("source"),
        _year_batch(F.col("l_shipdate")).alias("processing_date"),
    )


def landed_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    code = _code(F.col("p_partkey"), 50)
    cents = F.floor(F.col("p_retailprice") * 100 + 0.5)
    return p.select(
        F.when(code == 0, F.lit(None)).otherwise(F.col("p_partkey").cast("string")).alias("productCode"),
        F.col("p_name").alias("productName"),
        F.col("p_brand").alias("productLine"),
        F.col("p_type").alias("productVendor"),
        F.when(code == 1, "").when(code == 2, "-3").when(code.isin(6, 7), "-1")
         .otherwise(F.col("p_size").cast("string")).alias("quantityInStock"),
        F.when(code == 3, "n/a").when(code.isin(4, 7), "-1.50")
         .otherwise(cents_text(F.floor(cents * 6 / 10))).alias("buyPrice"),
        F.when(code == 5, F.lit(None)).when(code.isin(6, 7), "-10").otherwise(cents_text(cents)).alias("MSRP"),
        F.lit(BASE_TS).alias("ingest_ts"),
        F.lit(LANDING_SOURCE).alias("source"),
        F.lit(BASE_DAY).alias("processing_date"),
    )


def landed_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    code = _code(F.col("o_orderkey"), 40)
    return o.select(
        F.when(code == 0, F.lit(None)).otherwise(F.col("o_custkey").cast("string")).alias("customerNumber"),
        F.when(code == 1, F.lit(None)).otherwise(F.concat(F.lit("CHK-"), F.col("o_orderkey").cast("string")))
         .alias("checkNumber"),
        F.col("o_orderdate").cast("date").cast("string").alias("paymentDate"),
        F.when(code == 2, "x").when(code == 3, "-5.00").when(code == 4, F.lit(None))
         .otherwise(cents_text(F.floor(F.col("o_totalprice") * 100 + 0.5))).alias("amount"),
        F.col("o_orderdate").cast("timestamp").cast("string").alias("ingest_ts"),
        F.lit(LANDING_SOURCE).alias("source"),
        _year_batch(F.col("o_orderdate")).alias("processing_date"),
    )


def landed_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rating events from ``events``: user -> customer, props.k -> product, value -> rating.

    Injected: unknown customers (event_id % 101), null customers (% 89), null ratings (% 97),
    missing rating times (% 83), unknown products (k >= 95), a blank product code (k = 90); ratings are
    text as in the JSON feed, some written as whole (% 53: 5.0) or broken (% 59: 4.5) decimals.
    """
    e = table(spark, sf_dir, "events")
    # the JSON lookup runs once in its own projection (Catalyst keeps a non-cheap expression that
    # is referenced several times as a column instead of inlining it into every use)
    base = e.select("event_id", "user_id", "value", "event_type", F.col("ts").cast("timestamp").alias("ts"),
                    F.get_json_object("props", "$.k").cast("int").alias("k"))
    k, ts, eid = F.col("k"), F.col("ts"), F.col("event_id")
    rating = (F.floor("value") % 7).cast("string")
    return base.select(
        F.when(eid % 89 == 0, F.lit(None)).when(eid % 101 == 0, F.col("user_id") + 1000000)
         .otherwise(F.col("user_id")).alias("customerNumber"),
        F.when(k >= 95, F.concat(F.lit("X"), k.cast("string"))).when(k == 90, F.lit(" "))
         .otherwise((k % 10).cast("string")).alias("productCode"),
        F.when(eid % 97 == 0, F.lit(None)).when(eid % 53 == 0, F.concat(rating, F.lit(".0")))
         .when(eid % 59 == 0, F.concat(rating, F.lit(".5"))).otherwise(rating).alias("productRating"),
        F.when(eid % 83 == 0, F.lit(None)).otherwise(F.date_trunc("day", ts)).alias("ratingTimestamp"),
        ts.alias("ingest_ts"),
        F.concat(F.lit("ratings/"), F.col("event_type"), F.lit(".json")).alias("source"),
        ts.cast("date").cast("string").alias("processing_date"),
    )


def landed_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All eight relational tables as landed text (offices, employees and productlines included)."""
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    s = table(spark, sf_dir, "supplier")
    p = table(spark, sf_dir, "part")
    meta = {"ingest_ts": F.lit(BASE_TS), "source": F.lit(LANDING_SOURCE), "processing_date": F.lit(BASE_DAY)}
    offices = n.join(r, n.n_regionkey == r.r_regionkey, "left").select(
        F.col("n_nationkey").cast("string").alias("officeCode"), F.col("n_name").alias("city"),
        F.col("n_name").alias("country"), F.col("r_name").alias("territory")).withColumns(meta)
    employees = s.select(
        F.col("s_suppkey").cast("string").alias("employeeNumber"), F.col("s_name").alias("lastName"),
        F.concat(F.lit("E"), F.col("s_suppkey").cast("string")).alias("firstName"),
        F.col("s_nationkey").cast("string").alias("officeCode")).withColumns(meta)
    productlines = p.groupBy("p_brand").agg(F.count(F.lit(1)).alias("n")).select(
        F.col("p_brand").alias("productLine"),
        F.concat(F.lit("Brand line with "), F.col("n").cast("string"), F.lit(" products")).alias("textDescription"),
    ).withColumns(meta)
    c = customers(spark, sf_dir).filter(F.col("processing_date") == BASE_DAY)
    cust = c.select(*[F.col(x).cast("string").alias(x) for x in c.columns if x not in ("source",)]) \
        .withColumn("source", F.lit(LANDING_SOURCE))
    o = orders(spark, sf_dir)
    ords = o.select(*[F.col(x).cast("string").alias(x) for x in o.columns if x != "source"]) \
        .withColumn("source", F.lit(LANDING_SOURCE))
    return {
        "customers": cust, "employees": employees, "offices": offices,
        "orderdetails": landed_orderdetails(spark, sf_dir), "orders": ords,
        "payments": landed_payments(spark, sf_dir), "productlines": productlines,
        "products": landed_products(spark, sf_dir),
    }
