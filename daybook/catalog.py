"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame over the whole tables.

The adaptation of the driver tables to pipeline shapes is in ``sources.testdata``; every query then
runs the library operators exactly as the pipeline does. Output columns never include wall-clock
values, so results are comparable with the SQL oracle.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook import fixed_values as FV
from daybook.context import configure_session
from daybook.operators.dedupe import latest_by
from daybook.plans import marts, presentation, ratings, staging, star
from daybook.sources import testdata as td

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# Fixed slice days of the keyed queries, and the last day and batch of the tables (merges start from
# everything before them, so target and source together are the whole table).
RATING_DAY = "2024-01-15"
ORDER_BATCH = "1999-12-31"
LAST_RATING_DAY = "2024-01-30"
LAST_ORDER_BATCH = "2001-12-31"


def query(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        configure_session(spark)
        return fn(spark, sf_dir)

    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    QUERIES[fn.__name__] = run
    return run


# ------------------------------------------------------------------ shared building blocks ---

def _stg_orders(spark, sf):
    return staging.stg_orders(td.orders(spark, sf))


def _stg_orderdetails(spark, sf):
    return staging.stg_orderdetails(td.orderdetails(spark, sf))


def _fact_order_items(spark, sf, day=None):
    return star.fact_order_items_of(td.orderdetails(spark, sf), td.orders(spark, sf), day)


def _ratings_batch(spark, sf):
    return ratings.process(td.landed_ratings(spark, sf), td.customers(spark, sf), td.products(spark, sf))


def _ratings_for_ml(spark, sf):
    return ratings.to_ratings_for_ml(_ratings_batch(spark, sf).known)


def _ratings_state(spark, sf):
    """Current state after merging every day in order (see ``ratings.merge_latest``): per pair the
    newest rating time wins and, on equal times, the later day."""
    return latest_by(_ratings_for_ml(spark, sf), ["customerNumber", "productCode"],
                     ["ratingTimestamp", "processing_date", "ingest_ts"]).select(
        *ratings.RATINGS_SCHEMA.fieldNames())


def _fact_product_ratings(spark, sf, day=None):
    return star.fact_product_ratings(staging.stg_ratings(_ratings_for_ml(spark, sf)), day)


# ------------------------------------------------------------------ staging ---------------

@query
def stg_customers(spark, sf):
    return staging.stg_customers(td.customers(spark, sf))


@query
def stg_products(spark, sf):
    return staging.stg_products(td.products(spark, sf))


@query
def stg_orders(spark, sf):
    return _stg_orders(spark, sf)


@query
def stg_orderdetails(spark, sf):
    return _stg_orderdetails(spark, sf)


@query
def stg_ratings(spark, sf):
    return staging.stg_ratings(_ratings_for_ml(spark, sf))


# ------------------------------------------------------------------ star schema -----------

@query
def fact_order_items(spark, sf):
    return _fact_order_items(spark, sf)


@query
def fact_product_ratings(spark, sf):
    return _fact_product_ratings(spark, sf)


@query
def dim_customers(spark, sf):
    return star.dim_customers(staging.stg_customers(td.customers(spark, sf)))


@query
def dim_products(spark, sf):
    return star.dim_products(staging.stg_products(td.products(spark, sf)))


@query
def dim_date(spark, sf):
    return star.dim_date(_fact_order_items(spark, sf))


@query
def mart_monthly_sales(spark, sf):
    return marts.mart_monthly_sales(_fact_order_items(spark, sf))


@query
def mart_product_performance(spark, sf):
    return marts.mart_product_performance(
        star.dim_products(staging.stg_products(td.products(spark, sf))),
        _fact_order_items(spark, sf), _fact_product_ratings(spark, sf))


# ------------------------------------------------------------------ ratings feed ----------

@query
def rating_typing(spark, sf):
    return _ratings_batch(spark, sf).typed


@query
def validate_ratings(spark, sf):
    from daybook.operators.validate import validate
    from daybook.spec import RATING_RULES
    from daybook.operators.typing import type_ratings

    tagged = validate(type_ratings(td.landed_ratings(spark, sf)), RATING_RULES, mode="first")
    return tagged.withColumn("is_valid", F.col("reject_reason").isNull())


@query
def dedupe_rating_events(spark, sf):
    return _ratings_batch(spark, sf).kept


@query
def duplicate_rating_events(spark, sf):
    return _ratings_batch(spark, sf).duplicates


@query
def ratings_known(spark, sf):
    return _ratings_batch(spark, sf).known


@query
def ratings_unknown(spark, sf):
    return _ratings_batch(spark, sf).unknown


@query
def all_rejects_ratings(spark, sf):
    return _ratings_batch(spark, sf).rejects()


@query
def ratings_outcome(spark, sf):
    """Every rating row once with what became of it, as the daily stage computes it."""
    from daybook.operators.typing import type_ratings
    from daybook.operators.validate import validate
    from daybook.spec import RATING_RULES

    tagged = _written(spark, "tagged", validate(type_ratings(td.landed_ratings(spark, sf)), RATING_RULES, mode="first"))
    return ratings.outcome(tagged, td.customers(spark, sf), td.products(spark, sf))


@query
def latest_rating_per_pair(spark, sf):
    return ratings.latest_per_pair(_ratings_for_ml(spark, sf))


# ------------------------------------------------------------------ presentation ----------

@query
def sales_report(spark, sf):
    return presentation.sales_report(td.orders(spark, sf), td.orderdetails(spark, sf))


@query
def ratings_per_product(spark, sf):
    return presentation.ratings_per_product(td.products(spark, sf), _ratings_for_ml(spark, sf))


@query
def latest_partition_filter(spark, sf):
    return presentation.latest_partition(td.orders(spark, sf))


@query
def presentation_ratings(spark, sf):
    return presentation.presentation_ratings(_ratings_state(spark, sf))


@query
def presentation_ratings_for_ml(spark, sf):
    return presentation.presentation_ratings_for_ml(_ratings_for_ml(spark, sf))


# ------------------------------------------------------------------ relational curation ---

def _curated(spark, sf, table, mode="all"):
    from daybook.plans.curation import curate
    from daybook.spec import SPECS

    landed = {"orderdetails": td.landed_orderdetails, "products": td.landed_products,
              "payments": td.landed_payments}[table](spark, sf)
    return curate(landed, SPECS[table], mode)


def _reasons(spark, sf, mode):
    from daybook.operators.typing import cast_by_rules
    from daybook.operators.validate import validate
    from daybook.spec import SPECS

    spec = SPECS["products"]
    typed = cast_by_rules(td.landed_products(spark, sf), spec.casts)
    return validate(typed, spec.all_rules(), mode).select(
        "productCode", "quantityInStock", "buyPrice", "MSRP", "reject_reason")


@query
def typed_projection(spark, sf):
    return _curated(spark, sf, "orderdetails").typed


@query
def reject_null_keys(spark, sf):
    from daybook.operators.validate import validate
    from daybook.spec import SPECS

    spec = SPECS["orderdetails"]
    tagged = validate(_curated(spark, sf, "orderdetails").typed, spec.key_rules(), "all")
    return tagged.filter(F.col("reject_reason").isNotNull())


def _validated(spark, sf, table):
    from daybook.operators.validate import validate

    b = _curated(spark, sf, table)
    return validate(b.typed, b.spec.all_rules(), "all").withColumn("is_valid", F.col("reject_reason").isNull())


@query
def validate_orderdetails(spark, sf):
    return _validated(spark, sf, "orderdetails")


@query
def validate_payments(spark, sf):
    return _validated(spark, sf, "payments")


@query
def validate_products(spark, sf):
    return _validated(spark, sf, "products")


@query
def valid_reject_split(spark, sf):
    """Every landed line is valid or rejected (business or duplicate), never both or neither."""
    c = _curated(spark, sf, "orderdetails").counts()
    return c.select(F.expr("stack(3, 'source', source_rows, 'valid', valid_rows, 'rejected', rejected_rows)")
                    .alias("bucket", "row_count"))


@query
def reject_reasons_all(spark, sf):
    return _reasons(spark, sf, "all")


@query
def reject_reason_first(spark, sf):
    return _reasons(spark, sf, "first")


@query
def reject_reason_last(spark, sf):
    return _reasons(spark, sf, "last")


@query
def dedupe_batch(spark, sf):
    return _curated(spark, sf, "orderdetails").valid


@query
def duplicate_rejects(spark, sf):
    return _curated(spark, sf, "orderdetails").duplicate_rejected


@query
def all_rejects_orderdetails(spark, sf):
    return _curated(spark, sf, "orderdetails").rejected()


@query
def latest_master_customers(spark, sf):
    from daybook.operators.dedupe import latest_master

    return latest_master(td.customers(spark, sf), "customerNumber")


@query
def latest_master_products(spark, sf):
    from daybook.operators.dedupe import latest_master

    return latest_master(td.products(spark, sf), "productCode")


@query
def known_keys_asof(spark, sf):
    """Master keys known up to the back-filled day (only partitions <= that day count)."""
    from daybook.operators.routing import known_keys

    c = known_keys(td.customers(spark, sf), "customerNumber", td.BACKFILL_DAY)
    p = known_keys(td.products(spark, sf), "productCode", td.BACKFILL_DAY)
    return (c.select(F.lit("customer").alias("entity"), F.col("customerNumber").cast("string").alias("key"))
            .unionByName(p.select(F.lit("product").alias("entity"), F.col("productCode").alias("key"))))


# ------------------------------------------------------------------ quality ---------------

@query
def dq_suite(spark, sf):
    """The seven checks over one run's slice: masters of the newer day, orders of one yearly batch (order
    lines as typed but not yet validated), ratings of one day as typed, with defects that every check
    counts (some keys dropped, some references shifted to unknown ones)."""
    from daybook.operators.quality import curated_checks
    from daybook.operators.routing import known_keys
    from daybook.operators.typing import type_ratings

    def without(df, key, modulus):
        return df.withColumn(key, F.when(F.col(key).cast("bigint") % modulus != 0, F.col(key)))

    cust, prod, day = td.customers(spark, sf), td.products(spark, sf), F.col("processing_date")
    orders = td.orders(spark, sf).filter(day == ORDER_BATCH)
    orders = orders.withColumn("customerNumber", F.when(F.col("orderNumber") % 11 == 0, -F.col("customerNumber")).otherwise(F.col("customerNumber")))
    lines = _curated(spark, sf, "orderdetails").typed.filter(day == ORDER_BATCH)
    lines = lines.withColumn("productCode", F.when(F.col("orderNumber") % 13 == 0, F.concat(F.lit("X"), "productCode")).otherwise(F.col("productCode")))
    return curated_checks(
        without(cust.filter(day == td.NEWER_DAY), "customerNumber", 7), without(prod.filter(day == td.NEWER_DAY), "productCode", 7),
        without(orders, "orderNumber", 17), lines, type_ratings(td.landed_ratings(spark, sf)).filter(day == RATING_DAY),
        known_keys(cust, "customerNumber", td.NEWER_DAY), known_keys(prod, "productCode", td.NEWER_DAY), "run-dq", ORDER_BATCH)


@query
def dq_orphan_customer(spark, sf):
    """Payments whose customer is unknown; a NULL customer counts as an orphan."""
    from daybook.operators.routing import known_keys

    pay = _curated(spark, sf, "payments").typed
    return pay.join(known_keys(td.customers(spark, sf), "customerNumber"), "customerNumber", "left_anti")


@query
def dq_orphan_product(spark, sf):
    """Order lines whose product was not yet known on the back-filled day (as-of lookup)."""
    from daybook.operators.routing import known_keys

    lines = _curated(spark, sf, "orderdetails").typed
    return lines.join(known_keys(td.products(spark, sf), "productCode", td.BACKFILL_DAY), "productCode", "left_anti")


def _written(spark, name, df):
    from daybook.sinks.tables import replace_table

    return replace_table(df, _scratch(spark, name))


def _defective_star(spark, sf, *names):
    """The written models (only ``names``, if given) with defects that every declared test counts, derived
    from the rows' own keys: keys dropped or doubled, quantities dropped or turned negative, odd ratings,
    days missing from dim_date."""
    def doubled(df, number, modulus):
        # by repeating rows: a union with the filtered model would compute the model twice
        return df.withColumn("_copy", F.explode(F.array_repeat(F.lit(0), F.when(number % modulus == 0, 2).otherwise(1)))).drop("_copy")

    def unless(hit, column):
        return F.when(~hit, F.col(column))

    cn, pc, on = F.col("customer_number"), F.col("product_code").cast("bigint"), F.col("order_number")
    build = {
        "dim_customers": lambda: doubled(star.dim_customers(staging.stg_customers(td.customers(spark, sf))), cn, 41)
        .withColumn("customer_number", unless(cn % 40 == 0, "customer_number")),
        "dim_products": lambda: doubled(star.dim_products(staging.stg_products(td.products(spark, sf))), pc, 41).withColumns({
            "quantity_in_stock": F.when(pc % 43 == 0, -1).otherwise(F.col("quantity_in_stock")),
            "product_code": unless(pc % 40 == 0, "product_code")}),
        "fact_order_items": lambda: doubled(_fact_order_items(spark, sf), on, 41).withColumns({
            "order_item_id": unless(on % 37 == 0, "order_item_id"), "gross_amount": unless(on % 36 == 0, "gross_amount"),
            "quantity_ordered": F.when(on % 39 == 0, -F.col("quantity_ordered")).otherwise(unless(on % 38 == 0, "quantity_ordered"))}),
        "fact_product_ratings": lambda: doubled(_fact_product_ratings(spark, sf), cn, 41).withColumns({
            "rating_id": unless(cn % 37 == 0, "rating_id"),
            "product_rating": F.when(cn % 43 == 0, 9).otherwise(F.col("product_rating"))}),
        "dim_date": lambda: star.dim_date(out["fact_order_items"]).filter(F.col("date_key") % 100 != 13),
    }
    out = {}
    for name, df in build.items():
        if not names or name in names:
            out[name] = _written(spark, name, df())
    return out


@query
def model_test_suite(spark, sf):
    """All declared model tests, one row per test."""
    from daybook.operators.quality import model_tests

    return model_tests(_defective_star(spark, sf))


def _summarise(parts):
    out = None
    for model, column, failing in parts:
        one = failing.agg(F.count(F.lit(1)).alias("failures")).select(
            F.lit(model).alias("model"), F.lit(column).alias("column_name"), "failures")
        out = one if out is None else out.unionByName(one)
    return out


@query
def test_not_null(spark, sf):
    from daybook.operators.quality import test_not_null as t

    s = _defective_star(spark, sf, "dim_customers", "dim_products", "fact_order_items", "fact_product_ratings")
    uses = [("dim_customers", "customer_number"), ("dim_products", "product_code"),
            ("fact_order_items", "order_item_id"), ("fact_order_items", "quantity_ordered"),
            ("fact_order_items", "gross_amount"), ("fact_product_ratings", "rating_id")]
    return _summarise([(m, col, t(s[m], col)) for m, col in uses])


@query
def test_unique(spark, sf):
    from daybook.operators.quality import test_unique as t

    s = _defective_star(spark, sf, "dim_customers", "dim_products", "fact_order_items", "fact_product_ratings")
    uses = [("dim_customers", "customer_number"), ("dim_products", "product_code"),
            ("fact_order_items", "order_item_id"), ("fact_product_ratings", "rating_id")]
    return _summarise([(m, col, t(s[m], col)) for m, col in uses])


@query
def test_accepted_values(spark, sf):
    """Failing rows: order lines whose status is outside the accepted list (re-sent 'COMPLETE')."""
    from daybook.operators.quality import test_accepted_values as t
    from daybook.spec import ORDER_STATUSES

    s = _defective_star(spark, sf, "fact_order_items", "fact_product_ratings")
    bad_status = t(s["fact_order_items"], "order_status", ORDER_STATUSES).select(
        F.lit("fact_order_items.order_status").alias("test"), F.col("order_item_id").alias("row_id"),
        F.col("order_status").alias("value"))
    bad_rating = t(s["fact_product_ratings"], "product_rating", FV.RATING_VALUES).select(
        F.lit("fact_product_ratings.product_rating").alias("test"), F.col("rating_id").alias("row_id"),
        F.col("product_rating").cast("string").alias("value"))
    return bad_status.unionByName(bad_rating)


@query
def test_expression(spark, sf):
    """Failing rows of ``credit_limit >= 0`` and ``quantity_in_stock >= 0``."""
    from daybook.operators.quality import test_expression as t

    s = _defective_star(spark, sf, "dim_customers", "dim_products")
    a = t(s["dim_customers"], "credit_limit", ">= 0").select(
        F.lit("dim_customers.credit_limit").alias("test"), F.col("customer_number").cast("string").alias("row_id"),
        F.col("credit_limit").cast("string").alias("value"))
    b = t(s["dim_products"], "quantity_in_stock", ">= 0").select(
        F.lit("dim_products.quantity_in_stock").alias("test"), F.col("product_code").alias("row_id"),
        F.col("quantity_in_stock").cast("string").alias("value"))
    return a.unionByName(b)


@query
def test_relationships(spark, sf):
    from daybook.operators.quality import test_relationships as t

    s = _defective_star(spark, sf)
    f, r = s["fact_order_items"], s["fact_product_ratings"]
    uses = [("fact_order_items", "customer_number", t(f, "customer_number", s["dim_customers"], "customer_number")),
            ("fact_order_items", "product_code", t(f, "product_code", s["dim_products"], "product_code")),
            ("fact_order_items", "order_date_key", t(f, "order_date_key", s["dim_date"], "date_key")),
            ("fact_product_ratings", "customer_number",
             t(r, "customer_number", s["dim_customers"], "customer_number")),
            ("fact_product_ratings", "product_code", t(r, "product_code", s["dim_products"], "product_code"))]
    return _summarise(uses)


@query
def test_positive_order_values(spark, sf):
    f = _defective_star(spark, sf, "fact_order_items")["fact_order_items"]
    return f.filter((F.col("quantity_ordered") <= 0) | (F.col("price_each") < 0) | (F.col("gross_amount") < 0))


# ------------------------------------------------------------------ mutable state ---------

def _prev_day(day: str) -> str:
    import datetime as dt

    return (dt.date.fromisoformat(day) - dt.timedelta(days=1)).isoformat()


def _merged(spark, name, target, source, keys, partition, update_when=None, by=None, of_keys=False, zone=None):
    from daybook.sinks.tables import PartitionedTable

    table = PartitionedTable(spark, _scratch(spark, name), target.schema, partition, by, of_keys, zone=zone)
    return _merged_into(spark, name, table, target, source, keys, update_when)


def _merged_into(spark, name, table, target, source, keys, update_when=None):
    """``target`` written as a partitioned table, ``source`` merged into it, and the table read back."""
    table.replace(target, keys)
    table.merge(_written(spark, f"{name}_source", source.drop(*table.derived)), keys, update_when, check_unique=True)
    return table.read()


@query
def upsert_events(spark, sf):
    """Events before the last day as target; the day's events plus re-sent events of the previous day
    (changed rating, moving to the day's partition) as source."""
    rfml = _written(spark, "rfml", _ratings_for_ml(spark, sf))
    day = F.col("processing_date")
    resent = (rfml.filter((day == _prev_day(LAST_RATING_DAY)) & (F.col("source") == "ratings/click.json"))
              .withColumns({"productRating": (F.lit(6) - F.col("productRating")).cast("int"),
                            "ingest_ts": F.col("ingest_ts") + F.expr("INTERVAL 1 DAY"),
                            "processing_date": F.lit(LAST_RATING_DAY),
                            "processing_ts": ratings.batch_ts(F.lit(LAST_RATING_DAY))}))
    source = rfml.filter(day == LAST_RATING_DAY).unionByName(resent)
    return _merged(spark, "events", rfml.filter(day < LAST_RATING_DAY), source, list(ratings.RATING_KEYS), "processing_date", zone=["ratingTimestamp"])


@query
def upsert_latest_wins(spark, sf):
    """State from the days before the last; the day's newest rating per pair, with 'view' events arriving
    20 days late, merged so that a late event never overwrites newer state."""
    rfml = _written(spark, "rfml", _ratings_for_ml(spark, sf))
    day = F.col("processing_date")
    state = latest_by(rfml.filter(day < LAST_RATING_DAY), ["customerNumber", "productCode"],
                      ["ratingTimestamp", "processing_date", "ingest_ts"]).select(*ratings.RATINGS_SCHEMA.fieldNames())
    shifted = rfml.filter(day == LAST_RATING_DAY).withColumn(
        "ratingTimestamp", F.when(F.col("source") == "ratings/view.json",
                                  F.col("ratingTimestamp") - F.expr("INTERVAL 20 DAYS"))
        .otherwise(F.col("ratingTimestamp")))
    return _merged(spark, "state", state, ratings.latest_per_pair(shifted), list(ratings.RATING_PAIR), "bucket",
                   ratings.latest_wins("ratingTimestamp"), F.pmod(F.xxhash64(*ratings.RATING_PAIR), F.lit(16)), of_keys=True)


@query
def insert_if_absent(spark, sf):
    """Customers first written by the newer day's batch keep their row; the base batch only adds
    customers that were absent."""
    from daybook.operators.upsert import insert_if_absent as ins

    c = td.customers(spark, sf)
    day = F.col("processing_date")
    return ins(c.filter(day == td.NEWER_DAY), c.filter(day == td.BASE_DAY), ["customerNumber"])


@query
def schema_clone(spark, sf):
    """The clone of the orders table as written: its columns and types, its rows (none), and next to
    them how many values the cloned table holds."""
    from daybook.sinks.tables import schema_clone as clone

    orders = td.orders(spark, sf)
    empty = _written(spark, "clone", clone(orders))
    stack = ", ".join(f"'{f.name}', '{f.dataType.simpleString()}', `{f.name}`" for f in empty.schema.fields)

    def values(df):
        return df.agg(*[F.count(c).alias(c) for c in df.columns]).selectExpr(
            f"stack({len(df.columns)}, {stack}) as (column_name, data_type, n)")

    return values(orders).withColumnRenamed("n", "source_values").join(
        values(empty).withColumnRenamed("n", "clone_values"), ["column_name", "data_type"])


@query
def incremental_or_filter(spark, sf):
    """Fact slice of one batch: lines or orders of that batch (ranking only the affected orders)."""
    return star.fact_order_items_slice(td.orderdetails(spark, sf), td.orders(spark, sf), ORDER_BATCH)


@query
def incremental_rating_fact(spark, sf):
    """Rating facts of one day (ranking only the events whose key occurs on that day)."""
    return star.fact_product_ratings_slice(_ratings_for_ml(spark, sf), RATING_DAY)


@query
def incremental_fact_merge(spark, sf):
    """Fact built from all batches before the last, then the last batch's slice merged on order_item_id."""
    day = F.col("processing_date")
    o, d = td.orders(spark, sf), td.orderdetails(spark, sf)
    before = star.fact_order_items_of(d.filter(day < LAST_ORDER_BATCH), o.filter(day < LAST_ORDER_BATCH))
    fresh = star.fact_order_items_slice(d, o, LAST_ORDER_BATCH)
    facts = star.fact_order_items_table(spark, _scratch(spark, "fact"), before.schema)
    return _merged_into(spark, "fact", facts, before, fresh, ["order_item_id"])


def _grown_marts(spark, sf):
    """Facts and month tables of all batches before the last, then the last batch merged and the months that it
    rewrote brought up to date: (monthly sales, product months, rating months, all of them as tables)."""
    from daybook.sinks.tables import PartitionedTable

    day = F.col("processing_date")
    o, d = td.orders(spark, sf), td.orderdetails(spark, sf)
    before = star.fact_order_items_of(d.filter(day < LAST_ORDER_BATCH), o.filter(day < LAST_ORDER_BATCH))
    facts = star.fact_order_items_table(spark, _scratch(spark, "facts"), before.schema)
    facts.replace(before, ["order_item_id"])
    rfml = _written(spark, "rfml", _ratings_for_ml(spark, sf))
    old = star.fact_product_ratings(staging.stg_ratings(rfml.filter(day < LAST_RATING_DAY)))
    rated = PartitionedTable(spark, _scratch(spark, "rated"), old.schema, "rating_month", by=F.date_format("rating_timestamp", "yyyy-MM"), of_keys=True)
    rated.replace(old)
    tables = [(marts.sales_table(spark, _scratch(spark, "sales")), facts, marts.mart_monthly_sales),
              (marts.product_months_table(spark, _scratch(spark, "sold")), facts, marts.product_months),
              (marts.rating_months_table(spark, _scratch(spark, "stars")), rated, marts.rating_months)]
    for table, source, build in tables:
        marts.refresh_months(table, source, build, None)
    fresh = star.fact_order_items_slice(d, o, LAST_ORDER_BATCH).drop(*facts.derived)
    months = facts.merge(_written(spark, "slice", fresh), ["order_item_id"])
    rating_months = rated.merge(_written(spark, "new_ratings", star.fact_product_ratings_slice(rfml, LAST_RATING_DAY)), ["rating_id"])
    return [marts.refresh_months(table, source, build, rating_months if source is rated else months) for table, source, build in tables]


@query
def mart_monthly_sales_incremental(spark, sf):
    return _grown_marts(spark, sf)[0]


@query
def mart_product_performance_incremental(spark, sf):
    _, sold, stars = _grown_marts(spark, sf)
    return marts.product_performance(star.dim_products(staging.stg_products(td.products(spark, sf))), sold, stars)


@query
def incremental_dim_slice(spark, sf):
    """The back-filled day arrives after the dimension was built: ranking happens before the day
    slice, so the old version never replaces the newer one and the dimension is unchanged."""
    c = td.customers(spark, sf)
    existing = star.dim_customers(staging.stg_customers(c.filter(F.col("processing_date") != td.BACKFILL_DAY)))
    fresh = star.dim_slice(c, "customerNumber", td.BACKFILL_DAY, staging.stg_customers, star.dim_customers)
    return star.build_incremental(existing, fresh, "customer_number", check_unique=False)


# ------------------------------------------------------------------ operations ------------

def _all_counts(spark, sf):
    from daybook.plans.curation import curate
    from daybook.spec import SPECS

    landed = td.landed_tables(spark, sf)
    out = None
    for name in SPECS:
        c = curate(landed[name], SPECS[name]).counts()
        out = c if out is None else out.unionByName(c)
    return out


@query
def valid_rejected_totals(spark, sf):
    return _all_counts(spark, sf).agg(
        F.sum("valid_rows").cast("bigint").alias("valid_rows"),
        F.sum("rejected_rows").cast("bigint").alias("rejected_rows"),
    ).withColumn("status", F.when(F.col("rejected_rows") > 0, FV.STATUS_SUCCEEDED_WITH_REJECTS).otherwise(FV.STATUS_SUCCEEDED))


@query
def reconcile_counts(spark, sf):
    return _all_counts(spark, sf).withColumns({
        "balanced": F.col("source_rows") == F.col("valid_rows") + F.col("rejected_rows"),
        "status": F.when(F.col("rejected_rows") > 0, FV.STATUS_SUCCEEDED_WITH_REJECTS).otherwise(FV.STATUS_SUCCEEDED),
    })


def _audit_events(spark, sf):
    e = td.table(spark, sf, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    status = (F.when(F.col("event_type").isin("signup", "view"), FV.STATUS_RUNNING)
              .when(F.col("event_type") == "click", FV.STATUS_SUCCEEDED)
              .when(F.col("event_type") == "purchase", FV.STATUS_SUCCEEDED_WITH_REJECTS)
              .when(F.col("event_type") == "error", FV.STATUS_FAILED))
    terminal = ~F.col("event_type").isin("signup", "view")
    return e.select(
        F.concat(F.lit("run-"), F.col("user_id").cast("string")).alias("run_id"),
        F.concat(F.lit("stage_"), (k % 10).cast("string")).alias("stage"),
        status.alias("status"),
        F.col("ts").cast("timestamp").alias("event_ts"),
        F.col("event_id").alias("seq"),
        F.when(terminal & (F.col("event_id") % 3 != 0),
               F.create_map(F.lit("valid_rows"), F.floor("value").cast("string"))).alias("metrics"),
        F.when(F.col("event_type") == "error",
               F.concat(F.lit("ValueError: value "), F.floor("value").cast("string"))).alias("error_message"),
    )


@query
def audit_latest_state(spark, sf):
    from daybook.operators.audit import fold

    s = fold(_audit_events(spark, sf))
    return s.withColumn("valid_rows", F.col("metrics")["valid_rows"]).drop("metrics")


@query
def run_status_rollup(spark, sf):
    from daybook.operators.audit import fold, run_rollup

    out = run_rollup(fold(_audit_events(spark, sf)))
    return out.withColumn("failed_stages", F.array_join("failed_stages", ", "))


@query
def stage_metrics(spark, sf):
    """Metrics of the folded audit state, one row each."""
    from daybook.operators.audit import fold, stage_metrics as metrics

    return metrics(fold(_audit_events(spark, sf)))


def _messages(spark, sf, faults: bool = False):
    """Events rendered as queue messages: odd ids wrapped in a topic envelope, even ids raw. With
    ``faults``, of every 50 messages one is cut short, one has a key with a stray percent sign, one is
    a test event, one has no records, one a record without ``s3`` and one no usable date."""
    e = td.table(spark, sf, "events")
    n = F.col("event_id") % 50 if faults else F.lit(-1)
    key = F.concat(F.lit("incoming/"), F.col("event_type"), F.lit("/"), F.col("event_id").cast("string"),
                   F.when(n == 1, F.lit("+100%.json")).otherwise(F.lit("+part%2F1.json")))
    time = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    rec = F.struct(
        F.when(n == 5, F.lit("yesterday")).otherwise(time).alias("eventTime"),
        F.when(n != 4, F.struct(F.struct(F.lit("landing-bucket").alias("name")).alias("bucket"),
                                F.struct(key.alias("key")).alias("object"))).alias("s3"))
    event = (F.when(n == 2, F.lit('{"Event":"s3:TestEvent"}')).when(n == 3, F.lit('{"Records":[]}'))
             .otherwise(F.to_json(F.struct(F.array(rec).alias("Records")))))
    body = F.when(F.col("event_id") % 2 == 1, F.to_json(F.struct(event.alias("Message")))).otherwise(event)
    body = F.when(n == 0, F.substring(body, 1, 40)).otherwise(body)
    return e.select(F.concat(F.lit("msg-"), F.col("event_id").cast("string")).alias("message_id"), body.alias("body"))


@query
def event_notification_flatten(spark, sf):
    from daybook.sources.notifications import flatten

    return flatten(_messages(spark, sf))


@query
def malformed_quarantine(spark, sf):
    """Parsed records plus quarantined messages; messages without anything to do yield nothing."""
    from daybook.sources.notifications import outcomes

    return outcomes(_messages(spark, sf, faults=True))


@query
def json_files_quarantine(spark, sf):
    """One JSON file per user and event type, of which every tenth lacks its last sign: the rows of the good files, and
    the broken ones whole."""
    from daybook.sources.files import MALFORMED_FILE, json_file_rows
    from daybook.streaming.ingest import LANDED_RATING_SCHEMA

    e = td.table(spark, sf, "events")
    rating = F.struct(F.col("user_id").cast("string").alias("customerNumber"), F.concat(F.lit("P"), "event_id").alias("productCode"),
                      (F.col("event_id") % 7).cast("int").alias("productRating"),
                      F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("ratingTimestamp"))
    files = e.groupBy(F.concat_ws("/", F.lit("in"), "user_id", F.concat("event_type", F.lit(".json"))).alias("source")).agg(
        F.to_json(F.sort_array(F.collect_list(rating))).alias("content"), F.min("event_id").alias("first"))
    cut = F.when(F.col("first") % 10 == 0, F.substring("content", 1, F.length("content") - 1)).otherwise(F.col("content"))
    rows = json_file_rows(files.select("source", cut.alias("content")), LANDED_RATING_SCHEMA)
    broken = F.col("_broken").isNotNull()
    return rows.select("source", *LANDED_RATING_SCHEMA.names, F.when(broken, F.lit(MALFORMED_FILE)).alias("reject_reason"),
                       F.md5("_broken").alias("content_md5"))


@query
def reconcile_content(spark, sf):
    """Events against their valid and rejected rows, per day. Of every five days, on one a row is lost and
    another doubled (the counts agree), on one a row is lost, and on one a value is changed."""
    from daybook.operators.quality import reconcile_content as reconcile

    e = td.table(spark, sf, "events").select("event_id", "user_id", "event_type", "value", F.date_format("ts", "yyyy-MM-dd").alias("processing_date"))
    kind = F.dayofmonth(F.col("processing_date").cast("date")) % 5
    ends = e.groupBy("processing_date").agg(F.min("event_id").alias("first"), F.max("event_id").alias("last"))
    marked = e.join(ends, "processing_date")
    first, last = F.col("event_id") == F.col("first"), F.col("event_id") == F.col("last")
    out = marked.filter(~(first & kind.isin(1, 2))).withColumn("copies", F.when(last & (kind == 1), 2).otherwise(1))
    out = out.withColumn("user_id", F.when(first & (kind == 3), F.col("user_id") + 1).otherwise(F.col("user_id")))
    out = out.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies"))).select(*e.columns)
    bad = F.col("event_type") == "error"
    return reconcile(e, [out.filter(~bad), out.filter(bad)], ["event_id", "user_id", "event_type", "value"], ["processing_date"])


@query
def latest_master_state(spark, sf):
    """The newest row of every product as kept state: the newest day first, then the others in turn, one of them twice."""
    from daybook.plans.masters import master_table, refresh_master

    p = _written(spark, "products", td.products(spark, sf))
    days = sorted(r[0] for r in p.select("processing_date").distinct().collect())
    table = master_table(spark, _scratch(spark, "master"), p.schema, "productCode")
    table.replace(p.limit(0))
    come = F.lit(False)
    for day in [days[-1], *days[:-1], days[0]]:
        come = come | (F.col("processing_date") == day)
        refresh_master(table, p.filter(come), "productCode", day)
    return table.read()


@query
def notification_dead_letter(spark, sf):
    """Events as receives of a user's messages of one kind, of which every seventh works: what became of each message."""
    from daybook.sources.notifications import receive_outcomes

    e = td.table(spark, sf, "events")
    receives = e.select(F.concat_ws("-", F.lit("msg"), "user_id", "event_type").alias("message_id"), F.col("ts").cast("timestamp").alias("received_at"),
                        F.col("event_id").alias("receive_id"), (F.col("event_id") % 7 == 0).alias("ok"))
    return receive_outcomes(receives)


@query
def curated_type_changes(spark, sf):
    """Four days of one curated table whose column comes as int, bigint, decimal and text: every value that is a
    number is kept as it is, the others are rejected with their text."""
    from daybook.context import RunContext
    from daybook.plans.stages import Lake, _curated_table, write_curated

    o = td.table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("c"))
    lake, k = Lake(_scratch(spark, "types")), F.col("k")
    days = {"2024-01-01": F.col("c").cast("int"), "2024-01-02": k.cast("bigint") * 3_000_000_000, "2024-01-03": (k.cast("decimal(14,0)") / 4).cast("decimal(12,2)"),
            "2024-01-04": F.when(k % 10 == 5, F.concat(F.lit("no "), k.cast("string"))).when(k % 10 == 1, F.lit(None)).otherwise(k.cast("string"))}
    for n, (day, v) in enumerate(days.items()):
        write_curated(spark, lake, "t", o.filter(k % 4 == n).select("k", v.alias("v")), day, RunContext(day, "r"))
    kept = _curated_table(spark, lake, "t").select("processing_date", "k", F.col("v").cast("decimal(22,2)").alias("v"),
                                                  F.lit(None).cast("string").alias("rejected"))
    misfits = spark.read.parquet(f"{lake.root}/rejected_zone/t_types").select(
        F.col("processing_date").cast("string").alias("processing_date"), "k", F.lit(None).cast("decimal(22,2)").alias("v"), F.col("v").alias("rejected"))
    return kept.unionByName(misfits)


@query
def scalar_functions(spark, sf):
    from daybook.functions import month_name, surrogate_key, truncate, weekday_sun0

    c = td.customers(spark, sf)
    credit = F.col("creditLimit")
    d = F.date_add(F.to_date(F.lit(td.BASE_DAY)), (F.col("customerNumber") % 400).cast("int"))
    return c.select(
        "customerNumber",
        F.upper(F.trim("contactFirstName")).alias("contact_upper"),
        surrogate_key(F.col("customerNumber"), F.col("customerName")).alias("key_md5"),
        F.concat_ws("; ", F.col("city"), F.lit(None).cast("string"), F.col("state")).alias("place"),
        F.concat(F.col("customerName"), F.when(credit >= 0, F.lit("+"))).alias("name_if_positive"),
        F.when(credit < 0, "negative").when(credit.between(0, 5000), "low").otherwise("high").alias("credit_band"),
        F.coalesce(F.when(credit >= 0, credit), F.lit(0.0)).alias("credit_or_zero"),
        truncate(F.col("customerName"), 10).alias("name10"),
        d.alias("some_day"),
        F.year(d).cast("int").alias("y"), F.month(d).cast("int").alias("m"), F.dayofmonth(d).cast("int").alias("d"),
        F.quarter(d).cast("int").alias("q"), weekday_sun0(d).alias("dow"), month_name(d).alias("month_name"),
        F.date_sub(d, 1).alias("day_before"),
    )


# ------------------------------------------------------------------ ingestion -------------

@query
def ingest_metadata(spark, sf):
    import datetime as dt

    from daybook.context import RunContext
    from daybook.operators.typing import add_ingest_metadata

    ctx = RunContext(processing_date=ORDER_BATCH, run_id="run-0001", run_ts=dt.datetime(2000, 1, 1, 2, 0))
    o = td.orders(spark, sf).drop("ingest_ts", "source", "processing_date")
    return add_ingest_metadata(o, ctx, FV.SOURCE_DATABASE)


@query
def ingest_row_counts(spark, sf):
    tables = dict(td.landed_tables(spark, sf))
    tables["ratings"] = td.landed_ratings(spark, sf)
    out = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        out = one if out is None else out.unionByName(one)
    return out


@query
def incremental_window_scan(spark, sf):
    """Orders updated inside one month, half-open [start, end): both bounds reach the scan."""
    from daybook.sources.files import window_scan

    return window_scan(td.table(spark, sf, "orders"), "o_orderdate", "1998-03-01", "1998-04-01")


def _scratch(spark, name):
    """A new folder of the shared checkpoint folder (set for local sessions that have none)."""
    import tempfile
    import uuid

    from daybook.context import checkpoint_dir

    if not spark.conf.get("spark.checkpoint.dir", None):
        checkpoint_dir(spark, fallback=tempfile.mkdtemp(prefix="daybook-ckpt-"))
    return f"{spark.conf.get('spark.checkpoint.dir').rstrip('/')}/scratch/{name}-{uuid.uuid4().hex[:8]}"


@query
def csv_landing_roundtrip(spark, sf):
    """Landed products written as CSV and read back with the all-string schema."""
    from daybook.sinks.tables import write_landing_csv
    from daybook.sources.files import read_landed_csv

    df = td.landed_products(spark, sf)
    path = _scratch(spark, "csv")
    write_landing_csv(df, path)
    return read_landed_csv(spark, path, df.schema)


@query
def json_landing_roundtrip(spark, sf):
    from daybook.sinks.tables import write_landing_json
    from daybook.sources.files import read_landed_json

    df = td.landed_ratings(spark, sf)
    path = _scratch(spark, "json")
    write_landing_json(df, path)
    return read_landed_json(spark, path, df.schema)


@query
def partition_overwrite(spark, sf):
    """Order lines written by yearly batch; one batch is replaced by a changed slice; all read back."""
    from daybook.sinks.tables import replace_partition

    d = td.orderdetails(spark, sf)
    path = _scratch(spark, "orderdetails")
    d.hint("rebalance", "processing_date").write.mode("overwrite").partitionBy("processing_date").parquet(path)
    changed = (d.filter(F.col("processing_date") == ORDER_BATCH)
               .withColumn("quantityOrdered", F.col("quantityOrdered") + 1))
    replace_partition(changed, path, "processing_date", ORDER_BATCH)
    return spark.read.schema(d.schema).parquet(path)


@query
def curated_schema_evolution(spark, sf):
    """Products curated on two days, the second of which brings a new column: the table has all columns
    and rows, and every row tells the attempt that brought it."""
    from daybook.plans.stages import Lake, _curated_table, write_curated

    lake = Lake(_scratch(spark, "lake"))
    p = td.landed_products(spark, sf)
    write_curated(spark, lake, "products", p.withColumn("run_id", F.lit("run-1")), td.BASE_DAY)
    second = p.withColumns({"run_id": F.lit("run-2"), "shelfTier": F.concat(F.lit("T-"), "productLine")}).drop("productVendor")
    write_curated(spark, lake, "products", second, td.NEWER_DAY)
    return _curated_table(spark, lake, "products")


@query
def rejects_if_any(spark, sf):
    """Rejected order lines as the sink wrote them for one run."""
    from daybook.context import RunContext
    from daybook.sinks.tables import partition_path, write_rejects

    root, ctx = _scratch(spark, "rejects"), RunContext(ORDER_BATCH, run_id="run-1")
    write_rejects(_curated(spark, sf, "orderdetails").rejected().withColumnRenamed("processing_date", "batch"), root, "orderdetails", ctx)
    path = partition_path(root, "rejected_zone/orderdetails", processing_date=ORDER_BATCH, run_id="run-1")
    return spark.read.parquet(path).drop("rejected_at")


@query
def merge_partition_values(spark, sf):
    """Products in a table partitioned by a column with NULLs, spaces and slashes; a merge moves some
    rows to other partitions, and the values come back as they are."""
    p = td.table(spark, sf, "part").select("p_partkey", "p_name", "p_size", F.when(F.col("p_size") % 7 != 0, F.concat(
        "p_type", F.lit("/a b:"), "p_brand")).alias("place"))
    moved = p.filter("p_partkey % 5 = 0").withColumns({"place": F.when(F.col("p_size") % 2 == 0, F.lit("x/y=z %")),
                                                       "p_size": F.col("p_size") + 100})
    return _merged(spark, "places", p, moved, ["p_partkey"], "place")
