"""Data-quality checks and declarative model tests.

``run_checks`` evaluates all conditional counts of a table in ONE aggregate (``count_if``) instead
of one job per check, and anti-join checks as one aggregate each; the result is a small frame of
(check_name, failure_count, status, run_id, processing_date). ``gate`` persists nothing itself:
callers write the results first, then gate (a failed gate must leave its evidence behind).
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook import fixed_values as FV


@dataclass(frozen=True)
class CountCheck:
    """``failure_count = count_if(predicate)`` over ``frame``."""
    name: str
    predicate: Column


@dataclass(frozen=True)
class OrphanCheck:
    """``failure_count`` = rows of ``child`` whose ``key`` is not among ``parent_keys``.

    A NULL child key counts as an orphan (``left_anti`` keeps it), unlike ``test_relationships``.
    """
    name: str
    child: DataFrame
    key: str
    parent_keys: DataFrame


class QualityGateError(RuntimeError):
    pass


def _counts(frame: DataFrame, checks: Sequence[CountCheck]) -> DataFrame:
    agg = frame.agg(*[F.count_if(F.coalesce(c.predicate, F.lit(False))).alias(c.name) for c in checks])
    stacked = ", ".join(f"'{c.name}', `{c.name}`" for c in checks)
    return agg.selectExpr(f"stack({len(checks)}, {stacked}) as (check_name, failure_count)")


def _orphans(check: OrphanCheck) -> DataFrame:
    return (check.child.select(check.key).join(check.parent_keys, check.key, "left_anti")
            .agg(F.count(F.lit(1)).alias("failure_count"))
            .select(F.lit(check.name).alias("check_name"), "failure_count"))


def run_checks(count_checks: Sequence[tuple[DataFrame, Sequence[CountCheck]]],
               orphan_checks: Sequence[OrphanCheck], run_id: str, processing_date: str) -> DataFrame:
    parts = [_counts(f, cs) for f, cs in count_checks if cs] + [_orphans(o) for o in orphan_checks]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(
        "check_name",
        F.col("failure_count").cast("bigint").alias("failure_count"),
        F.when(F.col("failure_count") > 0, FV.CHECK_FAILED).otherwise(FV.CHECK_PASSED).alias("status"),
        F.lit(run_id).alias("run_id"),
        F.lit(processing_date).alias("processing_date"),
    )


def gate(results: DataFrame) -> None:
    """Raise if any check failed; the failure list is sorted (bounded: one row per check)."""
    failed = sorted(r.check_name for r in results.filter(F.col("status") == FV.CHECK_FAILED)
                    .select("check_name").collect())
    if failed:
        raise QualityGateError(FV.GATE_FAILED_PREFIX + ", ".join(failed))


def curated_checks(customers: DataFrame, products: DataFrame, orders: DataFrame, details: DataFrame, ratings: DataFrame,
                   known_customers: DataFrame, known_products: DataFrame, run_id: str, processing_date: str) -> DataFrame:
    """The seven checks of one run over its day's rows; the one definition that stages and queries use."""
    c = F.col
    return run_checks(
        [(customers, [CountCheck(FV.CHECK_CUSTOMERS_PK_NULL, c("customerNumber").isNull())]),
         (products, [CountCheck(FV.CHECK_PRODUCTS_PK_NULL, c("productCode").isNull())]),
         (orders, [CountCheck(FV.CHECK_ORDERS_PK_NULL, c("orderNumber").isNull())]),
         (details, [CountCheck(FV.CHECK_NEGATIVE_ORDER_VALUES, (c("quantityOrdered") <= 0) | (c("priceEach") < 0))]),
         (ratings, [CountCheck(FV.CHECK_INVALID_RATING_RANGE, ~c("productRating").between(1, 5))])],
        [OrphanCheck(FV.CHECK_ORPHAN_ORDER_CUSTOMER, orders, "customerNumber", known_customers),
         OrphanCheck(FV.CHECK_ORPHAN_ORDER_PRODUCT, details, "productCode", known_products)],
        run_id, processing_date)


# ---- declarative model tests: each returns the failing rows (empty = pass) -------------------

def test_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def test_unique(df: DataFrame, column: str) -> DataFrame:
    """Key values occurring more than once (NULL is not a value), with their counts."""
    return (df.filter(F.col(column).isNotNull()).groupBy(column)
            .agg(F.count(F.lit(1)).alias("n_records")).filter(F.col("n_records") > 1))


def test_accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Rows whose value is outside the list; NULL passes."""
    return df.filter(F.col(column).isNotNull() & ~F.col(column).isin(list(values)))


def test_expression(df: DataFrame, column: str, expression: str) -> DataFrame:
    """Rows where ``<column> <expression>`` is false; NULL passes."""
    return df.filter(~F.coalesce(F.expr(f"`{column}` {expression}"), F.lit(True)))


def test_relationships(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Non-null child values without a parent row."""
    parents = parent.select(F.col(field).alias(column)).filter(F.col(column).isNotNull()).distinct()
    return child.filter(F.col(column).isNotNull()).join(parents, column, "left_anti")


# The declared tests of the models: (model, test, column, argument). Arguments are fixed values.
MODEL_TESTS = (
    ("dim_customers", "not_null", "customer_number", None),
    ("dim_customers", "unique", "customer_number", None),
    ("dim_customers", "expression", "credit_limit", ">= 0"),
    ("dim_products", "not_null", "product_code", None),
    ("dim_products", "unique", "product_code", None),
    ("dim_products", "expression", "quantity_in_stock", ">= 0"),
    ("fact_order_items", "not_null", "order_item_id", None),
    ("fact_order_items", "unique", "order_item_id", None),
    ("fact_order_items", "not_null", "quantity_ordered", None),
    ("fact_order_items", "not_null", "gross_amount", None),
    ("fact_order_items", "accepted_values", "order_status", FV.ORDER_STATUSES),
    ("fact_order_items", "relationships", "customer_number", ("dim_customers", "customer_number")),
    ("fact_order_items", "relationships", "product_code", ("dim_products", "product_code")),
    ("fact_order_items", "relationships", "order_date_key", ("dim_date", "date_key")),
    ("fact_order_items", "positive_order_values", "order_item_id", None),
    ("fact_product_ratings", "not_null", "rating_id", None),
    ("fact_product_ratings", "unique", "rating_id", None),
    ("fact_product_ratings", "accepted_values", "product_rating", FV.RATING_VALUES),
    ("fact_product_ratings", "relationships", "customer_number", ("dim_customers", "customer_number")),
    ("fact_product_ratings", "relationships", "product_code", ("dim_products", "product_code")),
)


def _row_test(test: str, column: str, argument) -> Column | None:
    """Predicate of a failing row; None for a test that needs more than the row."""
    c = F.col(column)
    if test == "not_null":
        return c.isNull()
    if test == "accepted_values":
        return c.isNotNull() & ~c.isin(list(argument))
    if test == "expression":
        return ~F.coalesce(F.expr(f"`{column}` {argument}"), F.lit(True))
    if test == "positive_order_values":
        return (F.col("quantity_ordered") <= 0) | (F.col("price_each") < 0) | (F.col("gross_amount") < 0)
    return None


def model_tests(models: dict[str, DataFrame], tests: Sequence[tuple] = MODEL_TESTS) -> DataFrame:
    """``model, test, column_name, failures, status`` of every declared test.

    All row tests of a model are one aggregate over it; a uniqueness test counts keys (combined
    map-side), a relationship test is an anti join of the distinct child keys, weighted by their rows.
    """
    parts = []
    for model in dict.fromkeys(t[0] for t in tests):
        own = [t[1:] for t in tests if t[0] == model]
        rows = [(t, c, p) for t, c, a in own if (p := _row_test(t, c, a)) is not None]
        df = models[model]
        if rows:
            counts = df.agg(*[F.count_if(F.coalesce(p, F.lit(False))).alias(f"n{i}") for i, (_, _, p) in enumerate(rows)])
            stack = ", ".join(f"'{t}', '{c}', n{i}" for i, (t, c, _) in enumerate(rows))
            parts.append(counts.selectExpr(f"'{model}' as model", f"stack({len(rows)}, {stack}) as (test, column_name, failures)"))
        for test, column, argument in own:
            keys = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
            if test == "unique":
                failures = keys.agg(F.count_if(F.col("_n") > 1).alias("failures"))
            elif test == "relationships":
                parent = models[argument[0]].select(F.col(argument[1]).alias(column))
                failures = keys.join(parent, column, "left_anti").agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("failures"))
            else:
                continue
            parts.append(failures.select(F.lit(model).alias("model"), F.lit(test).alias("test"), F.lit(column).alias("column_name"), "failures"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("failures", F.col("failures").cast("bigint")).withColumn(
        "status", F.when(F.col("failures") > 0, FV.CHECK_FAILED).otherwise(FV.CHECK_PASSED))


class ModelTestError(RuntimeError):
    pass


def model_gate(results: DataFrame) -> None:
    """Raise if a model test failed (one row per declared test reaches the driver)."""
    failed = sorted(f"{r.model}.{r.column_name}:{r.test} ({r.failures})" for r in results.filter(F.col("failures") > 0).collect())
    if failed:
        raise ModelTestError("Model tests failed: " + ", ".join(failed))


def content_sum(df: DataFrame, columns: Sequence[str]) -> tuple[Column, Column]:
    """Row count and order-free checksum of the rows' values: the sum of their 64-bit hashes, in a decimal that
    10^18 rows cannot overflow. Equal multisets of rows have equal sums."""
    return F.count(F.lit(1)), F.sum(F.xxhash64(*columns).cast("decimal(38,0)"))


def reconcile_content(source: DataFrame, results: Sequence[DataFrame], columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    """``by``, ``source_rows, result_rows, status`` of every group: ``match``, ``rows differ`` (their number) or
    ``content differs`` (as many rows, not the same ones: a row lost and another doubled, or a value changed).

    The results (valid rows, rejects of each kind) together have to be the source's rows. Every row is read once,
    hashed and summed; only sums are shuffled.
    """
    def summed(df: DataFrame, side: str) -> DataFrame:
        n, total = content_sum(df, columns)
        return df.groupBy(*by).agg(n.alias("n"), total.alias("total")).withColumn("side", F.lit(side))

    sums = summed(source, "source")
    for r in results:
        sums = sums.unionByName(summed(r, "result"))
    own = [(F.coalesce(F.sum(F.when(F.col("side") == s, F.col(c))), F.lit(0)).alias(f"{s}_{c}")) for s in ("source", "result") for c in ("n", "total")]
    out = sums.groupBy(*by).agg(*own)
    status = F.when(F.col("source_n") != F.col("result_n"), "rows differ").when(F.col("source_total") != F.col("result_total"), "content differs")
    return out.select(*by, F.col("source_n").cast("long").alias("source_rows"), F.col("result_n").cast("long").alias("result_rows"),
                      status.otherwise("match").alias("status"))
