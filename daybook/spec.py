"""Declarative table specifications: source schema, primary key, typing and business rules.

One ``TableSpec`` per source table replaces one script per table: typing (``operators.typing``),
validation (``operators.validate``) and dedupe (``operators.dedupe``) are driven from it.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DateType,
    DecimalType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


from daybook import fixed_values as FV

# Key-null reason per primary-key column (fixed values, see fixed_values.py).
KEY_NULL_REASONS = {
    "orderNumber": FV.REASON_ORDER_NUMBER_NULL, "orderLineNumber": FV.REASON_ORDER_LINE_NUMBER_NULL,
    "customerNumber": FV.REASON_CUSTOMER_NUMBER_NULL, "checkNumber": FV.REASON_CHECK_NUMBER_NULL,
    "productCode": FV.REASON_PRODUCT_CODE_NULL, "employeeNumber": FV.REASON_EMPLOYEE_NUMBER_NULL,
    "officeCode": FV.REASON_OFFICE_CODE_NULL, "productLine": FV.REASON_PRODUCT_LINE_NULL,
}


@dataclass(frozen=True)
class Rule:
    """A business rule: ``violated()`` is true for a bad row.

    ``null_is_violation`` decides a NULL outcome (e.g. ``NOT (NULL BETWEEN 1 AND 5)``): a
    three-valued mask must not let a row fall into neither the valid nor the rejected split.
    """

    message: str
    violated: Callable[[], Column]
    null_is_violation: bool = False

    def mask(self) -> Column:
        return F.coalesce(self.violated(), F.lit(self.null_is_violation))


@dataclass(frozen=True)
class TableSpec:
    name: str
    schema: StructType
    primary_key: tuple[str, ...]
    casts: tuple[tuple[str, str], ...]
    rules: tuple[Rule, ...] = field(default_factory=tuple)

    def key_rules(self) -> tuple[Rule, ...]:
        return tuple(Rule(KEY_NULL_REASONS[k], _is_null(k)) for k in self.primary_key)

    def all_rules(self) -> tuple[Rule, ...]:
        """Key rules first (in key order), then the table's own rules, as the reason text lists them."""
        return self.key_rules() + self.rules


def _is_null(name: str) -> Callable[[], Column]:
    return lambda: F.col(name).isNull()


def _lt0(name: str) -> Callable[[], Column]:
    return lambda: F.col(name) < 0


def _s(name: str) -> StructField:
    return StructField(name, StringType(), True)


def _dec(name: str) -> StructField:
    return StructField(name, DecimalType(10, 2), True)


UPDATED_AT = StructField("updated_at", TimestampType(), False)

# Source schemas of the eight relational tables (column names and types are fixed values).
SCHEMAS = {
    "offices": StructType([
        _s("officeCode"), _s("city"), _s("phone"), _s("addressLine1"), _s("addressLine2"), _s("state"),
        _s("country"), _s("postalCode"), _s("territory"), UPDATED_AT,
    ]),
    "employees": StructType([
        StructField("employeeNumber", IntegerType(), False), _s("lastName"), _s("firstName"), _s("extension"),
        _s("email"), _s("officeCode"), StructField("reportsTo", IntegerType(), True), _s("jobTitle"), UPDATED_AT,
    ]),
    "customers": StructType([
        StructField("customerNumber", IntegerType(), False), _s("customerName"), _s("contactLastName"),
        _s("contactFirstName"), _s("phone"), _s("addressLine1"), _s("addressLine2"), _s("city"), _s("state"),
        _s("postalCode"), _s("country"), StructField("salesRepEmployeeNumber", IntegerType(), True),
        _dec("creditLimit"), UPDATED_AT,
    ]),
    "productlines": StructType([_s("productLine"), _s("textDescription"), _s("htmlDescription"), UPDATED_AT]),
    "products": StructType([
        _s("productCode"), _s("productName"), _s("productLine"), _s("productScale"), _s("productVendor"),
        _s("productDescription"), StructField("quantityInStock", IntegerType(), True), _dec("buyPrice"),
        _dec("MSRP"), UPDATED_AT,
    ]),
    "orders": StructType([
        StructField("orderNumber", IntegerType(), False), StructField("orderDate", DateType(), True),
        StructField("requiredDate", DateType(), True), StructField("shippedDate", DateType(), True),
        _s("status"), _s("comments"), StructField("customerNumber", IntegerType(), True), UPDATED_AT,
    ]),
    "orderdetails": StructType([
        StructField("orderNumber", IntegerType(), False), _s("productCode"),
        StructField("quantityOrdered", IntegerType(), True), _dec("priceEach"),
        StructField("orderLineNumber", IntegerType(), False), UPDATED_AT,
    ]),
    "payments": StructType([
        StructField("customerNumber", IntegerType(), False), _s("checkNumber"),
        StructField("paymentDate", DateType(), True), _dec("amount"), UPDATED_AT,
    ]),
}

# Primary keys and cast lists of the tables.
SPECS: dict[str, TableSpec] = {
    "customers": TableSpec(
        "customers", SCHEMAS["customers"], ("customerNumber",),
        (("customerNumber", "bigint"), ("customerName", "string"), ("creditLimit", "double")),
    ),
    "employees": TableSpec(
        "employees", SCHEMAS["employees"], ("employeeNumber",),
        (("employeeNumber", "bigint"), ("lastName", "string"), ("firstName", "string")),
    ),
    "offices": TableSpec(
        "offices", SCHEMAS["offices"], ("officeCode",),
        (("officeCode", "string"), ("city", "string"), ("country", "string")),
    ),
    "orderdetails": TableSpec(
        "orderdetails", SCHEMAS["orderdetails"], ("orderNumber", "orderLineNumber"),
        (("orderNumber", "bigint"), ("productCode", "string"), ("quantityOrdered", "int"),
         ("priceEach", "double"), ("orderLineNumber", "int")),
        (
            Rule(FV.REASON_QUANTITY_ORDERED_NOT_NUMERIC, _is_null("quantityOrdered")),
            Rule(FV.REASON_PRICE_EACH_NOT_NUMERIC, _is_null("priceEach")),
            Rule(FV.REASON_QUANTITY_ORDERED_NOT_POSITIVE, lambda: F.col("quantityOrdered") <= 0),
            Rule(FV.REASON_PRICE_EACH_NEGATIVE, _lt0("priceEach")),
        ),
    ),
    "orders": TableSpec(
        "orders", SCHEMAS["orders"], ("orderNumber",),
        (("orderNumber", "bigint"), ("orderDate", "date"), ("status", "string"), ("customerNumber", "bigint")),
    ),
    "payments": TableSpec(
        "payments", SCHEMAS["payments"], ("customerNumber", "checkNumber"),
        (("customerNumber", "bigint"), ("checkNumber", "string"), ("paymentDate", "date"), ("amount", "double")),
        (Rule(FV.REASON_AMOUNT_NOT_NUMERIC, _is_null("amount")), Rule(FV.REASON_AMOUNT_NEGATIVE, _lt0("amount"))),
    ),
    "productlines": TableSpec(
        "productlines", SCHEMAS["productlines"], ("productLine",),
        (("productLine", "string"), ("textDescription", "string")),
    ),
    "products": TableSpec(
        "products", SCHEMAS["products"], ("productCode",),
        (("productCode", "string"), ("productName", "string"), ("productLine", "string"),
         ("quantityInStock", "int"), ("buyPrice", "double"), ("MSRP", "double")),
        (
            Rule(FV.REASON_QUANTITY_IN_STOCK_NOT_NUMERIC, _is_null("quantityInStock")),
            Rule(FV.REASON_BUY_PRICE_NOT_NUMERIC, _is_null("buyPrice")),
            Rule(FV.REASON_MSRP_NOT_NUMERIC, _is_null("MSRP")),
            Rule(FV.REASON_QUANTITY_IN_STOCK_NEGATIVE, _lt0("quantityInStock")),
            Rule(FV.REASON_BUY_PRICE_NEGATIVE, _lt0("buyPrice")),
            Rule(FV.REASON_MSRP_NEGATIVE, _lt0("MSRP")),
        ),
    ),
}

TABLES = tuple(SPECS)

# Ratings feed: typed and validated by its own rules (first failing reason wins).
RATING_KEYS = ("customerNumber", "productCode", "ratingTimestamp")
RATING_PAIR = ("customerNumber", "productCode")

RATING_RULES = (
    Rule(FV.REASON_CUSTOMER_NUMBER_NULL, _is_null("customerNumber")),
    Rule(FV.REASON_PRODUCT_CODE_NULL, _is_null("productCode")),
    Rule(FV.REASON_RATING_OUT_OF_RANGE, lambda: ~F.col("productRating").between(1, 5), null_is_violation=True),
)

DUPLICATE_KEY_REASON = FV.REASON_DUPLICATE_KEY
DUPLICATE_RATING_REASON = FV.REASON_DUPLICATE_RATING
UNKNOWN_REFERENCE_REASON = FV.REASON_UNKNOWN_REFERENCE
DEFAULT_REASON = FV.REASON_DEFAULT

# Curated mutable tables (fixed DDL).
RATINGS_FOR_ML_SCHEMA = StructType([
    StructField("customerNumber", LongType()), StructField("productCode", StringType()),
    StructField("productName", StringType()), StructField("productLine", StringType()),
    StructField("productRating", IntegerType()), StructField("ratingTimestamp", TimestampType()),
    StructField("ingest_ts", TimestampType()), StructField("source", StringType()),
    StructField("processing_date", StringType()), StructField("processing_ts", TimestampType()),
])

RATINGS_SCHEMA = StructType([
    StructField("customerNumber", LongType()), StructField("productCode", StringType()),
    StructField("productRating", IntegerType()), StructField("ratingTimestamp", TimestampType()),
    StructField("ingest_ts", TimestampType()), StructField("source", StringType()),
    StructField("processing_date", StringType()),
])

ORDER_STATUSES = FV.ORDER_STATUSES
