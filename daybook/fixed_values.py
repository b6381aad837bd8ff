"""Texts, names and limits that must equal the published behaviour for results to
match (reject reasons, statuses, check names, run messages, accepted values, length limits).
Everything else in the package refers to these names.
"""

# ---- fixed values: reject reasons (relational tables) -----------------------------------------
REASON_ORDER_NUMBER_NULL = "orderNumber is null"
REASON_ORDER_LINE_NUMBER_NULL = "orderLineNumber is null"
REASON_CUSTOMER_NUMBER_NULL = "customerNumber is null"
REASON_CHECK_NUMBER_NULL = "checkNumber is null"
REASON_PRODUCT_CODE_NULL = "productCode is null"
REASON_EMPLOYEE_NUMBER_NULL = "employeeNumber is null"
REASON_OFFICE_CODE_NULL = "officeCode is null"
REASON_PRODUCT_LINE_NULL = "productLine is null"
REASON_QUANTITY_ORDERED_NOT_NUMERIC = "quantityOrdered is null or not numeric"
REASON_PRICE_EACH_NOT_NUMERIC = "priceEach is null or not numeric"
REASON_QUANTITY_ORDERED_NOT_POSITIVE = "quantityOrdered must be positive"
REASON_PRICE_EACH_NEGATIVE = "priceEach cannot be negative"
REASON_AMOUNT_NOT_NUMERIC = "amount is null or not numeric"
REASON_AMOUNT_NEGATIVE = "amount cannot be negative"
REASON_QUANTITY_IN_STOCK_NOT_NUMERIC = "quantityInStock is null or not numeric"
REASON_BUY_PRICE_NOT_NUMERIC = "buyPrice is null or not numeric"
REASON_MSRP_NOT_NUMERIC = "MSRP is null or not numeric"
REASON_QUANTITY_IN_STOCK_NEGATIVE = "quantityInStock cannot be negative"
REASON_BUY_PRICE_NEGATIVE = "buyPrice cannot be negative"
REASON_MSRP_NEGATIVE = "MSRP cannot be negative"
REASON_DEFAULT = "business rule failed"
REASON_DUPLICATE_KEY = "duplicate business key in the same batch"
REASON_SEPARATOR = "; "

# ---- fixed values: reject reasons (ratings feed) ----------------------------------------------
REASON_RATING_OUT_OF_RANGE = "productRating must be between 1 and 5"
REASON_DUPLICATE_RATING = "duplicate rating event in the same batch"
REASON_UNKNOWN_REFERENCE = "customer or product not found in curated master data"

# ---- fixed values: stage and run statuses, messages, limits -----------------------------------
STATUS_RUNNING = "RUNNING"
STATUS_SUCCEEDED = "SUCCEEDED"
STATUS_SUCCEEDED_WITH_REJECTS = "SUCCEEDED_WITH_REJECTS"
STATUS_FAILED = "FAILED"
CHECK_PASSED = "PASSED"
CHECK_FAILED = "FAILED"
RUN_FAILED_PREFIX = "Failed or upstream-failed tasks: "
RUN_OK_MESSAGE = "All pipeline stages completed successfully"
GATE_FAILED_PREFIX = "Critical data-quality checks failed: "
ERROR_MESSAGE_LIMIT = 3000
RUN_MESSAGE_LIMIT = 1000

# ---- fixed values: quality check names ---------------------------------------------------------
CHECK_CUSTOMERS_PK_NULL = "customers_pk_null"
CHECK_PRODUCTS_PK_NULL = "products_pk_null"
CHECK_ORDERS_PK_NULL = "orders_pk_null"
CHECK_NEGATIVE_ORDER_VALUES = "negative_order_values"
CHECK_INVALID_RATING_RANGE = "invalid_rating_range"
CHECK_ORPHAN_ORDER_CUSTOMER = "orphan_order_customer"
CHECK_ORPHAN_ORDER_PRODUCT = "orphan_order_product"

# ---- fixed values: accepted values and sources --------------------------------------------------
ORDER_STATUSES = ("SHIPPED", "RESOLVED", "CANCELLED", "ON HOLD", "DISPUTED", "IN PROCESS")
RATING_VALUES = (1, 2, 3, 4, 5)
SOURCE_DATABASE = "mysql_rds"
SOURCE_CURATED = "landing_rds"

# ---- fixed values: audit stage names and the model build-time column ----------------------------
STAGE_DATABASE_LANDING = "rds_landing"
STAGE_RATINGS_LANDING = "ratings_json_landing"
STAGE_RELATIONAL_TRANSFORM = "batch_transform"
STAGE_RATINGS_TRANSFORM = "ratings_for_ml_transform"
STAGE_RATINGS_MERGE = "ratings_iceberg_merge"
STAGE_QUALITY = "curated_quality_checks"
MODEL_BUILD_TS_COLUMN = "dbt_updated_at"
