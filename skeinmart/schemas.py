"""Table contracts: columns, types, keys, defaults and value domains."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


def all_string(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


# --- raw zone: every column is text, casting is the cleaning step's job -------
RAW_COLUMNS = {
    "orders": ["order_id", "customer_id", "product_id", "quantity", "order_date", "status"],
    "customers": ["customer_id", "name", "email", "location", "signup_date"],
    "products": ["product_id", "product_name", "category", "price", "supplier"],
}
RAW_SCHEMAS = {name: all_string(cols) for name, cols in RAW_COLUMNS.items()}
RAW_TABLES = tuple(RAW_COLUMNS)

# An upload must provide these; signup_date and supplier are optional.
UPLOAD_COLUMNS = {
    "orders": ["order_id", "customer_id", "product_id", "quantity", "order_date", "status"],
    "customers": ["customer_id", "name", "email", "location"],
    "products": ["product_id", "product_name", "category", "price"],
}

# Columns without which an order cannot be read at all.
MANDATORY_ORDER_COLUMNS = ["order_id", "customer_id", "product_id", "quantity", "order_date"]

# --- cleaned tables ----------------------------------------------------------
CLEAN_ORDERS = _struct(
    ("order_id", T.LongType(), True),
    ("customer_id", T.LongType(), True),
    ("product_id", T.LongType(), True),
    ("quantity", T.LongType(), True),
    ("order_date", T.DateType(), True),
    ("status", T.StringType(), True),
)
CLEAN_CUSTOMERS = _struct(
    ("customer_id", T.LongType(), True),
    ("name", T.StringType(), True),
    ("email", T.StringType(), True),
    ("location", T.StringType(), True),
    ("signup_date", T.DateType(), True),
)
CLEAN_PRODUCTS = _struct(
    ("product_id", T.LongType(), True),
    ("product_name", T.StringType(), True),
    ("category", T.StringType(), True),
    ("price", T.DoubleType(), True),
    ("supplier", T.StringType(), True),
)

# --- star schema -------------------------------------------------------------
STAR_SCHEMAS = {
    "dim_date": _struct(
        ("date_id", T.IntegerType(), False),
        ("full_date", T.DateType(), False),
        ("day", T.IntegerType(), False),
        ("month", T.IntegerType(), False),
        ("year", T.IntegerType(), False),
        ("quarter", T.IntegerType(), False),
        ("day_of_week", T.IntegerType(), False),
        ("day_name", T.StringType(), False),
        ("month_name", T.StringType(), False),
        ("is_weekend", T.BooleanType(), False),
    ),
    "dim_customers": _struct(
        ("customer_id", T.LongType(), False),
        ("name", T.StringType(), False),
        ("email", T.StringType(), True),
        ("location", T.StringType(), True),
    ),
    "dim_products": _struct(
        ("product_id", T.LongType(), False),
        ("product_name", T.StringType(), False),
        ("category", T.StringType(), True),
        ("price", T.DoubleType(), False),
        ("supplier", T.StringType(), True),
    ),
    "fact_orders": _struct(
        ("order_id", T.LongType(), False),
        ("customer_id", T.LongType(), False),
        ("product_id", T.LongType(), False),
        ("date_id", T.IntegerType(), False),
        ("quantity", T.LongType(), False),
        ("unit_price", T.DoubleType(), False),
        ("revenue", T.DoubleType(), False),
        ("order_status", T.StringType(), False),
    ),
}
STAR_TABLES = tuple(STAR_SCHEMAS)
PRIMARY_KEYS = {
    "dim_date": "date_id",
    "dim_customers": "customer_id",
    "dim_products": "product_id",
    "fact_orders": "order_id",
}
# fact column = dimension column -> dimension table
FOREIGN_KEYS = {
    "customer_id": "dim_customers",
    "product_id": "dim_products",
    "date_id": "dim_date",
}

# --- report and manifest shapes ----------------------------------------------
REPORT_SCHEMA = _struct(
    ("check", T.StringType(), True),
    ("table", T.StringType(), True),
    ("passed", T.BooleanType(), True),
    ("details", T.StringType(), True),
)
MANIFEST_DDL = (
    "status string, mode string, env string, timestamp string, "
    "steps map<string, struct<status: string, duration: double, row_counts: map<string, bigint>>>, "
    "error string, traceback string, total_duration double"
)
NESTED_REPORT_DDL = (
    "map<string, struct<success: boolean, "
    "statistics: struct<evaluated_expectations: bigint, successful_expectations: bigint, "
    "unsuccessful_expectations: bigint, success_percent: double>, "
    "results: array<struct<check: string, success: boolean, message: string>>>>"
)

# --- fixed values: results depend on them -------------------------------------
DEFAULT_STATUS = "completed"
DEFAULT_NAME = "Unknown"
DEFAULT_EMAIL = "unknown@example.com"
DEFAULT_LOCATION = "Unknown"
DEFAULT_PRODUCT_NAME = "Unknown Product"
DEFAULT_CATEGORY = "General"
DEFAULT_SUPPLIER = "Unknown"
CANCELLED = "cancelled"
ORDER_STATUSES = ["completed", "pending", "shipped", "cancelled", "returned"]
# Minimum row counts of the quality suite.
MIN_ROWS = {"fact_orders": 100, "dim_customers": 10, "dim_products": 5, "dim_date": 10}
# Empty markers a CSV field may hold (the default list of pandas.read_csv).
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
CATEGORIES = [
    "Electronics", "Clothing", "Home & Kitchen", "Books", "Sports & Outdoors",
    "Beauty", "Toys & Games", "Automotive", "Health", "Grocery",
]
LOG_LEVELS = ["INFO", "WARNING", "ERROR"]
