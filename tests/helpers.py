"""Small frames in ingest order."""

RAW_ORDERS = [
    ("1", "10", "100", "2", "2024-01-15", "completed"),
    ("2", "20", "200", "1", "2024-02-20", "shipped"),
    ("3", "10", "100", "3", "2024-01-15", "completed"),
    ("3", "10", "100", "3", "2024-01-15", "completed"),
    ("4", None, "300", "5", "2024-03-10", "pending"),
    ("5", "30", "200", None, "2024-04-05", "cancelled"),
]
RAW_CUSTOMERS = [
    ("10", "Alice Smith", "alice@test.com", "NYC, NY", "2023-01-01"),
    ("20", None, "bob@test.com", "LA, CA", "2023-06-15"),
    ("30", "Charlie Brown", None, "Chicago, IL", "2024-01-01"),
    ("30", "Charlie Brown", None, "Chicago, IL", "2024-01-01"),
]
RAW_PRODUCTS = [
    ("100", "Widget A", "Electronics", "29.99", "Supplier X"),
    ("200", None, "Clothing", "49.99", "Supplier Y"),
    ("300", "Gadget C", "Electronics", None, "Supplier Z"),
]


def frame(spark, rows, columns):
    """Text columns plus ``seq``, the position in the list."""
    ddl = ", ".join(f"`{c}` string" for c in columns) + ", seq bigint"
    return spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], ddl)


def orders(spark, rows=RAW_ORDERS):
    return frame(spark, rows, ["order_id", "customer_id", "product_id", "quantity", "order_date", "status"])


def customers(spark, rows=RAW_CUSTOMERS):
    return frame(spark, rows, ["customer_id", "name", "email", "location", "signup_date"])


def products(spark, rows=RAW_PRODUCTS):
    return frame(spark, rows, ["product_id", "product_name", "category", "price", "supplier"])


def rows(df, *order):
    out = [tuple(r) for r in df.collect()]
    return sorted(out, key=repr) if not order else [tuple(r) for r in df.orderBy(*order).collect()]


def final_plan(df):
    """The plan after adaptive execution."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()
