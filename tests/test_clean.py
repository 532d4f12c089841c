"""Cleaning rules, default values, coercion and dedupe."""

from datetime import date

import numpy as np
import pytest

import helpers as H
from skeinmart.functions.text import null_tokens_to_null, strip, title_case
from skeinmart.functions.dates import ISO_FORMATS
from skeinmart.operators import clean
from skeinmart.operators.dedupe import keep_first
from pyspark.sql import functions as F

SEQ = ["seq"]


def prices(spark, rows):
    """(category, price) rows in, final price per product out."""
    raw = H.products(spark, [(str(i), "p", c, p, "s") for i, (c, p) in enumerate(rows)])
    return [r["price"] for r in clean.clean_products(raw, SEQ).orderBy("product_id").collect()]


def test_orders_fixture(spark):
    assert H.rows(clean.clean_orders(H.orders(spark), SEQ)) == [
        (1, 10, 100, 2, date(2024, 1, 15), "completed"),
        (2, 20, 200, 1, date(2024, 2, 20), "shipped"),
        (3, 10, 100, 3, date(2024, 1, 15), "completed"),
    ]


def test_orders_types(spark):
    assert clean.clean_orders(H.orders(spark), SEQ).schema.simpleString() == (
        "struct<order_id:bigint,customer_id:bigint,product_id:bigint,quantity:bigint,order_date:date,status:string>"
    )


def test_customers_fixture(spark):
    assert H.rows(clean.clean_customers(H.customers(spark), SEQ)) == [
        (10, "Alice Smith", "alice@test.com", "NYC, NY", date(2023, 1, 1)),
        (20, "Unknown", "bob@test.com", "LA, CA", date(2023, 6, 15)),
        (30, "Charlie Brown", "unknown@example.com", "Chicago, IL", date(2024, 1, 1)),
    ]


def test_products_fixture(spark):
    assert H.rows(clean.clean_products(H.products(spark), SEQ)) == [
        (100, "Widget A", "Electronics", 29.99, "Supplier X"),
        (200, "Unknown Product", "Clothing", 49.99, "Supplier Y"),
        (300, "Gadget C", "Electronics", 29.99, "Supplier Z"),
    ]


def test_invalid_row_does_not_shadow_a_later_valid_one(spark):
    raw = H.orders(spark, [
        ("7", "1", "1", None, "2024-01-01", "first"),
        ("7", "1", "1", "4", "2024-01-02", "second"),
        ("7", "1", "1", "5", "2024-01-03", "third"),
    ])
    assert H.rows(clean.clean_orders(raw, SEQ)) == [(7, 1, 1, 4, date(2024, 1, 2), "second")]


@pytest.mark.parametrize("text,value", [
    ("12", 12), ("12.0", 12), ("2.7", 2), ("-2.7", -2), (" 3 ", 3), ("+4", 4), ("1e3", 1000), (".5", 0), ("5.", 5),
    ("9007199254740993", 9007199254740993), ("9223372036854775807", 9223372036854775807),
    ("9223372036854775808", None), ("1e30", None), ("inf", None), ("-Infinity", None), ("nan", None), ("1d", None),
    ("2f", None), ("0x10", None), ("1_0", None), ("1,000", None), ("abc", None), ("", None), (None, None),
])
def test_integer_coercion(spark, text, value):
    df = spark.createDataFrame([(text,)], "c string")
    assert df.select(clean.integer_column(df, "c")).first()[0] == value


@pytest.mark.parametrize("text,value", [
    ("9.99", 9.99), ("1e-3", 0.001), (" 7.5 ", 7.5), ("n/k", None), ("inf", None), ("1d", None), ("1e400", None),
])
def test_number_coercion(spark, text, value):
    df = spark.createDataFrame([(text,)], "c string")
    assert df.select(clean.number_column(df, "c")).first()[0] == value


def test_typed_columns_pass(spark):
    df = spark.createDataFrame([(2.7, 5, float("inf"))], "d double, i int, x double")
    got = df.select(*[clean.integer_column(df, c) for c in df.columns], clean.number_column(df, "x")).first()
    assert tuple(got) == (2, 5, None, None)


@pytest.mark.parametrize("text,ok", [
    ("2024-02-29", True), ("2024-02-30", False), ("2024", False), ("20240301", False), ("01/20/2024", False),
    ("2024-1-5", False), ("2024-01-05 ", False), ("2024-01-05T10:00:00", False), ("", False),
])
def test_only_iso_dates(spark, text, ok):
    raw = H.orders(spark, [("1", "1", "1", "1", text, None)])
    assert clean.clean_orders(raw, SEQ).count() == int(ok)


@pytest.mark.parametrize("text,ok", [
    ("2024-02-29", True), ("2024-02-29 10:30:00", True), ("2024-02-29T10:30", True), ("2024-02-29 10:30:00.123+02:00", True),
    ("2024-02-30 10:30:00", False), ("2024-02-29 25:00:00", False), ("2024-02-29 10:30:00\n", False), ("2024-02-29 x", False),
])
def test_dates_with_times(spark, text, ok):
    raw = H.orders(spark, [("1", "1", "1", "1", text, None)])
    got = [r["order_date"] for r in clean.clean_orders(raw, SEQ, date_format=ISO_FORMATS).collect()]
    assert got == [date(2024, 2, 29)] * ok


def test_first_format_that_reads(spark):
    raw = H.orders(spark, [("1", "1", "1", "1", "05/01/2024", None), ("2", "1", "1", "1", "2024-01-05", None)])
    got = clean.clean_orders(raw, SEQ, date_format=["dd/MM/yyyy", "MM/dd/yyyy", "yyyy-MM-dd"]).collect()
    assert {r["order_date"] for r in got} == {date(2024, 1, 5)} and len(got) == 2


def test_date_format_option(spark):
    raw = H.orders(spark, [("1", "1", "1", "1", "20/01/2024", None)])
    assert clean.clean_orders(raw, SEQ, date_format="dd/MM/yyyy").first()["order_date"] == date(2024, 1, 20)


def test_status_default_trim_lower(spark):
    raw = H.orders(spark, [
        ("1", "1", "1", "1", "2024-01-01", None),
        ("2", "1", "1", "1", "2024-01-01", " \tSHIPPED\n"),
    ])
    assert [r["status"] for r in clean.clean_orders(raw, SEQ).orderBy("order_id").collect()] == ["completed", "shipped"]
    no_status = clean.clean_orders(raw.drop("status"), SEQ)
    assert {r["status"] for r in no_status.collect()} == {"completed"}


def test_missing_mandatory_order_column_raises(spark):
    with pytest.raises(ValueError, match="quantity"):
        clean.clean_orders(H.orders(spark).drop("quantity"), SEQ)
    with pytest.raises(ValueError, match="ingest order"):
        clean.clean_orders(H.orders(spark))


def test_optional_columns(spark):
    only_id = clean.clean_customers(H.customers(spark).select("customer_id", "seq"), SEQ)
    assert H.rows(only_id)[0] == (10, "Unknown", "unknown@example.com", "Unknown", None)
    no_id = clean.clean_customers(H.customers(spark).drop("customer_id"), SEQ)
    assert no_id.count() == 0 and no_id.columns == ["customer_id", "name", "email", "location", "signup_date"]
    no_price = clean.clean_products(H.products(spark).drop("price"), SEQ)
    assert {r["price"] for r in no_price.collect()} == {0.0}
    no_category = clean.clean_products(H.products(spark).drop("category"), SEQ)
    assert [(r["price"], r["category"]) for r in no_category.orderBy("product_id").collect()] == [
        (29.99, "General"), (49.99, "General"), (0.0, "General"),
    ]
    assert clean.clean_products(H.products(spark).drop("product_id"), SEQ).count() == 0
    bare = clean.clean_products(H.products(spark).select("product_id", "seq"), SEQ)
    assert H.rows(bare)[0] == (100, "Unknown Product", "General", 0.0, "Unknown")


def test_null_category_loses_its_price(spark):
    assert prices(spark, [(None, "7.00"), ("a", "1.00"), ("a", None), ("b", None)]) == [1.0] * 4


def test_null_category_keeps_its_price_on_request(spark):
    raw = H.products(spark, [("1", "p", None, "7.00", "s"), ("2", "p", "a", "1.00", "s"), ("3", "p", "b", None, "s")])
    got = clean.clean_products(raw, SEQ, keep_price_for_null_category=True).orderBy("product_id").collect()
    assert [r["price"] for r in got] == [7.0, 1.0, 4.0]


def test_median_rounds_like_numpy(spark):
    # Medians that lie on a tie of the third digit.
    values = [0.545, 0.575, 1.015, 942.365]
    rows = [(f"c{i}", p) for i, v in enumerate(values) for p in (str(v), None)]
    assert prices(spark, rows)[1::2] == [0.55, 0.57, 1.01, 942.36] == list(np.round(values, 2))


def test_median_sees_duplicates_and_untrimmed_categories(spark):
    # Three rows of product 1 weigh three times; " a" is another category than "a".
    raw = H.products(spark, [
        ("1", "p", "a", "1", "s"), ("1", "p", "a", "1", "s"), ("1", "p", "a", "1", "s"),
        ("2", "p", "a", "9", "s"), ("3", "p", "a", None, "s"), ("4", "p", " a", "100", "s"), ("5", "p", " a", None, "s"),
    ])
    got = {r["product_id"]: r["price"] for r in clean.clean_products(raw, SEQ).collect()}
    assert got == {1: 1.0, 2: 9.0, 3: 1.0, 4: 100.0, 5: 100.0}


def test_equal_prices_of_many_categories_are_one_value(spark):
    counts = spark.range(20000).selectExpr("concat('c', id) AS category", "9.99D AS price", "1L AS n")
    overall = clean.overall_median(counts, clean.category_medians(counts))
    assert overall.first()["median"] == 9.99
    windowed = overall._jdf.queryExecution().optimizedPlan().toString()
    assert windowed.count("Aggregate [all_rows") >= 2  # by value, then by bucket


def test_no_price_anywhere(spark):
    assert prices(spark, [("a", None), (None, "x")]) == [None, None]


def test_text_helpers(spark):
    cases = ["o'brien", "3d tv", "\tpadded ", "ÉCOLE élémentaire", "mcDONALD-smith", "a1b2", "x\x1f"]
    df = spark.createDataFrame([(c,) for c in cases], "c string")
    got = [tuple(r) for r in df.select("c", strip(F.col("c")), title_case(strip(F.col("c")))).collect()]
    assert got == [(c, c.strip(), c.strip().title()) for c in cases]


def test_null_tokens(spark):
    df = spark.createDataFrame([("NA", 1), ("null", 2), ("N/A", 3), ("None", 4), ("nan", 5), ("", 6), ("ok", 7)], "c string, n int")
    assert [r["c"] for r in null_tokens_to_null(df).orderBy("n").collect()] == [None] * 6 + ["ok"]


def test_keep_first_drops_a_hot_key_before_the_shuffle(spark):
    n = 30_000
    key = F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id"))
    hot = spark.range(n).select(key.alias("k"), (F.lit(n) - F.col("id")).alias("seq"))
    first = keep_first(hot, ["k"], ["seq"])
    text = H.plan(first)
    assert text.count("WindowGroupLimit") == 2
    assert text.rindex("WindowGroupLimit") > text.index("Exchange hashpartitioning"), "limit below the shuffle"
    assert first.count() == n * 2 // 3 + 1
    assert first.filter("k = -1").first()["seq"] == 3


def test_rows_removed(spark):
    raw = {"orders": H.orders(spark), "customers": H.customers(spark), "products": H.products(spark)}
    assert H.rows(clean.rows_removed(raw)) == [("customers", 4, 3, 1), ("orders", 6, 3, 3), ("products", 3, 3, 0)]
