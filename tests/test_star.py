"""Star builders."""

from datetime import date

import helpers as H
from skeinmart.functions.dates import date_key, key_date
from skeinmart.operators import clean, star
from skeinmart.plans.pipeline import transform_all
from skeinmart.schemas import STAR_SCHEMAS
from pyspark.sql import functions as F

BY = {"orders": ["seq"], "customers": ["seq"], "products": ["seq"]}


def fixture_star(spark):
    raw = {"orders": H.orders(spark), "customers": H.customers(spark), "products": H.products(spark)}
    return transform_all(raw, BY)


def test_dim_date(spark):
    assert H.rows(fixture_star(spark)["dim_date"]) == [
        (20240115, date(2024, 1, 15), 15, 1, 2024, 1, 0, "Monday", "January", False),
        (20240220, date(2024, 2, 20), 20, 2, 2024, 1, 1, "Tuesday", "February", False),
    ]


def test_fact_orders(spark):
    fact = fixture_star(spark)["fact_orders"]
    assert H.rows(fact) == [
        (1, 10, 100, 20240115, 2, 29.99, 59.98, "completed"),
        (2, 20, 200, 20240220, 1, 49.99, 49.99, "shipped"),
        (3, 10, 100, 20240115, 3, 29.99, 89.97, "completed"),
    ]
    assert round(fact.agg(F.sum("revenue")).first()[0], 2) == 199.94


def test_contract_columns_and_types(spark):
    for name, df in fixture_star(spark).items():
        have = [(f.name, f.dataType) for f in df.schema.fields]
        assert have == [(f.name, f.dataType) for f in STAR_SCHEMAS[name].fields], name


def test_unknown_product_costs_nothing(spark):
    orders = clean.clean_orders(H.orders(spark, [("1", "1", "999", "3", "2024-01-01", None)]), ["seq"])
    products = clean.clean_products(H.products(spark), ["seq"])
    assert H.rows(star.build_fact_orders(orders, products)) == [(1, 1, 999, 20240101, 3, 0.0, 0.0, "completed")]


def test_weekend_and_days(spark):
    days = spark.sql("select explode(sequence(date'2024-01-01', date'2024-01-07')) as order_date")
    got = [(r["day_of_week"], r["day_name"], r["is_weekend"]) for r in star.build_dim_date(days).orderBy("date_id").collect()]
    names = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
    assert got == [(i, n, i >= 5) for i, n in enumerate(names)]


def test_date_key_round_trip(spark):
    days = spark.sql("select explode(sequence(date'1999-12-25', date'2000-03-05')) as d")
    assert days.filter(key_date(date_key(F.col("d"))) != F.col("d")).count() == 0
    same = star.build_dim_date(days.withColumnRenamed("d", "order_date"))
    from_fact = star.build_dim_date_from_fact(days.select(date_key(F.col("d")).alias("date_id")))
    assert H.rows(same) == H.rows(from_fact)


def test_backfill(spark):
    part = spark.createDataFrame([(1, 5)], "order_id bigint, quantity bigint")
    assert H.rows(star.backfill(part, STAR_SCHEMAS["fact_orders"])) == [(1, 0, 0, 0, 5, 0.0, 0.0, "unknown")]


def test_fact_join_is_broadcast_only_under_the_threshold(spark):
    orders = clean.clean_orders(H.orders(spark), ["seq"])
    products = clean.clean_products(H.products(spark), ["seq"])
    assert "BroadcastHashJoin" in H.final_plan(star.build_fact_orders(orders, products))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = H.final_plan(star.build_fact_orders(orders, products))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" not in text and "SortMergeJoin" in text
