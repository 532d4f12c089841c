"""Printed report, display formats, and plain SQL over the star."""

import pytest

import helpers as H
from pyspark.sql import functions as F
from skeinmart.functions import display as D
from skeinmart.plans import analytics, marts
from skeinmart.plans.report import text_report
from skeinmart.sources.files import register_views
from test_star import fixture_star


@pytest.fixture(scope="module")
def star(spark):
    return fixture_star(spark)


def test_text_report(star):
    got = {title: [r["line"] for r in df.orderBy("position").collect()] for title, df in text_report(star).items()}
    assert got == {
        "TABLE ROW COUNTS": [f"  {t}: {n} rows" for t, n in
                             (("fact_orders", 3), ("dim_customers", 3), ("dim_products", 3), ("dim_date", 2))],
        "TOP 5 REVENUE MONTHS": [
            f"  2024-01 ({'January':>9s}): {2:>4} orders, ${149.95:>12,.2f}",
            f"  2024-02 ({'February':>9s}): {1:>4} orders, ${49.99:>12,.2f}",
        ],
        "TOP 10 PRODUCTS BY REVENUE": [
            f"  {1:>2}. {'Widget A':<35s} ({'Electronics':<18s}) ${149.95:>10,.2f}",
            f"  {2:>2}. {'Unknown Product':<35s} ({'Clothing':<18s}) ${49.99:>10,.2f}",
        ],
        "TOP 5 CUSTOMERS BY LIFETIME VALUE": [
            f"  {'Alice Smith':<25s} ({'NYC, NY':<20s}) {2:>3} orders, ${149.95:>10,.2f} CLV",
            f"  {'Unknown':<25s} ({'LA, CA':<20s}) {1:>3} orders, ${49.99:>10,.2f} CLV",
        ],
        "REVENUE BY CATEGORY": [
            f"  {'Electronics':<20s}: {2:>4} orders, ${149.95:>12,.2f}",
            f"  {'Clothing':<20s}: {1:>4} orders, ${49.99:>12,.2f}",
        ],
        "ORDER STATUS BREAKDOWN": [
            f"  {'completed':<12s}: {2:>5} orders, ${149.95:>12,.2f}",
            f"  {'shipped':<12s}: {1:>5} orders, ${49.99:>12,.2f}",
        ],
    }


def test_display_formats(spark):
    df = spark.createDataFrame([(1234.5, 1234567, "abcdef", 7)], "x double, n bigint, s string, m int")
    got = df.select(
        D.dollars(F.col("x")), D.dollars(F.col("x"), 0), D.thousands(F.col("n")), D.pad_left(F.col("s"), 8),
        D.pad_right(F.col("s"), 8), D.pad_left(F.col("s"), 3), D.two_digits(F.col("m")),
    ).first()
    assert tuple(got) == ("$1,234.50", f"${1234.5:,.0f}", "1,234,567", "  abcdef", "abcdef  ", "abcdef", "07")


def test_sql_over_the_star(spark, star):
    register_views(star)
    got = spark.sql("""
        SELECT d.year, d.month, round(sum(f.revenue), 2) AS total
        FROM fact_orders f JOIN dim_date d ON f.date_id = d.date_id
        WHERE f.order_status <> 'cancelled' GROUP BY d.year, d.month ORDER BY 1, 2
    """)
    assert [tuple(r) for r in got.collect()] == [(2024, 1, 149.95), (2024, 2, 49.99)]
    mine = analytics.monthly_revenue(star).select("year", "month", "total_revenue")
    assert [tuple(r) for r in mine.collect()] == [tuple(r) for r in got.collect()]


def test_new_and_repeat_in_one_month(spark):
    days = [("1", "7", "100", "1", d, "completed") for d in ("2024-01-02", "2024-01-02", "2024-01-09", "2024-02-01")]
    orders = [(str(i), *r[1:]) for i, r in enumerate(days)] + [("9", "8", "100", "1", "2024-02-03", "cancelled")]
    raw = {"orders": H.orders(spark, orders), "customers": H.customers(spark), "products": H.products(spark)}
    from skeinmart.plans.pipeline import transform_all

    star = transform_all(raw, {k: ["seq"] for k in raw})
    assert [tuple(r) for r in analytics.new_vs_repeat(star).collect()] == [
        (2024, 1, "new", 1), (2024, 1, "repeat", 1), (2024, 2, "repeat", 1),
    ]


def test_dashboard_tables(star):
    tables = marts.dashboard(star)
    assert {n: df.count() for n, df in tables.items()} == {
        "monthly": 2, "top_products": 2, "category": 2, "clv": 2, "clv_histogram": 2, "status": 2, "kpi": 1,
    }
    assert tables["monthly"].first()["period"] == "2024-01"
    assert tuple(tables["kpi"].first()) == (199.94, 3, 199.94 / 3, 2)
    bins = tables["clv_histogram"].collect()
    assert [(r["bin"], r["customers"]) for r in bins] == [(1, 1), (30, 1)]
    held = marts.cached(marts.joined(star))
    assert held.is_cached and held.count() == 3
    held.unpersist()
