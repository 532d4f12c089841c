"""All plans over a star with hot keys, repeated rows and orphans, against DuckDB.

A third of the fact belongs to one customer, one product and one date. Fact and
dimension rows are repeated, as after a second append, and some keys have no
dimension row.
"""

import duckdb
import pytest

from compare import normalised
from skeinmart.operators.quality import keys_are_unique, validate_star
from skeinmart.operators.star import StarTables
from skeinmart.oracle import statements
from skeinmart.plans.catalogue import STAR_PLANS
from skeinmart.schemas import STAR_SCHEMAS

STAR_SQL = {
    "dim_date": """
        SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_id, d AS full_date, CAST(day(d) AS INTEGER) AS day,
               CAST(month(d) AS INTEGER) AS month, CAST(year(d) AS INTEGER) AS year,
               CAST(quarter(d) AS INTEGER) AS quarter, CAST(isodow(d) - 1 AS INTEGER) AS day_of_week,
               dayname(d) AS day_name, monthname(d) AS month_name, isodow(d) >= 6 AS is_weekend
        FROM (SELECT CAST(unnest(generate_series(DATE '2023-01-01', DATE '2024-03-01', INTERVAL 3 DAY)) AS DATE) AS d)
    """,
    "dim_customers": """
        SELECT CAST(i AS BIGINT) AS customer_id, 'Name ' || i % 50 AS name, 'u' || i || '@x.org' AS email,
               'L' || i % 7 AS location FROM range(200) t(i)
    """,
    "dim_products": """
        SELECT CAST(i AS BIGINT) AS product_id, 'P' || i % 30 AS product_name, 'C' || i % 4 AS category,
               CAST(round(i * 1.37 + 0.5, 2) AS DOUBLE) AS price, 'S' AS supplier FROM range(100) t(i)
    """,
    "fact_orders": """
        SELECT CAST(i AS BIGINT) AS order_id,
               CAST(CASE WHEN i % 3 = 0 THEN 5 ELSE (i * 7919) % 215 END AS BIGINT) AS customer_id,
               CAST(CASE WHEN i % 3 = 0 THEN 8 ELSE (i * 104729) % 108 END AS BIGINT) AS product_id,
               CAST(strftime(CASE WHEN i % 3 = 0 THEN DATE '2023-05-04' + CAST(3 * (i % 2) AS INTEGER)
                    ELSE DATE '2022-12-26' + CAST((i * 31) % 440 AS INTEGER) END, '%Y%m%d') AS INTEGER) AS date_id,
               CAST(i % 9 + 1 AS BIGINT) AS quantity, CAST((i % 97) * 1.01 AS DOUBLE) AS unit_price,
               CAST((i % 9 + 1) * ((i % 97) * 1.01) AS DOUBLE) AS revenue,
               ['completed', 'pending', 'shipped', 'cancelled', 'returned'][1 + (i * 13) % 5] AS order_status
        FROM range(9000) t(i)
    """,
}


@pytest.fixture(scope="module", params=["clean", "clean, known to be unique", "appended"])
def engines(spark, tmp_path_factory, request):
    folder = tmp_path_factory.mktemp("star")
    con = duckdb.connect()
    star = {}
    for name, sql in STAR_SQL.items():
        con.execute(f"CREATE TABLE {name} AS {sql}")
        if request.param == "appended":
            con.execute(f"INSERT INTO {name} SELECT * FROM {name} USING SAMPLE 30% (reservoir, 3)")
        con.execute(f"COPY {name} TO '{folder}/{name}.parquet'")
        star[name] = spark.read.schema(STAR_SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")
    assert keys_are_unique(validate_star(star)) == (request.param != "appended")
    return con, StarTables(star, unique_keys=request.param == "clean, known to be unique")


@pytest.mark.parametrize("name", [n for n in STAR_PLANS])
def test_plan_equals_sql(engines, name):
    con, star = engines
    df = STAR_PLANS[name](star)
    have = normalised(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(statements(given_star=True)[name])
    want = normalised([d[0] for d in cur.description], cur.fetchall())
    assert have == want
