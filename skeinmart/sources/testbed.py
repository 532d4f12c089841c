"""The three raw tables derived from the order-management test tables.

The mapping makes the clean test tables dirty on purpose: null and unreadable
keys, orders of unknown customers and products (negative keys), repeated rows, padded
and mixed-case text, missing prices. The tables are read whole. The expressions
mean the same in Spark SQL and in DuckDB, so the text is also the first part of
every oracle query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SOURCE_TABLES = ("lineitem", "orders", "customer", "nation", "region", "part")

RAW_ORDERS_SQL = """
SELECT cast(l_orderkey * 8 + l_linenumber AS string) AS order_id,
       CASE WHEN l_suppkey % 50 = 7 THEN NULL
            WHEN o_custkey % 211 = 210 THEN cast(-o_custkey AS string)
            ELSE cast(o_custkey AS string) END AS customer_id,
       CASE WHEN l_partkey % 211 = 210 THEN cast(-l_partkey AS string)
            ELSE cast(l_partkey AS string) END AS product_id,
       CASE WHEN l_partkey % 50 = 3 THEN NULL
            WHEN l_partkey % 199 = 0 THEN 'abc'
            ELSE cast(l_quantity AS string) END AS quantity,
       CASE WHEN l_orderkey % 101 = 0 THEN 'not-a-date'
            ELSE cast(cast(o_orderdate AS date) AS string) END AS order_date,
       CASE concat(l_returnflag, l_linestatus)
            WHEN 'AF' THEN NULL
            WHEN 'AO' THEN ' Completed '
            WHEN 'NF' THEN 'SHIPPED'
            WHEN 'NO' THEN 'pending'
            WHEN 'RF' THEN 'returned'
            WHEN 'RO' THEN 'Cancelled' END AS status,
       l_partkey AS s1, l_suppkey AS s2, l_extendedprice AS s3
FROM {lineitem} AS li JOIN {orders} AS od ON l_orderkey = o_orderkey
"""

RAW_CUSTOMERS_SQL = """
WITH known AS (
    SELECT c_custkey, c_name, n_name, r_name
    FROM {customer} AS cu
    JOIN {nation} AS na ON c_nationkey = n_nationkey
    JOIN {region} AS re ON n_regionkey = r_regionkey
), contact AS (
    SELECT c_custkey, c_name,
           CASE WHEN c_custkey % 50 = 2 THEN NULL
                ELSE concat('User', cast(c_custkey AS string), '@Example.COM ') END AS email,
           CASE WHEN c_custkey % 97 = 0 THEN NULL ELSE concat(n_name, ', ', r_name) END AS location
    FROM known
)
SELECT cast(c_custkey AS string) AS customer_id,
       CASE WHEN c_custkey % 50 = 1 THEN NULL ELSE concat(' ', lower(c_name), ' ') END AS name,
       email, location, c_custkey * 2 AS seq
FROM contact
UNION ALL
SELECT cast(c_custkey AS string), concat('duplicate ', cast(c_custkey AS string)),
       email, location, c_custkey * 2 + 1
FROM contact WHERE c_custkey % 100 = 0
"""

RAW_PRODUCTS_SQL = """
WITH offered AS (
    SELECT cast(p_partkey AS string) AS product_id,
           CASE WHEN p_partkey % 50 = 4 THEN NULL ELSE concat(' ', p_name) END AS product_name,
           CASE WHEN p_partkey % 97 = 5 THEN NULL ELSE concat(lower(p_type), ' goods') END AS category,
           CASE WHEN p_partkey % 50 = 6 THEN NULL
                WHEN p_partkey % 151 = 1 THEN 'n/k'
                ELSE cast(cast(cast(round(p_retailprice * 100) AS bigint) + p_partkey % 100 AS double) / 100
                          AS string) END AS price,
           CASE WHEN p_partkey % 83 = 0 THEN NULL
                ELSE concat('Supplier ', cast(p_partkey % 10 AS string)) END AS supplier,
           p_partkey
    FROM {part} AS pa
)
SELECT product_id, product_name, category, price, supplier, p_partkey * 2 AS seq FROM offered
UNION ALL
SELECT product_id, product_name, category, price, supplier, p_partkey * 2 + 1 FROM offered
WHERE p_partkey % 100 = 0
"""

RAW_SQL = {"orders": RAW_ORDERS_SQL, "customers": RAW_CUSTOMERS_SQL, "products": RAW_PRODUCTS_SQL}
ORDER_BY = {"orders": ["s1", "s2", "s3"], "customers": ["seq"], "products": ["seq"]}


def source(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """``orders``, ``customers`` and ``products`` as dirty text tables."""
    tables = {name: source(spark, sf_dir, name) for name in SOURCE_TABLES}
    # The shuffle of the join, made explicit: a single file is one task otherwise.
    tables["lineitem"] = tables["lineitem"].repartition("l_orderkey")
    out = {}
    for name, text in RAW_SQL.items():
        used = {t: df for t, df in tables.items() if "{" + t + "}" in text}
        out[name] = spark.sql(text, **used)
    return out
