"""SQL statements over a loaded warehouse that need no unique keys: here distinct and plain counts differ."""

MONTHLY = """
SELECT d.year, d.month, COUNT(DISTINCT f.order_id) AS orders, COUNT(*) AS joined_rows,
       CAST(SUM(CAST(f.revenue AS DECIMAL(18,2))) AS DOUBLE) AS revenue
FROM {fact_orders} AS f JOIN {dim_date} AS d ON f.date_id = d.date_id
GROUP BY d.year, d.month
"""

NEW_VS_REPEAT = """
WITH first_order AS (
    SELECT f.customer_id, MIN(f.date_id) AS first_id FROM {fact_orders} AS f
    WHERE f.order_status <> 'cancelled' GROUP BY f.customer_id),
flagged AS (
    SELECT f.customer_id, f.date_id, CASE WHEN f.date_id = o.first_id THEN 'new' ELSE 'repeat' END AS customer_type
    FROM {fact_orders} AS f JOIN first_order AS o ON f.customer_id = o.customer_id
    WHERE f.order_status <> 'cancelled')
SELECT d.year, d.month, g.customer_type, COUNT(DISTINCT g.customer_id) AS customers, COUNT(*) AS joined_rows
FROM flagged AS g JOIN {dim_date} AS d ON g.date_id = d.date_id
GROUP BY d.year, d.month, g.customer_type
"""

CATEGORY_SHARE = """
SELECT p.category, COUNT(DISTINCT f.order_id) AS orders, COUNT(f.order_id) AS joined_rows,
       CAST(SUM(CAST(f.revenue AS DECIMAL(18,2))) AS DOUBLE)
         / (SELECT CAST(SUM(CAST(w.revenue AS DECIMAL(18,2))) AS DOUBLE) FROM {fact_orders} AS w) AS share
FROM {fact_orders} AS f JOIN (SELECT DISTINCT product_id, category FROM {dim_products} AS q) AS p
  ON f.product_id = p.product_id
GROUP BY p.category
"""

STATEMENTS = {
    "sql_monthly_appended": MONTHLY,
    "sql_new_vs_repeat": NEW_VS_REPEAT,
    "sql_category_share": CATEGORY_SHARE,
}
