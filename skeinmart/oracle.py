"""DuckDB statements for the same results, written apart from the Spark plans.

Each statement starts from the source tables: the raw mapping, then the cleaning
and the star as common table expressions, then the query. Money is summed as
DECIMAL; see ``half_up`` for SQL rounding and ``round_even`` for dataframe rounding.
"""

from __future__ import annotations

from .plans.appended import STATEMENTS
from .schemas import CATEGORIES, DEFAULT_CATEGORY, ORDER_STATUSES
from .sources.testbed import RAW_SQL, SOURCE_TABLES


def half_up(x: str, digits: int = 2) -> str:
    return f"CAST(round(CAST({x} AS DECIMAL(28,10)), {digits}) AS DOUBLE)"


def total(c: str) -> str:
    return f"CAST(sum(CAST({c} AS DECIMAL(18,2))) AS DOUBLE)"


def whole(c: str) -> str:
    """Text as an integer, cut toward zero."""
    return f"CAST(trunc(try_cast({c} AS DOUBLE)) AS BIGINT)"


def title(c: str) -> str:
    runs = r"[\p{Lu}\p{Ll}\p{Lt}]+|[^\p{Lu}\p{Ll}\p{Lt}]+"
    return (
        f"array_to_string(list_transform(regexp_extract_all(lower({c}), '{runs}'), "
        "lambda t: upper(t[1]) || t[2:]), '')"
    )


def bare(c: str, default: str) -> str:
    return f"regexp_replace(coalesce({c}, '{default}'), '^\\s+|\\s+$', '', 'g')"


_RAW = ",\n".join(
    f"raw_{name} AS ({text.format(**{t: t for t in SOURCE_TABLES})})" for name, text in RAW_SQL.items()
)

_CLEAN = f"""
typed_orders AS (
    SELECT {whole('order_id')} AS order_id, {whole('customer_id')} AS customer_id,
           {whole('product_id')} AS product_id, {whole('quantity')} AS quantity,
           CAST(try_strptime(order_date, '%Y-%m-%d') AS DATE) AS order_date,
           lower({bare('status', 'completed')}) AS status, s1, s2, s3
    FROM raw_orders),
valid_orders AS (
    SELECT * FROM typed_orders
    WHERE order_id IS NOT NULL AND customer_id IS NOT NULL AND product_id IS NOT NULL
      AND quantity IS NOT NULL AND order_date IS NOT NULL),
clean_orders AS (
    SELECT order_id, customer_id, product_id, quantity, order_date, status FROM valid_orders
    QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY s1, s2, s3) = 1),
clean_customers AS (
    SELECT {whole('customer_id')} AS customer_id, {title(bare('name', 'Unknown'))} AS name,
           lower({bare('email', 'unknown@example.com')}) AS email, {bare('location', 'Unknown')} AS location,
           CAST(NULL AS DATE) AS signup_date
    FROM raw_customers WHERE {whole('customer_id')} IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY {whole('customer_id')} ORDER BY seq) = 1),
typed_products AS (
    SELECT {whole('product_id')} AS product_id, product_name, category, try_cast(price AS DOUBLE) AS price,
           supplier, seq
    FROM raw_products WHERE {whole('product_id')} IS NOT NULL),
medians AS (
    SELECT category, median(price) AS median FROM typed_products
    WHERE category IS NOT NULL AND price IS NOT NULL GROUP BY category),
group_filled AS (
    SELECT t.*, m.median, CASE WHEN t.category IS NULL THEN NULL ELSE coalesce(t.price, m.median) END AS step_price
    FROM typed_products t LEFT JOIN medians m ON t.category = m.category),
filled_products AS (
    SELECT product_id, product_name, category, supplier, seq,
           round_even(coalesce(step_price, (SELECT median(step_price) FROM group_filled)), 2) AS price
    FROM group_filled),
clean_products AS (
    SELECT product_id, {bare('product_name', 'Unknown Product')} AS product_name,
           {title(bare('category', 'General'))} AS category, price, {bare('supplier', 'Unknown')} AS supplier
    FROM filled_products
    QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY seq) = 1)
"""

_STAR = """
dim_date AS (
    SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_id, d AS full_date,
           CAST(day(d) AS INTEGER) AS day, CAST(month(d) AS INTEGER) AS month, CAST(year(d) AS INTEGER) AS year,
           CAST(quarter(d) AS INTEGER) AS quarter, CAST(isodow(d) - 1 AS INTEGER) AS day_of_week,
           dayname(d) AS day_name, monthname(d) AS month_name, isodow(d) >= 6 AS is_weekend
    FROM (SELECT DISTINCT order_date AS d FROM clean_orders)),
dim_customers AS (SELECT customer_id, name, email, location FROM clean_customers),
dim_products AS (SELECT product_id, product_name, category, price, supplier FROM clean_products),
fact_orders AS (
    SELECT order_id, customer_id, o.product_id, CAST(strftime(order_date, '%Y%m%d') AS INTEGER) AS date_id,
           quantity, coalesce(price, 0.0) AS unit_price,
           round_even(quantity * coalesce(price, 0.0), 2) AS revenue, status AS order_status
    FROM clean_orders o LEFT JOIN clean_products p ON o.product_id = p.product_id)
"""

_VIEWS = """
live AS (SELECT * FROM fact_orders WHERE order_status <> 'cancelled'),
mart AS (
    SELECT f.*, dd.month, dd.year, dd.month_name, dp.product_name, dp.category, dp.price
    FROM fact_orders f JOIN dim_date dd USING (date_id) JOIN dim_products dp USING (product_id)),
live_mart AS (SELECT * FROM mart WHERE order_status <> 'cancelled')
"""


def _raw(query: str) -> str:
    return f"WITH {_RAW}\n{query}"


def _cleaned(query: str) -> str:
    return f"WITH {_RAW},{_CLEAN}\n{query}"


def _union(parts: list[str]) -> str:
    return "\nUNION ALL ".join(parts)


# --- quality fragments ----------------------------------------------------------

_PK = {
    "dim_date": "date_id", "dim_customers": "customer_id", "dim_products": "product_id", "fact_orders": "order_id",
}
_RAW_PK = {"orders": "order_id", "customers": "customer_id", "products": "product_id"}
_MIN = {"fact_orders": 100, "dim_customers": 10, "dim_products": 5, "dim_date": 10}
_FK = {"customer_id": "dim_customers", "product_id": "dim_products", "date_id": "dim_date"}


def _zero(check: str, table: str, source: str, bad: str, ok: str) -> str:
    return (
        f"SELECT '{check}' AS \"check\", '{table}' AS \"table\", n = 0 AS passed, "
        f"CASE WHEN n = 0 THEN '{ok}' ELSE concat(CAST(n AS VARCHAR), '{bad}') END AS details FROM ({source})"
    )


def _nulls(table: str, pk: str, source: str | None = None) -> str:
    return _zero(f"null_pk({pk})", table, f"SELECT count(*) AS n FROM {source or table} WHERE {pk} IS NULL",
                 " nulls found", "No nulls")


def _repeats(table: str, pk: str, source: str | None = None, key: str | None = None) -> str:
    inner = f"SELECT count(*) - 1 AS extra FROM {source or table} GROUP BY {key or pk}"
    return _zero(f"duplicate_pk({pk})", table, f"SELECT CAST(sum(extra) AS BIGINT) AS n FROM ({inner})",
                 " duplicates found", "No duplicates")


def _orphans(fk: str, dim: str) -> str:
    inner = f"SELECT DISTINCT {fk} FROM fact_orders WHERE {fk} NOT IN (SELECT {fk} FROM {dim})"
    return _zero(f"ref_integrity({fk})", f"fact_orders->{dim}", f"SELECT count(*) AS n FROM ({inner})",
                 " orphan keys", "All FKs valid")


def _enough(table: str) -> str:
    n = _MIN[table]
    return (
        f"SELECT 'row_count' AS \"check\", '{table}' AS \"table\", count(*) >= {n} AS passed, "
        f"concat(CAST(count(*) AS VARCHAR), ' rows (min: {n})') AS details FROM {table}"
    )


_REVENUE = _zero("revenue_positive", "fact_orders", "SELECT count(*) AS n FROM fact_orders WHERE revenue < 0",
                 " negative values", "All positive")
_SUITE = _union(
    [_nulls(t, pk) for t, pk in _PK.items()]
    + [_repeats(t, pk) for t, pk in _PK.items()]
    + [_orphans(fk, dim) for fk, dim in _FK.items()]
    + [_enough(t) for t in _MIN]
    + [_REVENUE]
)


def _broken(check: str, table: str, condition: str) -> str:
    return _zero(check, table, f"SELECT count(*) AS n FROM {table} WHERE {condition}", " unexpected values", "")


def _list(values: list[str]) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def _unique(table: str, c: str) -> str:
    return _zero(f"unique_{c}", table, f"SELECT count({c}) - count(DISTINCT {c}) AS n FROM {table}",
                 " unexpected values", "")


_EXPECT = {
    "regex": [_broken("regex_email", "dim_customers",
                      r"NOT regexp_matches(email, '^[^@\s]+@[^@\s]+\.[^@\s]+$')")],
    "range": [
        _broken("range_price", "dim_products", "price < 0"),
        _broken("range_month", "dim_date", "month < 1 OR month > 12"),
        _broken("range_quarter", "dim_date", "quarter < 1 OR quarter > 4"),
        _broken("range_revenue", "fact_orders", "revenue < 0"),
    ],
    "set": [
        _broken("set_category", "dim_products", f"category NOT IN ({_list([*CATEGORIES, DEFAULT_CATEGORY])})"),
        _broken("set_order_status", "fact_orders", f"order_status NOT IN ({_list(ORDER_STATUSES)})"),
    ],
    "not_null": [
        _broken(f"not_null_{c}", t, f"{c} IS NULL")
        for t, c in [("dim_customers", "customer_id"), ("dim_customers", "email"), ("dim_products", "product_id"),
                     ("dim_date", "date_id"), ("fact_orders", "order_id"), ("fact_orders", "customer_id"),
                     ("fact_orders", "product_id")]
    ],
    "unique": [_unique(t, c) for t, c in _PK.items()],
}
_ALL_EXPECT = _union([p for parts in _EXPECT.values() for p in parts])


def _counts(tables: list[tuple[str, str]], name: str = "row_count") -> str:
    return _union([f"SELECT '{label}' AS table_name, count(*) AS {name} FROM {t}" for label, t in tables])


_RAW_COUNTS = _counts([(n, f"raw_{n}") for n in RAW_SQL])
def _share(source: str, name: str, key: str, limit: int) -> str:
    """Rows of the percent limits of a key: nulls, and rows beyond the first of each key."""
    n = f"(SELECT count(*) AS n, count(*) - count({key}) AS nulls, count({key}) - count(DISTINCT {key}) + " \
        f"greatest(count(*) - count({key}) - 1, 0) AS extra FROM {source})"
    return _union([
        f"""SELECT '{kind}_pct({key}) <= {limit}' AS "check", '{name}' AS "table", {c} * 100.0 <= {limit} * n AS passed, """
        f"concat(CAST({c} AS VARCHAR), ' of ', CAST(n AS VARCHAR), ' rows') AS details FROM {n}"
        for kind, c in (("null", "nulls"), ("duplicate", "extra"))
    ])


_STAR_COUNTS = _counts([(t, t) for t in _PK])


def _hit(source: str, rid: str, draw: str, seed: str = "42") -> str:
    """Row ids of the smallest digests of a draw."""
    digest = f"md5(concat('{seed}', '|', '{draw}', '|', rid))"
    return (
        f"SELECT rid FROM (SELECT {rid} AS rid FROM {source}) "
        f"QUALIFY row_number() OVER (ORDER BY {digest}, rid) <= (SELECT floor(count(*) * RATE) FROM {source})"
    )


_ORDER_RID = (
    "concat_ws('-', order_id, CAST(s1 AS VARCHAR), CAST(s2 AS VARCHAR), CAST(CAST(round(s3 * 100) AS BIGINT) AS VARCHAR))"
)


def _nulled(columns: list[str], rid: str, source: str, rate: str) -> str:
    return ", ".join(
        f"CASE WHEN {rid} IN ({_hit(source, rid, c).replace('RATE', rate)}) THEN NULL ELSE {c} END AS {c}"
        for c in columns
    )


def _damaged_customers() -> str:
    rid = "CAST(seq AS VARCHAR)"
    return f"SELECT customer_id, {_nulled(['name', 'email'], rid, 'raw_customers', '0.02')}, location, seq FROM raw_customers"


def _kpis(source: str) -> str:
    return (
        f"SELECT coalesce({total('revenue')}, 0.0) AS total_revenue, count(DISTINCT order_id) AS total_orders, "
        f"coalesce({total('revenue')} / nullif(count(DISTINCT order_id), 0), 0.0) AS aov, "
        f"count(DISTINCT customer_id) AS total_customers FROM {source}"
    )


_MONTHS = f"""SELECT year, month, month_name, count(DISTINCT order_id) AS orders, CAST(sum(quantity) AS BIGINT) AS units,
       {total('revenue')} AS rev, count(revenue) AS n
FROM live JOIN dim_date USING (date_id) GROUP BY ALL"""

_HISTOGRAM = f"""
SELECT CAST(least(coalesce(floor((v - lo) * 30.0 / nullif(hi - lo, 0.0)), 0) + 1, 30) AS INTEGER) AS bin, lo, hi
FROM (SELECT CAST(round(value * 100) AS BIGINT)::DOUBLE AS v FROM
        (SELECT {total('revenue')} AS value FROM live_mart GROUP BY customer_id)),
     (SELECT min(c) AS lo, max(c) AS hi FROM (SELECT CAST(round({total('revenue')} * 100) AS BIGINT)::DOUBLE AS c
        FROM live_mart GROUP BY customer_id))"""


_SHARE = f"100.0::DOUBLE * {total('revenue')} / (SELECT {total('revenue')} FROM live)"


def statements(given_star: bool = False) -> dict[str, str]:
    """Statement per query. With ``given_star`` the star tables exist already and are not derived."""

    def _star(query: str) -> str:
        before = "" if given_star else f"{_RAW},{_CLEAN},{_STAR},"
        return f"WITH {before}{_VIEWS}\n{query}"

    return {
        "extract_row_counts": _raw(
            f"SELECT * FROM ({_RAW_COUNTS}) UNION ALL SELECT 'total', CAST(sum(row_count) AS BIGINT) FROM ({_RAW_COUNTS})"
        ),
        "extract_csv_orders": _cleaned("SELECT * FROM clean_orders"),
        "extract_csv_customers": _cleaned(
            "SELECT customer_id, name, email, location, CASE WHEN customer_id % 2 = 0 THEN DATE '2020-01-15' END "
            "AS signup_date FROM clean_customers"
        ),
        "extract_csv_products": _cleaned(
            "SELECT product_id, product_name, category, price, CASE WHEN product_id % 2 = 0 THEN supplier ELSE 'Unknown' END "
            "AS supplier FROM clean_products"
        ),
        "upload_append": _raw(
            "SELECT CASE WHEN CAST(product_id AS BIGINT) % 2 = 0 THEN supplier END AS supplier, count(*) AS rows, "
            "count(DISTINCT product_id) AS products FROM raw_products GROUP BY ALL"
        ),
        "null_tokens": _raw(
            "SELECT product_id, seq, CASE WHEN CAST(product_id AS BIGINT) % 7 < 2 THEN NULL ELSE product_name END "
            "AS product_name, CASE WHEN CAST(product_id AS BIGINT) % 5 < 2 THEN NULL ELSE supplier END AS supplier "
            "FROM raw_products"
        ),
        "clean_orders": _cleaned("SELECT * FROM clean_orders"),
        "clean_orders_datetimes": _cleaned("SELECT * FROM clean_orders"),
        "clean_customers": _cleaned("SELECT * FROM clean_customers"),
        "clean_products": _cleaned("SELECT * FROM clean_products"),
        "clean_rows_removed": _cleaned(_union([
            f"SELECT '{n}' AS table_name, a AS rows_in, b AS rows_kept, a - b AS rows_removed FROM "
            f"(SELECT (SELECT count(*) FROM raw_{n}) AS a, (SELECT count(*) FROM clean_{n}) AS b)"
            for n in RAW_SQL
        ])),
        "dedupe_keep_first": _raw(
            "SELECT * FROM raw_orders QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY s1, s2, s3) = 1"
        ),
        "price_median_by_category": _cleaned("SELECT * FROM medians"),
        "price_fill_null_category": _cleaned(
            "SELECT product_id, seq, category, price, 'lost' AS own_price FROM filled_products UNION ALL "
            "SELECT product_id, seq, category, "
            "round_even(coalesce(price, median, (SELECT median(coalesce(price, median)) FROM group_filled)), 2), 'kept' "
            "FROM group_filled"
        ),
        "dim_date": _star("SELECT * FROM dim_date"),
        "dim_customers": _star("SELECT * FROM dim_customers"),
        "dim_products": _star("SELECT * FROM dim_products"),
        "fact_orders": _star("SELECT * FROM fact_orders"),
        "q01_monthly_revenue": _star(
            f"SELECT year, month, month_name, orders AS total_orders, units AS total_units_sold, "
            f"{half_up('rev')} AS total_revenue, {half_up('rev / n')} AS avg_order_revenue FROM ({_MONTHS})"
        ),
        "q02_top_products": _star(
            f"SELECT product_id, product_name, category, count(order_id) AS times_ordered, "
            f"CAST(sum(quantity) AS BIGINT) AS total_units_sold, {half_up(total('revenue'))} AS total_revenue, "
            f"{half_up(total('unit_price') + ' / count(unit_price)')} AS avg_unit_price "
            "FROM live JOIN dim_products USING (product_id) GROUP BY ALL ORDER BY total_revenue DESC, product_id LIMIT 10"
        ),
        "q03_customer_lifetime_value": _star(
            f"SELECT customer_id, name, location, count(DISTINCT order_id) AS total_orders, "
            f"{half_up(total('revenue'))} AS lifetime_value, {half_up(total('revenue') + ' / count(revenue)')} "
            "AS avg_order_value, min(full_date) AS first_order_date, max(full_date) AS last_order_date "
            "FROM live JOIN dim_customers USING (customer_id) JOIN dim_date USING (date_id) GROUP BY ALL "
            "ORDER BY lifetime_value DESC, customer_id LIMIT 20"
        ),
        "q04_new_vs_repeat": _star(
            "SELECT year, month, CASE WHEN date_id = first_id THEN 'new' ELSE 'repeat' END AS customer_type, "
            "count(DISTINCT customer_id) AS customer_count FROM live JOIN dim_date USING (date_id) "
            "JOIN (SELECT customer_id, min(date_id) AS first_id FROM live GROUP BY customer_id) USING (customer_id) "
            "GROUP BY ALL"
        ),
        "q05_revenue_by_category": _star(
            f"SELECT category, count(DISTINCT order_id) AS total_orders, CAST(sum(quantity) AS BIGINT) AS total_units, "
            f"{half_up(total('revenue'))} AS total_revenue, {half_up(total('revenue') + ' / count(revenue)')} "
            f"AS avg_order_revenue, {half_up(_SHARE, 1)} "
            "AS revenue_pct FROM live JOIN dim_products USING (product_id) GROUP BY category"
        ),
        "q06_order_value_trend": _star(
            f"SELECT year, month, month_name, orders AS total_orders, {half_up('rev')} AS total_revenue, "
            f"{half_up('rev / orders')} AS aov FROM ({_MONTHS})"
        ),
        "q07_status_breakdown": _star(
            f"SELECT order_status, count(*) AS order_count, {half_up(total('revenue'))} AS total_revenue, "
            f"{half_up('100.0::DOUBLE * count(*) / (SELECT count(*) FROM fact_orders)', 1)} AS pct_of_orders "
            "FROM fact_orders GROUP BY order_status"
        ),
        "q08_day_of_week": _star(
            f"SELECT day_name, day_of_week, count(DISTINCT order_id) AS total_orders, "
            f"{half_up(total('revenue'))} AS total_revenue, {half_up(total('revenue') + ' / count(revenue)')} "
            "AS avg_revenue FROM live JOIN dim_date USING (date_id) GROUP BY day_name, day_of_week"
        ),
        "q09_top_months": _star(
            f"SELECT year, month, month_name, orders, {half_up('rev')} AS revenue FROM ({_MONTHS}) "
            "ORDER BY revenue DESC, year, month LIMIT 5"
        ),
        "q10_top_products_ranked": _star(
            "SELECT CAST(row_number() OVER (ORDER BY rev DESC, product_id) AS INTEGER) AS rank, product_name, category, rev "
            f"FROM (SELECT product_id, product_name, category, {half_up(total('revenue'))} AS rev "
            "FROM live JOIN dim_products USING (product_id) GROUP BY ALL) ORDER BY rank LIMIT 10"
        ),
        "q11_top_customers": _star(
            "SELECT name, location, orders, clv FROM (SELECT customer_id, name, location, "
            f"count(DISTINCT order_id) AS orders, {half_up(total('revenue'))} AS clv "
            "FROM live JOIN dim_customers USING (customer_id) GROUP BY ALL) ORDER BY clv DESC, customer_id LIMIT 5"
        ),
        "q12_category_revenue": _star(
            f"SELECT category, count(DISTINCT order_id) AS orders, {half_up(total('revenue'))} AS revenue "
            "FROM live JOIN dim_products USING (product_id) GROUP BY category"
        ),
        "q13_status_counts": _star(
            f"SELECT order_status, count(*) AS cnt, {half_up(total('revenue'))} AS rev FROM fact_orders GROUP BY order_status"
        ),
        "q14_table_counts": _star(_STAR_COUNTS),
        "mart_joined": _star("SELECT * FROM mart"),
        "mart_monthly": _star(
            f"SELECT year, month, month_name, {total('revenue')} AS revenue, count(DISTINCT order_id) AS orders, "
            "printf('%d-%02d', year, month) AS period FROM live_mart GROUP BY year, month, month_name"
        ),
        "mart_top_names": _star(
            f"SELECT product_name, category, {total('revenue')} AS revenue FROM live_mart GROUP BY ALL "
            "ORDER BY revenue DESC, product_name, category LIMIT 10"
        ),
        "mart_category": _star(f"SELECT category, {total('revenue')} AS revenue FROM live_mart GROUP BY category"),
        "mart_clv": _star(f"SELECT customer_id, {total('revenue')} AS lifetime_value FROM live_mart GROUP BY customer_id"),
        "mart_clv_histogram": _star(
            "SELECT bin, (lo + (hi - lo) / 30 * (bin - 1)) / 100 AS bin_start, (lo + (hi - lo) / 30 * bin) / 100 AS bin_end, "
            f"count(*) AS customers FROM ({_HISTOGRAM}) GROUP BY bin, lo, hi"
        ),
        "mart_status": _star("SELECT order_status, count(order_id) AS count FROM mart GROUP BY order_status"),
        "mart_product_perf": _star(
            f"SELECT product_name, {total('revenue')} AS revenue, {total('price')} / count(price) AS price, "
            "CAST(sum(quantity) AS BIGINT) AS quantity FROM live_mart GROUP BY product_name"
        ),
        "mart_clv_top15": _star(
            f"SELECT customer_id, revenue, name FROM (SELECT customer_id, {total('revenue')} AS revenue FROM live_mart "
            "GROUP BY customer_id) JOIN dim_customers USING (customer_id) ORDER BY revenue DESC, customer_id LIMIT 15"
        ),
        "kpi_active": _star(_kpis("live_mart")),
        "kpi_all": _star(_kpis("fact_orders")),
        "kpi_cards": _star(
            "SELECT format('${:,.0f}', total_revenue) AS total_revenue, format('{:,}', total_orders) AS total_orders, "
            "format('${:,.2f}', aov) AS aov, format('{:,}', total_customers) AS total_customers "
            f"FROM ({_kpis('fact_orders')})"
        ),
        "check_null_pks": _star(_union(
            [_nulls(t, pk) for t, pk in _PK.items()] + [_nulls("raw_orders", "customer_id")]
        )),
        "check_duplicate_pks": _star(_union(
            [_repeats(t, pk) for t, pk in _PK.items()]
            + [_repeats(f"raw_{t}", pk, key=whole(pk)) for t, pk in _RAW_PK.items()]
        )),
        "check_ref_integrity": _star(_union([_orphans(fk, dim) for fk, dim in _FK.items()])),
        "check_row_counts": _star(_union([_enough(t) for t in _MIN])),
        "check_revenue_positive": _star(_REVENUE),
        "quality_report": _star(_SUITE),
        "quality_score": _star(
            f"SELECT CAST(floor(count(*) FILTER (WHERE passed) / CAST(count(*) AS DOUBLE) * 100) AS INTEGER) AS score FROM ({_SUITE})"
        ),
        "quality_tally": _star(
            "SELECT count(*) FILTER (WHERE passed) AS passed, count(*) FILTER (WHERE NOT passed) AS failed "
            f"FROM ({_SUITE})"
        ),
        **{f"check_{kind}": _star(_union(parts)) for kind, parts in _EXPECT.items()},
        "quality_stats_by_table": _star(
            'SELECT "table", count(*) AS evaluated_expectations, count(*) FILTER (WHERE passed) AS successful_expectations, '
            "count(*) FILTER (WHERE NOT passed) AS unsuccessful_expectations, "
            "100.0::DOUBLE * count(*) FILTER (WHERE passed) / count(*) AS success_percent "
            f'FROM ({_ALL_EXPECT}) GROUP BY "table"'
        ),
        "check_row_tolerance": _star(
            "SELECT 'row_tolerance' AS \"check\", 'fact_orders' AS \"table\", abs(a - b) <= 0.05 * a AS passed, "
            "concat(CAST(a AS VARCHAR), ' source rows, ', CAST(b AS VARCHAR), ' target rows') AS details FROM "
            "(SELECT (SELECT count(*) FROM raw_orders) AS a, (SELECT count(*) FROM fact_orders) AS b)"
        ),
        "schema_check": (
            "SELECT 'schema' AS \"check\", t AS \"table\", ok AS passed, d AS details FROM (VALUES "
            + ", ".join(f"('{t}', true, 'Types as declared')" for t in _PK)
            + ", ('dim_products', false, 'differing columns: price, product_id, seq')) AS v(t, ok, d)"
        ),
        "gate_outcomes": _star(
            "SELECT mode, CASE mode WHEN 'off' THEN 0 WHEN 'warn' THEN n WHEN 'fail' THEN CASE WHEN n = 0 THEN 0 END END AS reported, "
            f"mode = 'fail' AND n > 0 AS stopped, n AS failed_checks FROM (SELECT count(*) FILTER (WHERE NOT passed) AS n FROM ({_SUITE})), "
            "(VALUES ('off'), ('warn'), ('fail')) AS m(mode)"
        ),
        "inject_nulls": _raw(
            f"SELECT order_id, product_id, order_date, s1, s2, s3, "
            f"{_nulled(['customer_id', 'quantity', 'status'], _ORDER_RID, 'raw_orders', '0.02')} FROM raw_orders"
        ),
        "inject_duplicates": _raw(
            f"SELECT * FROM ({_damaged_customers()}) UNION ALL SELECT customer_id, name, email, location, "
            "seq + (SELECT max(seq) FROM raw_customers) + 1 "
            f"FROM ({_damaged_customers()}) WHERE CAST(seq AS VARCHAR) IN "
            f"({_hit('raw_customers', 'CAST(seq AS VARCHAR)', 'rows').replace('RATE', '0.01')})"
        ),
        "column_mapping": "SELECT c_custkey AS customer_id, c_name AS name, c_mktsegment AS email, c_nationkey AS location FROM customer",
        "load_verify_full": _star(
            f"SELECT table_name, row_count AS loaded_rows, row_count AS expected_rows, true AS matches FROM ({_STAR_COUNTS})"
        ),
        "load_verify_incremental": _star(
            f"SELECT table_name, 2 * row_count AS loaded_rows, row_count AS expected_rows, false AS matches FROM ({_STAR_COUNTS})"
        ),
        **{
            name: _star(f"SELECT * FROM ({text.format(**{t: f'(SELECT * FROM {t} UNION ALL SELECT * FROM {t})' for t in _PK})})")
            for name, text in STATEMENTS.items()
        },
        "load_retry": _star(f"SELECT table_name, 2 * row_count AS row_count, 2::BIGINT AS batches FROM ({_STAR_COUNTS})"),
        "load_digest": _star(f"SELECT table_name, row_count, true AS same_content, false AS same_without_a_row FROM ({_STAR_COUNTS})"),
        "load_constraints": _star(
            "SELECT table_name, constraint_name, broken_rows, false AS published FROM (" + _union([
                "SELECT 'dim_customers' AS table_name, 'unique: customer_id' AS constraint_name, count(*) AS broken_rows FROM dim_customers WHERE customer_id % 100 = 7",
                "SELECT 'dim_products', 'not null: product_name', count(*) FROM dim_products WHERE product_id % 100 = 3",
                "SELECT 'fact_orders', 'foreign: date_id in dim_date', count(*) FROM fact_orders WHERE date_id % 100 = 15",
                *(
                    f"SELECT 'fact_orders', 'foreign: {k} in {dim}', count(*) FROM fact_orders WHERE {k} NOT IN (SELECT {k} FROM {dim})"
                    for k, dim in _FK.items() if k != "date_id"
                ),
            ]) + ") WHERE broken_rows > 0"
        ),
        "load_skip_known": _star(
            "SELECT table_name, row_count, CASE table_name WHEN 'fact_orders' THEN even ELSE row_count END AS first_rows, "
            "CASE table_name WHEN 'fact_orders' THEN row_count - even ELSE 0 END AS added_rows "
            f"FROM ({_STAR_COUNTS}), (SELECT count(*) FILTER (WHERE order_id % 2 = 0) AS even FROM fact_orders)"
        ),
        "clean_orders_first_format": _cleaned(
            "SELECT order_id, customer_id, product_id, quantity, order_date, status FROM valid_orders WHERE order_id % 7 <> 0 "
            "QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY 31 - day(order_date), s1, s2, s3) = 1"
        ),
        "extract_damaged": _raw(
            "SELECT CAST(order_id AS BIGINT) % 11 = 0 OR CAST(order_id AS BIGINT) % 13 = 0 AS damaged, count(*) AS row_count, "
            "CAST(sum(CAST(order_id AS BIGINT)) AS BIGINT) AS id_sum FROM raw_orders GROUP BY damaged"
        ),
        "extract_missing": _raw(
            "SELECT table_name, CASE table_name WHEN 'orders' THEN n ELSE 0 END AS row_count "
            "FROM (VALUES ('orders'), ('customers'), ('products')) AS t(table_name), (SELECT count(*) AS n FROM raw_orders)"
        ),
        "named_tables": _star(
            f"SELECT table_name, true AS found, row_count FROM ({_STAR_COUNTS}) UNION ALL SELECT 'dim_stores', false, NULL"
        ),
        "log_lines": (
            "SELECT CAST(dense_rank() OVER (ORDER BY strftime(ts, '%Y-%m-%d') DESC) AS INTEGER) AS file_no, strftime(ts, '%Y-%m-%d') AS day, "
            "row_number() OVER (PARTITION BY strftime(ts, '%Y-%m-%d') ORDER BY event_id) AS line_no, "
            "concat('[', upper(event_type), '] event ', CAST(event_id AS VARCHAR)) AS value FROM events"
        ),
        "pipeline_resume": _star(
            "SELECT 2::INTEGER AS run, step, status, table_name, row_count FROM "
            f"(VALUES ('transform', 'SKIPPED'), ('load', 'PASS')) AS s(step, status), ({_STAR_COUNTS}) "
            "UNION ALL SELECT 2, step, status, NULL, NULL FROM (VALUES ('extract', 'PASS'), ('validate', 'SKIPPED')) AS s(step, status)"
        ),
        "distinct_rollup": _star(
            "SELECT 'month' AS level, year, quarter, month, count(DISTINCT customer_id) AS customers "
            "FROM fact_orders JOIN dim_date USING (date_id) GROUP BY year, quarter, month UNION ALL "
            "SELECT 'quarter', year, quarter, NULL, count(DISTINCT customer_id) FROM fact_orders JOIN dim_date USING (date_id) "
            "GROUP BY year, quarter UNION ALL "
            "SELECT 'year', year, NULL, NULL, count(DISTINCT customer_id) FROM fact_orders JOIN dim_date USING (date_id) GROUP BY year"
        ),
        "check_pct_limits": _star(_union([
            *(_share(t, t, pk, 0) for t, pk in _PK.items()),
            *(_share(f"raw_{t}", f"raw_{t}", "customer_id", limit) for limit in (0, 5) for t in ("orders", "customers")),
        ])),
        "load_connector": _star(
            f"SELECT table_name, 2 * row_count AS loaded_rows, row_count AS expected_rows, false AS matches FROM ({_STAR_COUNTS})"
        ),
        "clean_without_keys": _cleaned(_union([
            "SELECT 'customers' AS table_name, count(*) AS row_count FROM clean_customers",
            "SELECT 'products', count(*) FROM clean_products",
            "SELECT concat(t, '_without_key'), 0 FROM (VALUES ('customers'), ('products')) AS v(t)",
        ])),
        "fact_backfill": _star("SELECT * REPLACE (0::BIGINT AS customer_id, 'unknown' AS order_status) FROM fact_orders"),
        "preview_tables": _star(
            f"SELECT table_name, least(row_count, 100) AS row_count, least(row_count, 100) AS known_rows FROM ({_STAR_COUNTS})"
        ),
        "pipeline_gates": _star(
            "SELECT run_status, step, step_status, table_name, row_count FROM (VALUES ('FAILED', 'transform', 'PASS'), "
            "('SUCCESS', 'transform', 'PASS'), ('SUCCESS', 'load', 'PASS')) AS s(run_status, step, step_status), "
            f"({_STAR_COUNTS}) UNION ALL SELECT run_status, step, step_status, NULL, NULL FROM (VALUES ('FAILED', 'extract', 'PASS'), "
            "('FAILED', 'validate', 'FAIL'), ('SUCCESS', 'extract', 'PASS'), ('SUCCESS', 'validate', 'PASS')) AS s(run_status, step, step_status)"
        ),
        "pipeline_run": _star(
            "SELECT mode, step, table_name, CASE WHEN mode = 'incremental' AND step = 'load' THEN 2 ELSE 1 END * row_count "
            f"AS row_count FROM ({_STAR_COUNTS}), (VALUES ('full'), ('incremental')) AS m(mode), "
            "(VALUES ('transform'), ('load')) AS s(step)"
        ),
        "log_level_filter": (
            "SELECT concat('[', CASE event_type WHEN 'error' THEN 'ERROR' ELSE 'WARNING' END, '] event ', "
            "CAST(event_id AS VARCHAR), ' of user ', CAST(user_id AS VARCHAR)) AS value "
            "FROM events WHERE event_type IN ('error', 'purchase')"
        ),
        "run_manifest_steps": _star(
            "SELECT CAST(run AS VARCHAR) AS timestamp, 'SUCCESS' AS run_status, 'full' AS mode, step, "
            "'PASS' AS step_status, CASE step WHEN 'load' THEN 0.5::DOUBLE ELSE 0.25::DOUBLE END AS duration, "
            "table_name, CASE table_name WHEN 'cancelled' THEN gone ELSE n END AS row_count FROM "
            "(SELECT date_id // 10000 AS run, count(*) AS n, count(*) FILTER (WHERE order_status = 'cancelled') AS gone "
            "FROM fact_orders GROUP BY run), "
            "(VALUES ('transform', 'fact_orders'), ('load', 'fact_orders'), ('load', 'cancelled')) AS s(step, table_name)"
        ),
        "report_round_trip": _star(f"SELECT s.*, fmt FROM ({_SUITE}) AS s, (VALUES ('parquet'), ('csv')) AS f(fmt)"),
        "quality_report_flatten": _star(
            'SELECT "table", "check", passed AS success, details AS message, '
            'bool_and(passed) OVER (PARTITION BY "table") AS table_success, '
            '100.0::DOUBLE * count(*) FILTER (WHERE passed) OVER (PARTITION BY "table") '
            '/ count(*) OVER (PARTITION BY "table") AS success_percent '
            f"FROM ({_SUITE})"
        ),
    }
