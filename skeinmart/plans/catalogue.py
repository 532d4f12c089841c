"""Every operator as a named query over a folder of test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import ISO_FORMATS
from ..functions.text import null_tokens_to_null
from ..operators import clean, inject, mapping, quality, star
from ..operators.counts import row_counts, with_total
from ..operators.dedupe import keep_first
from ..schemas import RAW_COLUMNS
from ..session import fresh_dir, materialize, prepare
from ..sources import artifacts, files, testbed, warehouse
from . import analytics, marts, pipeline
from .appended import STATEMENTS
from .loads import QUERIES as LOADS
from .snapshot import raw_tables, star_tables

Query = Callable[[SparkSession, str], DataFrame]


# --- raw tables, cleaning, star -------------------------------------------------


def _clean_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean_orders(raw_tables(spark, sf_dir)["orders"], testbed.ORDER_BY["orders"])


def clean_orders_datetimes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the orders give their date with a time."""
    orders = raw_tables(spark, sf_dir)["orders"]
    timed = F.concat("order_date", F.lit(" 10:30:00"))
    even = F.col("order_id").cast("bigint") % 2 == 0
    orders = orders.withColumn("order_date", F.when(even, timed).otherwise(F.col("order_date")))
    return clean.clean_orders(orders, testbed.ORDER_BY["orders"], ISO_FORMATS)


def _clean_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean_customers(raw_tables(spark, sf_dir)["customers"], testbed.ORDER_BY["customers"])


def _clean_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean_products(raw_tables(spark, sf_dir)["products"], testbed.ORDER_BY["products"])


def _through_csv(spark: SparkSession, table: str, parts: list[DataFrame]) -> DataFrame:
    """A raw table written as CSV, one folder for each part in this order, and extracted again."""
    place = fresh_dir(spark, "csv")
    for i, part in enumerate(parts):
        warehouse.write_table(part, f"{place}/{table}/{i}", fmt="csv")
    return files.extract_raw(spark, place, table, files={table: f"{table}/*"})


def _is_even(key: str) -> Column:
    return F.col(key).cast("bigint") % 2 == 0


def extract_csv_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders from CSV files of two column orders, cleaned by the order of their lines."""
    orders = raw_tables(spark, sf_dir)["orders"]
    columns = RAW_COLUMNS["orders"]

    def lines(part: DataFrame) -> DataFrame:
        return part.repartitionByRange("order_id").sortWithinPartitions("order_id", *testbed.ORDER_BY["orders"])

    odd, even = lines(orders.where(~_is_even("order_id"))), lines(orders.where(_is_even("order_id")))
    return clean.clean_orders(_through_csv(spark, "orders", [odd.select(columns), even.select(columns[::-1])]))


def extract_csv_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers from CSV files with and without signup_date; repeated customers come in a later file."""
    customers = raw_tables(spark, sf_dir)["customers"]
    plain = ["customer_id", "name", "email", "location"]
    dated = customers.withColumn("signup_date", F.lit("2020-01-15"))
    first, later = F.col("seq") % 2 == 0, F.col("seq") % 2 == 1
    parts = [
        dated.where(first & _is_even("customer_id")).select("signup_date", *plain[::-1]),
        customers.where(first & ~_is_even("customer_id")).select(plain),
        customers.where(later).select(plain[::-1]),
    ]
    return clean.clean_customers(_through_csv(spark, "customers", parts))


def extract_csv_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products from CSV files with and without supplier; repeated products come in a later file."""
    products = raw_tables(spark, sf_dir)["products"]
    columns = RAW_COLUMNS["products"]
    first, later = F.col("seq") % 2 == 0, F.col("seq") % 2 == 1
    parts = [
        products.where(first & _is_even("product_id")).select(columns[::-1]),
        products.where(first & ~_is_even("product_id")).select(columns[:-1]),
        products.where(later).select(columns),
    ]
    return clean.clean_products(_through_csv(spark, "products", parts))


def upload_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A saved upload of products and one appended without suppliers, as rows and products per supplier."""
    products = raw_tables(spark, sf_dir)["products"]
    columns = RAW_COLUMNS["products"]
    place = fresh_dir(spark, "uploads")
    warehouse.save_upload(products.where(_is_even("product_id")).select(columns), f"{place}/products.csv")
    warehouse.save_upload(products.where(~_is_even("product_id")).select(columns[:-1][::-1]), f"{place}/products.csv", "append")
    raw = files.extract_products(spark, place)
    return raw.groupBy("supplier").agg(F.count("*").alias("rows"), F.countDistinct("product_id").alias("products"))


def extract_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_total(row_counts(raw_tables(spark, sf_dir)))


def null_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Markers planted in the raw products, read back as nulls."""
    products = raw_tables(spark, sf_dir)["products"]
    key = F.col("product_id").cast("bigint")
    marked = products.select(
        "product_id",
        "seq",
        F.when(key % 7 == 0, "N/A").when(key % 7 == 1, "").otherwise(F.col("product_name")).alias("product_name"),
        F.when(key % 5 == 0, "null").when(key % 5 == 1, "nan").otherwise(F.col("supplier")).alias("supplier"),
    )
    return null_tokens_to_null(marked)


def dedupe_keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = raw_tables(spark, sf_dir)["orders"]
    return keep_first(orders, ["order_id"], testbed.ORDER_BY["orders"])


def price_median_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The size of the counts is unknown here, so this is the bucketed selection."""
    return clean.category_medians(clean.price_counts(clean.typed_products(raw_tables(spark, sf_dir)["products"])))


def price_fill_null_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices after the fill and before the dedupe, for both treatments of rows without a category."""
    products = clean.typed_products(raw_tables(spark, sf_dir)["products"], {"seq": F.col("seq")})
    cols = ["product_id", "seq", "category", "price"]
    counts = materialize(clean.price_counts(products), "price-counts")
    lost = clean.fill_prices(products, counts=counts).select(*cols, F.lit("lost").alias("own_price"))
    kept = clean.fill_prices(products, True, counts).select(*cols, F.lit("kept").alias("own_price"))
    return lost.unionByName(kept)


def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As in the pipeline: from one column of the written fact."""
    return star.build_dim_date_from_fact(star_tables(spark, sf_dir)["fact_orders"])


def fact_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.build_fact_orders(_clean_orders(spark, sf_dir), _clean_products(spark, sf_dir))


# --- injection, mapping ---------------------------------------------------------


def _order_row_id() -> Column:
    return F.concat_ws(
        "-", "order_id", F.col("s1").cast("string"), F.col("s2").cast("string"),
        F.round(F.col("s3") * 100).cast("bigint").cast("string"),
    )


def inject_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = raw_tables(spark, sf_dir)["orders"]
    return inject.inject_nulls(orders, 0.02, ["customer_id", "quantity", "status"], _order_row_id())


def inject_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = raw_tables(spark, sf_dir)["customers"]
    row_id = F.col("seq").cast("string")
    damaged = inject.inject_nulls(customers, 0.02, ["name", "email"], row_id)
    return inject.inject_duplicates(damaged, 0.01, row_id, "seq")


def column_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source customer table mapped onto the customers contract."""
    upload = testbed.source(spark, sf_dir, "customer")
    chosen = {"name": "c_name", "email": "c_mktsegment", "location": "c_nationkey"}
    return mapping.map_columns(upload, "customers", chosen)


# --- quality --------------------------------------------------------------------


def _per_table(check: Callable[[DataFrame, str], DataFrame], tables: dict[str, DataFrame]) -> DataFrame:
    out = None
    for name, df in tables.items():
        part = check(df, name)
        out = part if out is None else out.unionByName(part)
    return out


def _star_and_raw(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The clean star, and the raw tables with readable keys, where the checks have something to find."""
    raw = raw_tables(spark, sf_dir)
    keys = {"orders": "order_id", "customers": "customer_id", "products": "product_id"}
    typed = {
        f"raw_{n}": raw[n].select(clean.integer_column(raw[n], k).alias(k)) for n, k in keys.items()
    }
    return {**star_tables(spark, sf_dir), **typed}


_PK = {
    "dim_date": "date_id", "dim_customers": "customer_id", "dim_products": "product_id", "fact_orders": "order_id",
    "raw_orders": "order_id", "raw_customers": "customer_id", "raw_products": "product_id",
}


def check_null_pks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The star's keys, and the foreign key of the raw orders, which has nulls."""
    tables = star_tables(spark, sf_dir)
    raw = raw_tables(spark, sf_dir)["orders"].select("customer_id")
    report = _per_table(lambda df, name: quality.check_null_pks(df, name, _PK[name]), tables)
    return report.unionByName(quality.check_null_pks(raw, "raw_orders", "customer_id"))


def check_duplicate_pks(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = _star_and_raw(spark, sf_dir)
    return _per_table(lambda df, name: quality.check_duplicate_pks(df, name, _PK[name]), tables)


def check_ref_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = star_tables(spark, sf_dir)
    dims = {dim: tables[dim] for dim in quality.FOREIGN_KEYS.values()}
    fk = {dim: k for k, dim in quality.FOREIGN_KEYS.items()}
    return _per_table(
        lambda df, dim: quality.check_referential_integrity(tables["fact_orders"], df, fk[dim], dim), dims
    )


def check_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = star_tables(spark, sf_dir)
    return _per_table(lambda df, name: quality.check_row_count(df, name, quality.MIN_ROWS[name]), tables)


def check_revenue_positive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.check_revenue_positive(star_tables(spark, sf_dir)["fact_orders"])


def _one_kind(kind: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        suites = {
            t: [e for e in es if e.kind == kind] for t, es in quality.STAR_EXPECTATIONS.items()
        }
        return quality.evaluate_star(star_tables(spark, sf_dir), {t: es for t, es in suites.items() if es})

    return query


def schema_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The written star against its contract, and the raw products, whose columns differ from it."""
    tables = star_tables(spark, sf_dir)
    report = _per_table(quality.check_schema, tables)
    return report.unionByName(quality.check_schema(raw_tables(spark, sf_dir)["products"], "dim_products"))


def gate_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each mode of the gate makes of the star's report, beside the number of failed checks in it."""
    report = materialize(quality.validate_star(star_tables(spark, sf_dir)), "report")
    seen = []
    for mode in ("off", "warn", "fail"):
        try:
            seen.append((mode, quality.gate(report, mode), False))
        except quality.QualityError:
            seen.append((mode, None, True))
    outcome = spark.createDataFrame(seen, "mode string, reported long, stopped boolean")
    failed = report.agg(F.count_if(~F.col("passed")).alias("failed_checks"))
    return outcome.withColumn("failed_checks", failed.scalar())


# --- load -----------------------------------------------------------------------


def _load_verify(modes: list[str]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        tables = star_tables(spark, sf_dir)
        place = fresh_dir(spark, "warehouse")
        for mode in modes:
            loaded = warehouse.load_all(tables, "path", mode, warehouse=place)
        return warehouse.verify_load(loaded, tables)

    return query


def _on_appended(statement: str) -> Query:
    """SQL over a warehouse that was loaded in full and then appended to."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        tables = star_tables(spark, sf_dir)
        place = fresh_dir(spark, "warehouse")
        for mode in ("full", "incremental"):
            loaded = warehouse.load_all(tables, "path", mode, warehouse=place)
        return spark.sql(statement, **loaded)

    return query


def pipeline_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A full and an incremental run over the raw tables; the row counts of the steps, from their manifests."""
    raw, place = raw_tables(spark, sf_dir), fresh_dir(spark, "run")
    zones = pipeline.Zones(f"{place}/raw", f"{place}/star", f"{place}/validated", f"{place}/manifests")
    for mode in ("full", "incremental"):
        pipeline.run_pipeline(
            spark, zones, raw, testbed.ORDER_BY, "path", mode, load_options={"warehouse": f"{place}/warehouse"}
        )
    steps = artifacts.manifest_steps(artifacts.read_manifests(spark, zones.manifests))
    return steps.select("mode", "step", F.explode("row_counts").alias("table_name", "row_count"))


# --- artifacts ------------------------------------------------------------------


def log_level_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event stream written as log files, read back and filtered by level."""
    events = testbed.source(spark, sf_dir, "events")
    level = F.when(F.col("event_type") == "error", "ERROR").when(F.col("event_type") == "purchase", "WARNING")
    line = F.concat(
        F.lit("["), F.coalesce(level, F.lit("INFO")), F.lit("] event "), F.col("event_id").cast("string"),
        F.lit(" of user "), F.col("user_id").cast("string"),
    )
    folder = fresh_dir(spark, "logs")
    events.select(line.alias("value")).write.text(folder)
    logs = artifacts.read_logs(spark, folder, "*.txt")  # as Spark names text files
    return artifacts.filter_logs(logs, ["WARNING", "ERROR"]).select("value")


def run_manifest_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run manifest per order year, written as JSON files, read back as rows per step and table."""
    fact = star_tables(spark, sf_dir)["fact_orders"]
    year = F.floor(F.col("date_id") / 10000).cast("int")
    runs = fact.groupBy(year.alias("run")).agg(
        F.count("*").alias("rows"), F.count_if(F.col("order_status") == "cancelled").alias("cancelled")
    )

    def step(duration: float, counts) -> Column:
        return F.struct(F.lit("PASS").alias("status"), F.lit(duration).alias("duration"), counts.alias("row_counts"))

    manifest = F.struct(
        F.lit("SUCCESS").alias("status"),
        F.lit("full").alias("mode"),
        F.col("run").cast("string").alias("timestamp"),
        F.create_map(
            F.lit("transform"), step(0.25, F.create_map(F.lit("fact_orders"), F.col("rows"))),
            F.lit("load"), step(0.5, F.create_map(F.lit("fact_orders"), F.col("rows"), F.lit("cancelled"), F.col("cancelled"))),
        ).alias("steps"),
    )
    folder = fresh_dir(spark, "manifests")
    runs.select("run", F.to_json(manifest).alias("value")).write.partitionBy("run").text(folder)
    steps = artifacts.manifest_steps(artifacts.read_manifests(spark, folder))
    return steps.select(
        "timestamp", "run_status", "mode", "step", "step_status", "duration",
        F.explode("row_counts").alias("table_name", "row_count"),
    )


def report_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality report stored in two formats and read back. The star is validated once: the report is written first."""
    report = materialize(quality.validate_star(star_tables(spark, sf_dir)), "report")
    place = fresh_dir(spark, "reports")
    read = []
    for fmt in ("parquet", "csv"):
        artifacts.write_report(report, f"{place}/{fmt}", fmt)
        read.append(artifacts.read_report(spark, f"{place}/{fmt}", fmt).withColumn("fmt", F.lit(fmt)))
    return read[0].unionByName(read[1])


def quality_report_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality suite as one nested JSON report, read back as one row per check."""
    report = quality.validate_star(star_tables(spark, sf_dir))
    folder = fresh_dir(spark, "nested-report")
    quality.nested_report(report).coalesce(1).write.text(folder)
    return artifacts.read_nested_report(spark, folder)


# --- registry -------------------------------------------------------------------

# Plans that need nothing but the four star tables.
STAR_PLANS: dict[str, Callable[[dict[str, DataFrame]], DataFrame]] = {
    "q01_monthly_revenue": analytics.monthly_revenue,
    "q02_top_products": analytics.top_products,
    "q03_customer_lifetime_value": analytics.customer_lifetime_value,
    "q04_new_vs_repeat": analytics.new_vs_repeat,
    "q05_revenue_by_category": analytics.revenue_by_category,
    "q06_order_value_trend": analytics.order_value_trend,
    "q07_status_breakdown": analytics.status_breakdown,
    "q08_day_of_week": analytics.day_of_week,
    "q09_top_months": analytics.top_months,
    "q10_top_products_ranked": analytics.top_products_ranked,
    "q11_top_customers": analytics.top_customers,
    "q12_category_revenue": analytics.category_revenue,
    "q13_status_counts": analytics.status_counts,
    "q14_table_counts": analytics.table_counts,
    "mart_joined": marts.joined,
    "mart_monthly": marts.monthly,
    "mart_top_names": marts.top_names,
    "mart_category": marts.category,
    "mart_clv": marts.customer_value,
    "mart_clv_histogram": marts.customer_value_histogram,
    "mart_status": marts.status,
    "mart_product_perf": marts.product_performance,
    "mart_clv_top15": marts.customer_value_top,
    "kpi_active": marts.kpi_active,
    "kpi_all": marts.kpi_all,
    "kpi_cards": lambda star: marts.kpi_cards(marts.kpi_all(star)),
    "quality_report": quality.validate_star,
    "quality_score": lambda star: quality.quality_score(quality.validate_star(star)),
    "quality_tally": lambda star: quality.tally(quality.validate_star(star)),
    "quality_stats_by_table": lambda star: quality.statistics_by_table(quality.evaluate_star(star)),
}


def _on_star(plan: Callable[[dict[str, DataFrame]], DataFrame]) -> Query:
    return lambda spark, sf_dir: plan(star_tables(spark, sf_dir))


def _prepared(query: Query) -> Query:
    return lambda spark, sf_dir: query(prepare(spark), sf_dir)


def registry() -> dict[str, Query]:
    found: dict[str, Query] = {
        "extract_row_counts": extract_row_counts,
        "extract_csv_orders": extract_csv_orders,
        "extract_csv_customers": extract_csv_customers,
        "extract_csv_products": extract_csv_products,
        "upload_append": upload_append,
        "null_tokens": null_tokens,
        "clean_orders": _clean_orders,
        "clean_orders_datetimes": clean_orders_datetimes,
        "clean_customers": _clean_customers,
        "clean_products": _clean_products,
        "clean_rows_removed": lambda s, d: clean.rows_removed(raw_tables(s, d)),
        "dedupe_keep_first": dedupe_keep_first,
        "price_median_by_category": price_median_by_category,
        "price_fill_null_category": price_fill_null_category,
        "dim_date": dim_date,
        "dim_customers": lambda s, d: star.build_dim_customers(_clean_customers(s, d)),
        "dim_products": lambda s, d: star.build_dim_products(_clean_products(s, d)),
        "fact_orders": fact_orders,
        **{name: _on_star(plan) for name, plan in STAR_PLANS.items()},
        "check_null_pks": check_null_pks,
        "check_duplicate_pks": check_duplicate_pks,
        "check_ref_integrity": check_ref_integrity,
        "check_row_counts": check_row_counts,
        "check_revenue_positive": check_revenue_positive,
        "check_regex": _one_kind("regex"),
        "check_range": _one_kind("range"),
        "check_set": _one_kind("set"),
        "check_not_null": _one_kind("not_null"),
        "check_unique": _one_kind("unique"),
        "check_row_tolerance": lambda s, d: quality.check_row_tolerance(
            raw_tables(s, d)["orders"], star_tables(s, d)["fact_orders"], "fact_orders"
        ),
        "schema_check": schema_check,
        "gate_outcomes": gate_outcomes,
        "inject_nulls": inject_nulls,
        "inject_duplicates": inject_duplicates,
        "column_mapping": column_mapping,
        "load_verify_full": _load_verify(["full", "full"]),
        "load_verify_incremental": _load_verify(["full", "incremental"]),
        **{name: _on_appended(text) for name, text in STATEMENTS.items()},
        "pipeline_run": pipeline_run,
        **LOADS,
        "log_level_filter": log_level_filter,
        "run_manifest_steps": run_manifest_steps,
        "quality_report_flatten": quality_report_flatten,
        "report_round_trip": report_round_trip,
    }
    return {name: _prepared(query) for name, query in found.items()}
