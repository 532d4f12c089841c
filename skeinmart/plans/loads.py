"""Registered queries over the published warehouse, damaged and first-format input, logs and distinct counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.dates import FIRST_VALUE
from ..operators import clean, distinct, quality
from ..operators.counts import row_counts
from ..operators.star import build_fact_orders
from ..schemas import RAW_COLUMNS, RAW_SCHEMAS, STAR_TABLES
from ..session import fresh_dir, materialize
from ..sources import artifacts, files, published, testbed, warehouse
from . import pipeline
from .snapshot import raw_tables, star_tables


def _house(spark: SparkSession) -> published.Warehouse:
    return published.Warehouse(spark, fresh_dir(spark, "published"))


def load_retry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A full load, an append, and the same append again; rows of each table and the batches in the ledger."""
    star, house = star_tables(spark, sf_dir), _house(spark)
    house.load(star, "day-0", constraints="off")
    for _ in range(2):
        house.load(star, "day-1", "incremental", constraints="off")
    ledger = published.version_rows(house.batches(), spark)
    batches = ledger.groupBy("table_name").agg(F.count("*").alias("batches"))
    return row_counts(house.read()).join(batches, "table_name")


def load_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the published tables have the content of the star, and would without one of their rows."""
    star, house = star_tables(spark, sf_dir), _house(spark)
    batch = house.load(star, "day-0", constraints="off")
    rows = []
    for name, df in house.read().items():
        key = published.PRIMARY_KEYS[name]
        less = df.where(F.col(key) != df.agg(F.max(key)).first()[0])
        known = batch.tables[name]
        rows.append((name, known.rows, published.content(star[name], name) == known, published.content(less, name) == known))
    return spark.createDataFrame(rows, "table_name string, row_count long, same_content boolean, same_without_a_row boolean")


def load_constraints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load with planted repeated, null and orphan keys is refused: what it broke, and whether anything is published."""
    star, house = star_tables(spark, sf_dir), _house(spark)
    customers, products = star["dim_customers"], star["dim_products"]
    planted = {
        "dim_date": star["dim_date"].where("date_id % 100 <> 15"),
        "dim_customers": customers.unionByName(customers.where("customer_id % 100 = 7")),
        "dim_products": products.withColumn("product_name", F.when(F.col("product_id") % 100 != 3, F.col("product_name"))),
        "fact_orders": star["fact_orders"],
    }
    broken = []
    try:
        house.load(planted, "day-0")
    except published.ConstraintError as e:
        broken = e.violations
    found = spark.createDataFrame(broken, "table_name string, constraint_name string, broken_rows long")
    return found.withColumn("published", F.lit(house.version() > 0))


def load_skip_known(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the orders are loaded, then all of them, without those that are stored."""
    star, house = star_tables(spark, sf_dir), _house(spark)
    half = {**star, "fact_orders": star["fact_orders"].where("order_id % 2 = 0")}
    first = house.load(half, "day-0", constraints="off")
    added = house.load(star, "day-1", "incremental", skip_known=True, constraints="off")
    rows = [(name, first.tables[name].rows, added.tables[name].rows) for name in STAR_TABLES]
    notes = spark.createDataFrame(rows, "table_name string, first_rows long, added_rows long")
    return row_counts(house.read()).join(notes, "table_name")


def clean_orders_first_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with day-first dates; one order in seven keeps its ISO date, which the layout of the first value does not read."""
    orders = raw_tables(spark, sf_dir)["orders"]
    day = F.expr("try_cast(order_date AS date)")
    other = day.isNull() | (F.col("order_id").cast("bigint") % 7 == 0)
    text = F.when(other, F.col("order_date")).otherwise(F.date_format(day, "dd/MM/yyyy"))
    first = F.when(other, 99).otherwise(31 - F.dayofmonth(day))  # a late day of a month comes first
    dated = orders.withColumns({"order_date": text, "s0": first})
    return clean.clean_orders(dated, ["s0", *testbed.ORDER_BY["orders"]], FIRST_VALUE)


def extract_damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as CSV lines, some cut short, some with fields too many: rows and order ids of the good and of the quarantined."""
    orders, columns = raw_tables(spark, sf_dir)["orders"], RAW_COLUMNS["orders"]
    fields = [F.coalesce(F.col(c), F.lit("")) for c in columns]
    key = F.col("order_id").cast("bigint")
    line = F.when(key % 11 == 0, F.concat_ws(",", *fields[:4])).when(key % 13 == 0, F.concat_ws(",", *fields, F.lit("more"), F.lit("x")))
    line = line.otherwise(F.concat_ws(",", *fields))
    begins = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0  # the first row of each file
    folder = fresh_dir(spark, "damaged")
    orders.select(F.when(begins, F.concat(F.lit(",".join(columns) + "\n"), line)).otherwise(line).alias("value")).write.text(folder)
    good, bad = files.read_csv_checked(spark, folder, RAW_SCHEMAS["orders"])
    first = F.regexp_extract("line", "^([0-9]*)", 1)
    both = good.select(F.lit(False).alias("damaged"), "order_id").unionByName(bad.select(F.lit(True).alias("damaged"), first.alias("order_id")))
    return both.groupBy("damaged").agg(F.count("*").alias("row_count"), F.sum(F.col("order_id").cast("bigint")).alias("id_sum"))


def extract_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per table of a folder that has only orders."""
    folder = fresh_dir(spark, "raw-csv")
    warehouse.write_table(raw_tables(spark, sf_dir)["orders"].select(RAW_COLUMNS["orders"]), f"{folder}/orders.csv", fmt="csv")
    return row_counts(files.extract_all(spark, folder))


def named_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables of a zone asked for by name, one of which it does not have."""
    zone = fresh_dir(spark, "zone")
    warehouse.write_star(star_tables(spark, sf_dir), zone)
    found = {name: files.get_table(spark, name, zone) for name in (*STAR_TABLES, "dim_stores")}
    counts = row_counts({name: df for name, df in found.items() if df is not None})
    asked = spark.createDataFrame([(name, df is not None) for name, df in found.items()], "table_name string, found boolean")
    return asked.join(counts, "table_name", "left")


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event stream as one log file a day, read back as lines numbered by file, with the newest file first."""
    events = testbed.source(spark, sf_dir, "events")
    line = F.concat(F.lit("["), F.upper("event_type"), F.lit("] event "), F.col("event_id").cast("string"))
    days = events.select(F.date_format("ts", "yyyy-MM-dd").alias("day"), "event_id", line.alias("value"))
    folder = fresh_dir(spark, "log-days")
    days.repartition("day").sortWithinPartitions("day", "event_id").select("day", "value").write.partitionBy("day").text(folder)
    logs = artifacts.read_logs(spark, folder, "*.txt", recursive=True).withColumn("day", F.regexp_extract("file_path", "day=([0-9-]+)", 1))
    newest = logs.select("day").distinct().select("day", F.row_number().over(Window.orderBy(F.desc("day"))).alias("file_no"))  # one row a file
    return logs.join(newest, "day").select("file_no", "day", "line_no", "value")


def pipeline_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run whose load fails, and the same run again: status of the steps, and rows of the transform."""
    raw, place = raw_tables(spark, sf_dir), fresh_dir(spark, "resumed")
    zones = pipeline.Zones(f"{place}/raw", f"{place}/star", f"{place}/validated")
    key = files.files_state(spark, [f"{sf_dir}/{t}.parquet" for t in testbed.SOURCE_TABLES]).digest
    rows = []
    for run, options in enumerate(({"fmt": "no-such-format"}, {}), 1):
        result = None
        try:
            result = pipeline.run_pipeline(
                spark, zones, raw, testbed.ORDER_BY, "path", load_options={"warehouse": f"{place}/warehouse", **options}, resume=True, input_key=key
            )
        except Exception as e:  # the first run's load; its steps before are noted
            rows.append((run, "load", "FAIL", type(e).__name__, None))
        for step, note in result.steps.items() if result else ():
            for table, n in (note["row_counts"] or {None: None}).items():
                rows.append((run, step, note["status"], table, n))
    return spark.createDataFrame(rows, "run int, step string, status string, table_name string, row_count long").where("status <> 'FAIL'")


def distinct_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers per month, quarter and year of the star's orders, from monthly bitmaps."""
    fact = star_tables(spark, sf_dir)["fact_orders"]
    return distinct.calendar_rollup(distinct.monthly_bitmaps(fact, "customer_id")).withColumnRenamed("keys", "customers")


def check_pct_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Limits of 0 % on the star's keys, and of 0 and 5 % on those of the raw orders and customers."""
    star, raw = star_tables(spark, sf_dir), raw_tables(spark, sf_dir)
    out = None
    for limit, tables in ((0.0, star), (0.0, raw), (5.0, raw)):
        for name, key in quality.PRIMARY_KEYS.items() if tables is star else (("orders", "customer_id"), ("customers", "customer_id")):
            part = quality.check_pct_limits(tables[name], name if tables is star else f"raw_{name}", key, limit, limit)
            out = part if out is None else out.unionByName(part)
    return out


def load_connector(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A full and an incremental load through a data source that takes its table by an option, as warehouse connectors do."""
    tables, place = star_tables(spark, sf_dir), fresh_dir(spark, "connector")
    for mode in ("full", "incremental"):
        loaded = warehouse.load_all(tables, "connector", mode, fmt="parquet", table_option="path", prefix=f"{place}/")
    return warehouse.verify_load(loaded, tables)


def clean_without_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of cleaned customers and products, and of the same tables without their key column."""
    raw, out = raw_tables(spark, sf_dir), {}
    for name, cleaned, key in (("customers", clean.clean_customers, "customer_id"), ("products", clean.clean_products, "product_id")):
        out[name] = cleaned(raw[name], testbed.ORDER_BY[name])
        out[f"{name}_without_key"] = cleaned(raw[name].drop(key), testbed.ORDER_BY[name])
    return row_counts(out)


def fact_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact of orders that have neither customers nor a status: 0 and ``unknown`` in their place."""
    orders = clean.clean_orders(raw_tables(spark, sf_dir)["orders"], testbed.ORDER_BY["orders"])
    return build_fact_orders(orders.drop("customer_id", "status"), star_tables(spark, sf_dir)["dim_products"])


def preview_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each star table's preview, and how many different rows of the table they are."""
    star, keys = star_tables(spark, sf_dir), quality.PRIMARY_KEYS
    shown = {name: materialize(files.preview(df), "preview") for name, df in star.items()}
    # The table is held against the few keys shown: they are broadcast, and none of its rows is shuffled.
    known = {name: df.join(shown[name], keys[name], "left_semi").select(keys[name]).distinct() for name, df in star.items()}
    return row_counts(shown).join(row_counts(known).withColumnRenamed("row_count", "known_rows"), "table_name")


def pipeline_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs over orders of negative quantity, one that stops at the gate and one that ignores it: their steps, read from the manifests."""
    raw, place = raw_tables(spark, sf_dir), fresh_dir(spark, "gates")
    negative = F.when(F.col("order_id").cast("bigint") % 2 == 0, F.concat(F.lit("-"), "quantity")).otherwise(F.col("quantity"))
    raw = {**raw, "orders": raw["orders"].withColumn("quantity", negative)}
    for mode in ("fail", "off"):
        zones = pipeline.Zones(f"{place}/raw", f"{place}/{mode}/star", f"{place}/{mode}/validated", f"{place}/manifests")
        try:
            pipeline.run_pipeline(spark, zones, raw, testbed.ORDER_BY, "path", gate_mode=mode, load_options={"warehouse": f"{place}/{mode}/warehouse"})
        except quality.QualityError:
            pass  # noted in the manifest
    steps = artifacts.manifest_steps(artifacts.read_manifests(spark, f"{place}/manifests"))
    return steps.select("run_status", "step", "step_status", F.explode_outer("row_counts").alias("table_name", "row_count"))


QUERIES = {
    f.__name__: f
    for f in (
        load_retry, load_digest, load_constraints, load_skip_known, clean_orders_first_format, extract_damaged, extract_missing,
        named_tables, log_lines, pipeline_resume, distinct_rollup, check_pct_limits,
        load_connector, clean_without_keys, fact_backfill, preview_tables, pipeline_gates,
    )
}
