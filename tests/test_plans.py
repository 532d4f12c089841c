"""What the physical plans must and must not contain."""

import pytest

import helpers as H
from skeinmart.plans import analytics, marts, snapshot
from skeinmart.plans.catalogue import STAR_PLANS
from skeinmart.operators import clean
from skeinmart.operators.star import StarTables
from skeinmart.session import shared_dir, size_shuffles
from skeinmart.schemas import STAR_SCHEMAS
from test_star_queries import engines  # noqa: F401


@pytest.fixture(scope="module")
def empty_star(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("empty")
    out = {}
    for name, schema in STAR_SCHEMAS.items():
        spark.createDataFrame([], schema).write.parquet(f"{folder}/{name}")
        out[name] = spark.read.schema(schema).parquet(f"{folder}/{name}")
    return out


@pytest.fixture
def no_broadcast(spark):
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    for k in keys:
        spark.conf.unset(k)


@pytest.mark.parametrize("name", STAR_PLANS)
def test_no_python_no_nested_loops(empty_star, name):
    text = H.plan(STAR_PLANS[name](empty_star))
    for bad in ("Python", "NestedLoop", "Cartesian"):
        assert bad not in text


@pytest.mark.parametrize("name", STAR_PLANS)
def test_broadcasts_are_never_forced(empty_star, no_broadcast, name):
    text = H.plan(STAR_PLANS[name](empty_star))
    assert "Broadcast" not in text


@pytest.mark.parametrize("name", ["q02_top_products", "q03_customer_lifetime_value", "q04_new_vs_repeat", "mart_clv_top15"])
def test_shuffle_joins_give_the_same(engines, no_broadcast, name):  # noqa: F811
    from test_star_queries import test_plan_equals_sql

    test_plan_equals_sql(engines, name)


def test_empty_star(empty_star):
    assert tuple(marts.kpi_active(empty_star).first()) == (0.0, 0, 0.0, 0)
    assert tuple(marts.kpi_all(empty_star).first()) == (0.0, 0, 0.0, 0)
    assert marts.customer_value_histogram(empty_star).count() == 0
    assert analytics.revenue_by_category(empty_star).count() == 0


def test_top_k_keeps_k_rows_per_task(empty_star):
    for plan in (analytics.top_products, analytics.customer_lifetime_value, analytics.top_customers, marts.top_names):
        assert "TakeOrderedAndProject" in H.plan(plan(empty_star))


def test_sums_come_before_the_join(empty_star, no_broadcast):
    for plan, key in ((analytics.top_products, "product_id"), (analytics.top_customers, "customer_id")):
        text = H.plan(plan(empty_star))
        join = text.index("SortMergeJoin")
        assert "partial_sum" in text[join:], "the fact is summed below the join"
        # One shuffle of the fact sums on the key serves aggregate, join and second aggregate.
        assert text[:join].count("Exchange") == 0, key


def test_unique_keys_spare_the_shuffle_of_order_ids(empty_star):
    known = StarTables(empty_star, unique_keys=True)
    for plan in (analytics.monthly_revenue, analytics.revenue_by_category, analytics.day_of_week, marts.monthly):
        assert "order_id" in "".join(l for l in H.plan(plan(empty_star)).splitlines() if "hashpartitioning" in l)
        assert "order_id" not in "".join(l for l in H.plan(plan(known)).splitlines() if "hashpartitioning" in l)


def test_scans_read_only_what_they_need(empty_star):
    text = H.plan(analytics.status_counts(empty_star))
    assert "ReadSchema: struct<revenue:double,order_status:string>" in text
    text = H.plan(analytics.top_products(empty_star))
    assert "Not(EqualTo(order_status,cancelled))" in text.replace("Not(EqualTo(order_status, cancelled))", "Not(EqualTo(order_status,cancelled))")


def test_first_order_window_is_over_months(empty_star):
    text = H.plan(analytics.new_vs_repeat(empty_star))
    window = text.index("Window [min(earliest")
    assert "HashAggregate(keys=[customer_id" in text[window:], "rows are one per customer and month before the window"


def test_shared_dir_is_the_clusters(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark).startswith(f"{base}/skeinmart/")


def test_size_shuffles_only_raises(spark):
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    try:
        assert size_shuffles(spark, 1000) == int(before)
        assert size_shuffles(spark, 40 << 30) == 80
        assert size_shuffles(spark, 100 << 40) == 204_800
        assert size_shuffles(spark, 1000) == 204_800
    finally:
        spark.conf.set(key, before)


def test_zones_follow_changed_files(spark, tmp_path):
    import shutil

    for t in snapshot.testbed.SOURCE_TABLES:
        shutil.copyfile(f"/root/testdata/sf0.001/{t}.parquet", tmp_path / f"{t}.parquet")
    folder = str(tmp_path)
    first = snapshot.raw_tables(spark, folder)["products"]
    assert snapshot.raw_tables(spark, folder)["products"].inputFiles() == first.inputFiles()
    spark.read.parquet("/root/testdata/sf0.001/part.parquet").limit(10).toPandas().to_parquet(tmp_path / "part.parquet")
    assert snapshot.raw_tables(spark, folder)["products"].count() < first.count()


def test_fill_is_one_pass_over_the_products(spark):
    text = H.plan(clean.fill_prices(clean.typed_products(H.products(spark))))
    assert text.count("Scan ExistingRDD") == 1 and "Exchange hashpartitioning" not in text


@pytest.fixture
def small_skew_limits(spark):
    """Skew handling as on large data, with limits a test can reach."""
    conf = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_a_hot_product_is_split_in_the_fact_join(spark, no_broadcast, small_skew_limits):
    from pyspark.sql import functions as F
    from skeinmart.operators.star import build_fact_orders

    product = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 500)
    orders = spark.range(60_000, numPartitions=8).select(
        F.col("id").alias("order_id"), F.col("id").alias("customer_id"), product.alias("product_id"),
        (F.col("id") % 5).alias("quantity"), F.lit("2024-01-01").cast("date").alias("order_date"),
        F.md5(F.col("id").cast("string")).alias("status"),
    )
    products = spark.range(500).select(F.col("id").alias("product_id"), (F.col("id") * 1.5).alias("price"))
    fact = build_fact_orders(orders, products)
    assert "skew=true" in H.final_plan(fact)
    assert fact.count() == 60_000
    hot = fact.filter("product_id = 7").agg(F.count("*"), F.sum("revenue")).first()
    want = [i for i in range(60_000) if i % 3 == 0 or i % 500 == 7]
    assert tuple(hot) == (len(want), sum((i % 5) * 10.5 for i in want))
