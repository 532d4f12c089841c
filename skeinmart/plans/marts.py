"""Tables behind the dashboards and the KPI rows."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import display
from ..functions import numeric as N
from ..functions.dates import period_label
from ..operators.ranking import equal_width_histogram, top_k
from ..operators.star import distinct_orders
from ..schemas import CANCELLED
from ..sources.files import FilesState, files_state

Star = Mapping[str, DataFrame]


def not_cancelled(df: DataFrame) -> DataFrame:
    """Dataframe rule: an order without a status is kept."""
    return df.filter(~F.col("order_status").eqNullSafe(F.lit(CANCELLED)))


def joined(star: Star) -> DataFrame:
    """Fact with date and product columns; orders without either are dropped."""
    dates = star["dim_date"].select("date_id", "month", "year", "month_name")
    products = star["dim_products"].select("product_id", "product_name", "category", "price")
    return star["fact_orders"].join(dates, "date_id").join(products, "product_id")


def cached(df: DataFrame) -> DataFrame:
    """Keep a table for several readers; blocks lost with an executor are recomputed."""
    return df.persist()


class FollowingCache:
    """Tables that are kept as long as the files they come from stay as they are.

    ``get`` lists the files. While the listing is the same the kept table is given out;
    when it changes, that table is released and built again.
    """

    def __init__(self, spark: SparkSession):
        self._spark = spark
        self._kept: dict[str, tuple[FilesState, DataFrame]] = {}

    def get(self, name: str, paths: list[str], build: Callable[[], DataFrame]) -> DataFrame:
        state = files_state(self._spark, paths)
        kept = self._kept.get(name)
        if kept and kept[0] == state:
            return kept[1]
        self.release(name)
        self._kept[name] = state, cached(build())
        return self._kept[name][1]

    def release(self, name: str | None = None) -> None:
        """Let go of one table, or of all."""
        for key in [name] if name else list(self._kept):
            kept = self._kept.pop(key, None)
            if kept:
                kept[1].unpersist()


def _revenue() -> Column:
    return N.sum_cents(F.col("revenue"))


def _known_dates(star: Star) -> DataFrame:
    """Active fact rows whose date is in the date dimension."""
    return not_cancelled(star["fact_orders"]).join(star["dim_date"].select("date_id"), "date_id")


def _known(star: Star) -> DataFrame:
    """Active fact rows of the joined mart, without its descriptive columns."""
    return _known_dates(star).join(star["dim_products"].select("product_id"), "product_id")


def _per_product(star: Star) -> DataFrame:
    """Active joined mart summed per product: one row per product goes into the join."""
    sums = (
        _known_dates(star)
        .groupBy("product_id")
        .agg(_revenue().alias("rev"), F.sum("quantity").alias("units"), F.count("*").alias("n_rows"))
    )
    return sums.join(star["dim_products"].select("product_id", "product_name", "category", "price"), "product_id")


def monthly(star: Star) -> DataFrame:
    """Revenue and orders per month, with a ``YYYY-MM`` label."""
    keys = ["year", "month", "month_name"]
    dates = star["dim_date"].select("date_id", *keys)
    rows = not_cancelled(star["fact_orders"]).join(
        star["dim_products"].select("product_id"), "product_id"
    )
    return (
        rows.join(dates, "date_id")
        .groupBy(*keys)
        .agg(N.from_cents(_revenue()).alias("revenue"), distinct_orders(star).alias("orders"))
        .withColumn("period", period_label(F.col("year"), F.col("month")))
        .orderBy("year", "month")
    )


def top_names(star: Star, k: int = 10) -> DataFrame:
    """By product name and category, so products of one name count together."""
    names = (
        _per_product(star)
        .groupBy("product_name", "category")
        .agg(N.from_cents(F.sum("rev")).alias("revenue"))
    )
    return top_k(names, k, "revenue", ["product_name", "category"])


def category(star: Star) -> DataFrame:
    return (
        _per_product(star)
        .filter(F.col("category").isNotNull())
        .groupBy("category")
        .agg(N.from_cents(F.sum("rev")).alias("revenue"))
        .orderBy(F.desc("revenue"), "category")
    )


def _customer_cents(star: Star) -> DataFrame:
    return (
        _known(star)
        .filter(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(_revenue().alias("rev"))
    )


def customer_value(star: Star) -> DataFrame:
    return _customer_cents(star).select("customer_id", N.from_cents(F.col("rev")).alias("lifetime_value"))


def customer_value_histogram(star: Star, bins: int = 30) -> DataFrame:
    return (
        equal_width_histogram(_customer_cents(star), F.col("rev"), bins)
        .withColumnRenamed("n", "customers")
        .orderBy("bin")
    )


def customer_value_top(star: Star, k: int = 15) -> DataFrame:
    """Best customers with a known name: summed first, then joined, then cut."""
    named = _customer_cents(star).join(star["dim_customers"].select("customer_id", "name"), "customer_id")
    values = named.select("customer_id", N.from_cents(F.col("rev")).alias("revenue"), "name")
    return top_k(values, k, "revenue", ["customer_id"])


def status(star: Star) -> DataFrame:
    """Orders per status in the joined mart, cancelled ones included."""
    rows = star["fact_orders"].join(star["dim_date"].select("date_id"), "date_id")
    rows = rows.join(star["dim_products"].select("product_id"), "product_id")
    return (
        rows.filter(F.col("order_status").isNotNull())
        .groupBy("order_status")
        .agg(F.count("order_id").alias("count"))
    )


def product_performance(star: Star) -> DataFrame:
    """Per product name: revenue, list price averaged over order rows, quantity."""
    return (
        _per_product(star)
        .groupBy("product_name")
        .agg(
            F.sum("rev").alias("rev"),
            F.sum(N.cents(F.col("price")) * F.when(F.col("price").isNotNull(), F.col("n_rows"))).alias("priced"),
            F.sum(F.when(F.col("price").isNotNull(), F.col("n_rows"))).alias("n"),
            F.sum("units").alias("quantity"),
        )
        .select(
            "product_name",
            N.from_cents(F.col("rev")).alias("revenue"),
            N.mean_of_cents(F.col("priced"), F.col("n")).alias("price"),
            "quantity",
        )
    )


def _kpis(star: Star, rows: DataFrame) -> DataFrame:
    """Revenue, orders, order value and customers of some fact rows; zeros when there are none."""
    sums = [F.coalesce(_revenue(), F.lit(0).cast("bigint")).alias("rev"), distinct_orders(star).alias("total_orders")]
    customers = F.count_distinct("customer_id")
    if getattr(star, "unique_keys", False):
        total = rows.agg(*sums, customers.alias("total_customers"))
    else:
        # Two distinct counts in one pass would send every row to the shuffle twice.
        total = rows.agg(*sums).withColumn("total_customers", rows.agg(customers).scalar())
    revenue = N.from_cents(F.col("rev"))
    return total.select(
        revenue.alias("total_revenue"),
        "total_orders",
        F.coalesce(F.try_divide(revenue, F.col("total_orders").cast("double")), F.lit(0.0)).alias("aov"),
        "total_customers",
    )


def kpi_active(star: Star) -> DataFrame:
    """Without cancelled orders and without orders of unknown dates or products."""
    return _kpis(star, _known(star))


def kpi_all(star: Star) -> DataFrame:
    """All fact rows."""
    return _kpis(star, star["fact_orders"])


def kpi_cards(kpis: DataFrame) -> DataFrame:
    """The KPI row as display text."""
    return kpis.select(
        display.dollars(F.col("total_revenue"), 0).alias("total_revenue"),
        display.thousands(F.col("total_orders")).alias("total_orders"),
        display.dollars(F.col("aov"), 2).alias("aov"),
        display.thousands(F.col("total_customers")).alias("total_customers"),
    )


def dashboard(star: Star) -> dict[str, DataFrame]:
    """All tables one dashboard page needs."""
    return {
        "monthly": monthly(star),
        "top_products": top_names(star),
        "category": category(star),
        "clv": customer_value(star),
        "clv_histogram": customer_value_histogram(star),
        "status": status(star),
        "kpi": kpi_active(star),
    }
