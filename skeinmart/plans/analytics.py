"""The query catalogue over the star schema.

Every function takes the star (``dict`` of DataFrames) and returns a DataFrame.

Sums that belong to one key are aggregated on the fact before the dimension is
joined: the map-side combine then meets a hot product or customer first, and the
join sees one row per key. Money is summed as whole cents.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import numeric as N
from ..operators.counts import row_counts
from ..operators.ranking import top_k, with_rank
from ..operators.star import distinct_orders
from ..schemas import CANCELLED

Star = Mapping[str, DataFrame]

_MONTH = ("year", "month", "month_name")


def active(fact: DataFrame) -> DataFrame:
    """Orders that were not cancelled."""
    return fact.filter(F.col("order_status") != CANCELLED)


def money(total_cents: str = "rev") -> Column:
    """A cents total as an amount rounded to two digits."""
    return N.round_half_up(N.from_cents(F.col(total_cents)), 2)


def average(total_cents: str, n: str) -> Column:
    return N.round_half_up(N.mean_of_cents(F.col(total_cents), F.col(n)), 2)


def _revenue() -> list[Column]:
    """Cents total and the number of amounts in it."""
    return [N.sum_cents(F.col("revenue")).alias("rev"), F.count("revenue").alias("rev_n")]


def _by_labels(star: Star, dim: str, key: str, labels: tuple[str, ...]) -> DataFrame:
    """Active fact by columns of one dimension: distinct orders, units, revenue.

    With unique keys all of these add up, so the fact is summed per dimension key
    first; otherwise an order may occur under several keys and is counted after the join.
    """
    fact = active(star["fact_orders"])
    dimension = star[dim].select(key, *labels)
    sums = [distinct_orders(star).alias("orders"), F.sum("quantity").alias("units"), *_revenue()]
    if getattr(star, "unique_keys", False):
        per_key = fact.groupBy(key).agg(*sums).join(dimension, key)
        return per_key.groupBy(*labels).agg(*[F.sum(c).alias(c) for c in ("orders", "units", "rev", "rev_n")])
    return fact.join(dimension, key).groupBy(*labels).agg(*sums)


def _by_month(star: Star) -> DataFrame:
    return _by_labels(star, "dim_date", "date_id", _MONTH)


def monthly_revenue(star: Star) -> DataFrame:
    return (
        _by_month(star)
        .select(
            *_MONTH,
            F.col("orders").alias("total_orders"),
            F.col("units").alias("total_units_sold"),
            money().alias("total_revenue"),
            average("rev", "rev_n").alias("avg_order_revenue"),
        )
        .orderBy("year", "month")
    )


def _by_product(star: Star, *names: str) -> DataFrame:
    """Active fact per product_id, joined to the product: products without a dimension row drop out.

    The second ``groupBy`` gives repeated dimension rows (an appended warehouse has
    them) the weight a plain join would give. It needs no shuffle of its own.
    """
    per_product = (
        active(star["fact_orders"])
        .groupBy("product_id")
        .agg(
            F.count("order_id").alias("orders"),
            F.sum("quantity").alias("units"),
            N.sum_cents(F.col("unit_price")).alias("prices"),
            F.count("unit_price").alias("prices_n"),
            *_revenue(),
        )
    )
    sums = ["orders", "units", "prices", "prices_n", "rev", "rev_n"]
    return (
        per_product.join(star["dim_products"].select("product_id", "product_name", "category"), "product_id")
        .groupBy("product_id", *names)
        .agg(
            *[F.sum(c).alias(c) for c in sums],
            *[F.min(c).alias(c) for c in ("product_name", "category") if c not in names],
        )
    )


def top_products(star: Star, k: int = 10) -> DataFrame:
    ranked = _by_product(star, "product_name", "category").select(
        "product_id",
        "product_name",
        "category",
        F.col("orders").alias("times_ordered"),
        F.col("units").alias("total_units_sold"),
        money().alias("total_revenue"),
        average("prices", "prices_n").alias("avg_unit_price"),
    )
    return top_k(ranked, k, "total_revenue", ["product_id"])


def _by_customer(rows: DataFrame, star: Star, names: list[str], *more: Column) -> DataFrame:
    """Fact rows per customer_id, joined to the customer; columns as in :func:`_by_product`."""
    per_customer = rows.groupBy("customer_id").agg(
        distinct_orders(star).alias("orders"), *_revenue(), *more
    )
    same = [c for c in per_customer.columns if c not in ("customer_id", "rev", "rev_n")]
    return (
        per_customer.join(star["dim_customers"].select("customer_id", "name", "location"), "customer_id")
        .groupBy("customer_id", *names)
        .agg(
            F.sum("rev").alias("rev"),
            F.sum("rev_n").alias("rev_n"),
            *[F.max(c).alias(c) for c in same],
            *[F.min(c).alias(c) for c in ("name", "location") if c not in names],
        )
    )


def customer_lifetime_value(star: Star, k: int = 20) -> DataFrame:
    dated = active(star["fact_orders"]).join(star["dim_date"].select("date_id", "full_date"), "date_id")
    ranked = _by_customer(
        dated,
        star,
        ["name", "location"],
        F.min("full_date").alias("first_order_date"),
        F.max("full_date").alias("last_order_date"),
    ).select(
        "customer_id",
        "name",
        "location",
        F.col("orders").alias("total_orders"),
        money().alias("lifetime_value"),
        average("rev", "rev_n").alias("avg_order_value"),
        "first_order_date",
        "last_order_date",
    )
    return top_k(ranked, k, "lifetime_value", ["customer_id"])


def new_vs_repeat(star: Star) -> DataFrame:
    """Customers per month with an order on their first date (new) and on any other date (repeat).

    One customer may be both. Per customer and month only the first and the last
    order date matter: the month holds the customer's first date when its earliest
    is the earliest overall, and another date when its latest is not. So the fact is
    reduced to one row per customer and month before anything is compared, and the
    window sees at most the months of one customer.
    """
    dates = star["dim_date"].select("date_id", "year", "month")
    per_month = (
        active(star["fact_orders"])
        .filter(F.col("customer_id").isNotNull())
        .join(dates, "date_id", "left")  # dates without a dimension row still count as a first date
        .groupBy("customer_id", "year", "month")
        .agg(F.min("date_id").alias("earliest"), F.max("date_id").alias("latest"))
    )
    first = F.min("earliest").over(Window.partitionBy("customer_id"))
    flagged = per_month.withColumn("first", first).filter(F.col("month").isNotNull())
    counts = flagged.groupBy("year", "month").agg(
        F.count_if(F.col("earliest") == F.col("first")).alias("new"),
        F.count_if(F.col("latest") != F.col("first")).alias("repeat"),
    )
    return (
        counts.unpivot(["year", "month"], ["new", "repeat"], "customer_type", "customer_count")
        .filter(F.col("customer_count") > 0)
        .orderBy("year", "month", "customer_type")
    )


def _by_category(star: Star) -> DataFrame:
    return _by_labels(star, "dim_products", "product_id", ("category",))


def revenue_by_category(star: Star) -> DataFrame:
    """The share is of all active revenue, including orders of unknown products."""
    whole = active(star["fact_orders"]).agg(N.sum_cents(F.col("revenue"))).scalar()
    return (
        _by_category(star)
        .select(
            "category",
            F.col("orders").alias("total_orders"),
            F.col("units").alias("total_units"),
            money().alias("total_revenue"),
            average("rev", "rev_n").alias("avg_order_revenue"),
            N.percent(F.col("rev"), whole).alias("revenue_pct"),
        )
        .orderBy(F.desc("total_revenue"), "category")
    )


def order_value_trend(star: Star) -> DataFrame:
    """Average order value: revenue over distinct orders."""
    return (
        _by_month(star)
        .select(
            *_MONTH,
            F.col("orders").alias("total_orders"),
            money().alias("total_revenue"),
            average("rev", "orders").alias("aov"),
        )
        .orderBy("year", "month")
    )


def _by_status(star: Star) -> DataFrame:
    return star["fact_orders"].groupBy("order_status").agg(F.count("*").alias("n"), *_revenue())


def status_breakdown(star: Star) -> DataFrame:
    """All orders, cancelled ones too."""
    everything = star["fact_orders"].agg(F.count("*")).scalar()
    return (
        _by_status(star)
        .select(
            "order_status",
            F.col("n").alias("order_count"),
            money().alias("total_revenue"),
            N.percent(F.col("n"), everything).alias("pct_of_orders"),
        )
        .orderBy(F.desc("order_count"), "order_status")
    )


def day_of_week(star: Star) -> DataFrame:
    return (
        _by_labels(star, "dim_date", "date_id", ("day_name", "day_of_week"))
        .select(
            "day_name",
            "day_of_week",
            F.col("orders").alias("total_orders"),
            money().alias("total_revenue"),
            average("rev", "rev_n").alias("avg_revenue"),
        )
        .orderBy("day_of_week")
    )


# --- short report --------------------------------------------------------------


def top_months(star: Star, k: int = 5) -> DataFrame:
    months = _by_month(star).select(*_MONTH, "orders", money().alias("revenue"))
    return top_k(months, k, "revenue", ["year", "month"])


def top_products_ranked(star: Star, k: int = 10) -> DataFrame:
    """By product id alone; name and category are printed."""
    products = _by_product(star).select("product_id", "product_name", "category", money().alias("rev"))
    ties = ["product_id"]
    best = with_rank(top_k(products, k, "rev", ties), "rev", ties)
    return best.select("rank", "product_name", "category", "rev").orderBy("rank")


def top_customers(star: Star, k: int = 5) -> DataFrame:
    """By customer id alone, without the date dimension."""
    customers = _by_customer(active(star["fact_orders"]), star, []).withColumn("clv", money())
    return top_k(customers, k, "clv", ["customer_id"]).select("name", "location", "orders", "clv")


def category_revenue(star: Star) -> DataFrame:
    return (
        _by_category(star)
        .select("category", "orders", money().alias("revenue"))
        .orderBy(F.desc("revenue"), "category")
    )


def status_counts(star: Star) -> DataFrame:
    return (
        _by_status(star)
        .select("order_status", F.col("n").alias("cnt"), money().alias("rev"))
        .orderBy(F.desc("cnt"), "order_status")
    )


def table_counts(star: Star) -> DataFrame:
    return row_counts(star)
