"""Star-schema builders: one fact table and three dimensions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import calendar_columns, date_key, key_date
from ..functions.numeric import round_half_even_2
from ..schemas import STAR_SCHEMAS


class StarTables(dict):
    """The star tables by name.

    ``unique_keys`` states that every table holds one row per primary key, as the
    transform writes them and as the quality suite can confirm. Distinct orders are
    then plain counts, which combine before the shuffle; without it every order id
    has to be shuffled. A warehouse that was appended to must not claim it.
    """

    def __init__(self, tables: Mapping[str, DataFrame], unique_keys: bool = False):
        super().__init__(tables)
        self.unique_keys = unique_keys


def distinct_orders(star: Mapping[str, DataFrame]) -> Column:
    """Aggregate: number of different orders among fact rows joined to dimensions of this star."""
    if getattr(star, "unique_keys", False):
        return F.count("order_id")
    return F.count_distinct("order_id")


def build_dim_date(orders: DataFrame) -> DataFrame:
    """One row per date that occurs. Distinct first, so the attributes are computed once per date."""
    return orders.select(F.col("order_date").cast("date").alias("d")).distinct().select(*calendar_columns(F.col("d")))


def build_dim_date_from_fact(fact: DataFrame) -> DataFrame:
    """The same dimension from the fact's date keys: reads one column of the written table."""
    return build_dim_date(fact.select("date_id").distinct().select(key_date(F.col("date_id")).alias("order_date")))


def build_dim_customers(customers: DataFrame) -> DataFrame:
    return customers.select(*STAR_SCHEMAS["dim_customers"].names)


def build_dim_products(products: DataFrame) -> DataFrame:
    return products.select(*STAR_SCHEMAS["dim_products"].names)


def backfill(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project to a schema; a missing column becomes 0 (numbers) or ``unknown`` (text)."""
    columns = []
    for field in schema.fields:
        if field.name in df.columns:
            columns.append(F.col(field.name))
        else:
            filler = F.lit(0) if isinstance(field.dataType, T.NumericType) else F.lit("unknown")
            columns.append(filler.cast(field.dataType).alias(field.name))
    return df.select(*columns)


def build_fact_orders(orders: DataFrame, products: DataFrame) -> DataFrame:
    """Orders with the product's price; unknown products cost 0.

    No broadcast hint: Spark broadcasts the two product columns when their size is
    under the session's threshold and otherwise joins by shuffle, with skewed
    products split by AQE.
    """
    priced = (
        orders.join(products.select("product_id", "price"), "product_id", "left")
        .withColumn("unit_price", F.coalesce("price", F.lit(0.0)))
        .withColumn("revenue", round_half_even_2(F.col("quantity") * F.col("unit_price")))
        .withColumn("date_id", date_key(F.col("order_date")))
        .withColumnsRenamed({"status": "order_status"})
    )
    return backfill(priced, STAR_SCHEMAS["fact_orders"])
