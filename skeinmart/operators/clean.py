"""Cleaning of the three raw tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.dates import ISO_DATE, date_column
from ..functions.numeric import integer_column, number_column, round_half_even_2
from ..functions.text import text_or_default, title_case
from ..session import materialize
from .dedupe import keep_first
from .rank_select import weighted_medians

# Ingest-order columns added by the file sources.
INGEST_ORDER = ["src_time", "src_path", "src_offset", "src_row"]


def _order_columns(df: DataFrame, order_by: Sequence[str] | None) -> dict[str, Column]:
    names = list(order_by or INGEST_ORDER)
    missing = [c for c in names if c not in df.columns]
    if missing:
        raise ValueError(f"keep-first needs the ingest order columns {missing}")
    return {f"__seq{i}": F.col(c) for i, c in enumerate(names)}


def _all_present(names: Sequence[str]) -> Column:
    present = F.lit(True)
    for name in names:
        present = present & F.col(name).isNotNull()
    return present


def _empty(df: DataFrame, schema) -> DataFrame:
    return df.sparkSession.createDataFrame([], schema)


# --- orders ------------------------------------------------------------------


def typed_orders(
    df: DataFrame, extra: dict[str, Column] | None = None, date_format: str | Sequence[str] = ISO_DATE
) -> DataFrame:
    """Orders with typed columns; what cannot be read is null."""
    missing = [c for c in S.MANDATORY_ORDER_COLUMNS if c not in df.columns]
    if missing:
        raise ValueError(f"orders lack mandatory columns {missing}")
    return df.select(
        *[integer_column(df, c).alias(c) for c in ("order_id", "customer_id", "product_id", "quantity")],
        date_column(df, "order_date", date_format, list((extra or {}).values())).alias("order_date"),
        F.lower(text_or_default(df, "status", S.DEFAULT_STATUS)).alias("status"),
        *[c.alias(n) for n, c in (extra or {}).items()],
    )


def clean_orders(
    df: DataFrame, order_by: Sequence[str] | None = None, date_format: str | Sequence[str] = ISO_DATE
) -> DataFrame:
    """Drop rows without readable keys, quantity or date, then keep the first row per order."""
    seq = _order_columns(df, order_by)
    valid = typed_orders(df, seq, date_format).filter(_all_present(S.MANDATORY_ORDER_COLUMNS))
    return keep_first(valid, ["order_id"], list(seq)).select(*S.CLEAN_ORDERS.names)


# --- customers ---------------------------------------------------------------


def clean_customers(
    df: DataFrame, order_by: Sequence[str] | None = None, date_format: str | Sequence[str] = ISO_DATE
) -> DataFrame:
    """Defaults and text normalisation per column, first row per customer."""
    if "customer_id" not in df.columns:
        return _empty(df, S.CLEAN_CUSTOMERS)
    seq = _order_columns(df, order_by)
    signup = (
        date_column(df, "signup_date", date_format, list(seq.values()))
        if "signup_date" in df.columns
        else F.lit(None).cast("date")
    )
    typed = df.select(
        integer_column(df, "customer_id").alias("customer_id"),
        *[F.col(c) for c in ("name", "email", "location") if c in df.columns],
        signup.alias("signup_date"),
        *[c.alias(n) for n, c in seq.items()],
    )
    first = keep_first(typed.filter(_all_present(["customer_id"])), ["customer_id"], list(seq))
    # Text work comes after the dedupe: once per customer kept, not once per raw row.
    return first.select(
        "customer_id",
        title_case(text_or_default(first, "name", S.DEFAULT_NAME)).alias("name"),
        F.lower(text_or_default(first, "email", S.DEFAULT_EMAIL)).alias("email"),
        text_or_default(first, "location", S.DEFAULT_LOCATION).alias("location"),
        "signup_date",
    )


# --- products ----------------------------------------------------------------


def price_counts(products: DataFrame) -> DataFrame:
    """How often each (category, price) occurs: the only scan and shuffle the medians need."""
    return products.groupBy("category", "price").agg(F.count("*").alias("n"))


def category_medians(counts: DataFrame) -> DataFrame:
    """``category``, ``median``; null categories and null prices take no part."""
    return weighted_medians(counts, ["category"], "price", "n")


def overall_median(
    counts: DataFrame,
    by_category: DataFrame,
    keep_price_for_null_category: bool = False,
) -> DataFrame:
    """One row ``median``: the median of the price column after the category fill.

    The filled column is the priced rows plus, per category, its median once for
    every unpriced row, so it too comes from the counts.
    """
    if not keep_price_for_null_category:
        counts = counts.filter(F.col("category").isNotNull())
    priced = counts.filter(F.col("price").isNotNull()).select("price", "n")
    unpriced = counts.filter(F.col("price").isNull()).select("category", "n")
    filled = priced.unionByName(unpriced.join(by_category, "category").select(F.col("median").alias("price"), "n"))
    filled = filled.withColumn("all_rows", F.lit(0))
    return weighted_medians(filled, ["all_rows"], "price", "n").select("median")


def fill_prices(
    products: DataFrame, keep_price_for_null_category: bool = False, counts: DataFrame | None = None
) -> DataFrame:
    """Fill null prices with the median of the raw category, then with the overall median; round to 2.

    A row without a category comes out of the first step without a price, even a
    priced one; ``keep_price_for_null_category=True`` keeps it instead.

    The counts and the medians are small tables, written first (three jobs).
    The fill itself is then one pass over the products: the medians' file size lets
    Spark broadcast them, and if there are too many it joins by shuffle. ``counts``:
    :func:`price_counts` of these products, if they are at hand.
    """
    if counts is None:
        counts = materialize(price_counts(products), "price-counts")
    by_category = materialize(category_medians(counts), "category-medians")
    overall = overall_median(counts, by_category, keep_price_for_null_category)
    medians = materialize(
        by_category.withColumn("overall", F.lit(False)).unionByName(
            overall.select(F.lit(None).cast("string").alias("category"), "median", F.lit(True).alias("overall"))
        ),
        "medians",
    )
    of_category = medians.filter(~F.col("overall")).select("category", "median")
    of_all = medians.filter("overall").select("median").scalar()
    own = F.col("price") if keep_price_for_null_category else F.when(F.col("category").isNotNull(), F.col("price"))
    return (
        products.join(of_category, "category", "left")
        .withColumn("price", round_half_even_2(F.coalesce(own, F.col("median"), of_all)))
        .select(*products.columns)
    )


def typed_products(df: DataFrame, extra: dict[str, Column] | None = None) -> DataFrame:
    """Products with a typed key and price (text as it came); rows without a key are gone."""
    return df.select(
        integer_column(df, "product_id").alias("product_id"),
        *[F.col(c) for c in ("product_name", "category", "supplier") if c in df.columns],
        *([number_column(df, "price").alias("price")] if "price" in df.columns else []),
        *[c.alias(n) for n, c in (extra or {}).items()],
    ).filter(_all_present(["product_id"]))


def clean_products(
    df: DataFrame, order_by: Sequence[str] | None = None, keep_price_for_null_category: bool = False
) -> DataFrame:
    """Price fill over all rows, defaults, first row per product."""
    if "product_id" not in df.columns:
        return _empty(df, S.CLEAN_PRODUCTS)
    seq = _order_columns(df, order_by)
    typed = typed_products(df, seq)
    if "price" in df.columns and "category" in df.columns:
        typed = fill_prices(typed, keep_price_for_null_category)
    elif "price" in df.columns:
        typed = typed.withColumn("price", round_half_even_2(F.coalesce("price", F.lit(0.0))))
    else:
        typed = typed.withColumn("price", F.lit(0.0))
    first = keep_first(typed, ["product_id"], list(seq))
    return first.select(
        "product_id",
        text_or_default(first, "product_name", S.DEFAULT_PRODUCT_NAME).alias("product_name"),
        title_case(text_or_default(first, "category", S.DEFAULT_CATEGORY)).alias("category"),
        "price",
        text_or_default(first, "supplier", S.DEFAULT_SUPPLIER).alias("supplier"),
    )


# --- metric ------------------------------------------------------------------


def rows_removed(raw: dict[str, DataFrame], date_format: str | Sequence[str] = ISO_DATE) -> DataFrame:
    """Rows in, kept and removed per table, each in one pass.

    Keep-first leaves one row per valid key, so the rows kept are the distinct
    valid keys; no deduplicated table has to be built for the metric.
    """
    orders = typed_orders(raw["orders"], date_format=date_format)
    keyed = {
        "orders": orders.select(F.when(_all_present(S.MANDATORY_ORDER_COLUMNS), F.col("order_id")).alias("key")),
        "customers": raw["customers"].select(integer_column(raw["customers"], "customer_id").alias("key")),
        "products": raw["products"].select(integer_column(raw["products"], "product_id").alias("key")),
    }
    parts = [
        df.agg(F.count("*").alias("rows_in"), F.count_distinct("key").alias("rows_kept")).select(
            F.lit(name).alias("table_name"),
            "rows_in",
            "rows_kept",
            (F.col("rows_in") - F.col("rows_kept")).alias("rows_removed"),
        )
        for name, df in keyed.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
