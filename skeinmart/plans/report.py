"""The short report as text: one ``line`` per row, in printing order.

Only results of a few rows are formatted.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.display import dollars_padded, pad_left, pad_right, thousands, two_digits
from . import analytics

Star = Mapping[str, DataFrame]

# The printed order of the tables.
TABLE_ORDER = ["fact_orders", "dim_customers", "dim_products", "dim_date"]


def _lines(df: DataFrame, order: list[Column], *parts: Column | str) -> DataFrame:
    text = F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    position = F.row_number().over(Window.orderBy(*order))  # a handful of rows
    return df.select(position.alias("position"), text.alias("line"))


def text_report(star: Star) -> dict[str, DataFrame]:
    """Section title -> lines."""
    c = F.col
    tables = F.array_position(F.array(*[F.lit(t) for t in TABLE_ORDER]), c("table_name"))
    return {
        "TABLE ROW COUNTS": _lines(
            analytics.table_counts(star), [tables], "  ", c("table_name"), ": ", thousands(c("row_count")), " rows"
        ),
        "TOP 5 REVENUE MONTHS": _lines(
            analytics.top_months(star), [F.desc("revenue"), c("year"), c("month")],
            "  ", c("year").cast("string"), "-", two_digits(c("month")), " (", pad_left(c("month_name"), 9), "): ",
            pad_left(c("orders"), 4), " orders, ", dollars_padded(c("revenue"), 12),
        ),
        "TOP 10 PRODUCTS BY REVENUE": _lines(
            analytics.top_products_ranked(star), [c("rank")],
            "  ", pad_left(c("rank"), 2), ". ", pad_right(c("product_name"), 35), " (", pad_right(c("category"), 18), ") ",
            dollars_padded(c("rev"), 10),
        ),
        "TOP 5 CUSTOMERS BY LIFETIME VALUE": _lines(
            analytics.top_customers(star), [F.desc("clv"), c("name")],
            "  ", pad_right(c("name"), 25), " (", pad_right(c("location"), 20), ") ", pad_left(c("orders"), 3),
            " orders, ", dollars_padded(c("clv"), 10), " CLV",
        ),
        "REVENUE BY CATEGORY": _lines(
            analytics.category_revenue(star), [F.desc("revenue"), c("category")],
            "  ", pad_right(c("category"), 20), ": ", pad_left(c("orders"), 4), " orders, ", dollars_padded(c("revenue"), 12),
        ),
        "ORDER STATUS BREAKDOWN": _lines(
            analytics.status_counts(star), [F.desc("cnt"), c("order_status")],
            "  ", pad_right(c("order_status"), 12), ": ", pad_left(c("cnt"), 5), " orders, ", dollars_padded(c("rev"), 12),
        ),
    }
