"""Top-k, printed ranks and equal-width histograms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k(df: DataFrame, k: int, by: str, ties: Sequence[str]) -> DataFrame:
    """The k largest rows by one column; ``ties`` makes the choice repeatable.

    Each task keeps k rows (TakeOrderedAndProject), so k rows per task are sent.
    """
    return df.orderBy(F.col(by).desc(), *[F.col(t).asc() for t in ties]).limit(k)


def with_rank(top: DataFrame, by: str, ties: Sequence[str], name: str = "rank") -> DataFrame:
    """Number the rows of a top-k result 1..k. For small results only: the window is not partitioned."""
    order = Window.orderBy(F.col(by).desc(), *[F.col(t).asc() for t in ties])
    return top.withColumn(name, F.row_number().over(order))


def equal_width_histogram(df: DataFrame, value_cents: Column, bins: int = 30) -> DataFrame:
    """Counts per equal-width bin of a money column given in cents.

    ``bin`` runs from 1; the top value belongs to the last bin. Empty bins have no
    row. When all values are equal there is one bin.
    """
    values = df.select(value_cents.alias("v")).filter(F.col("v").isNotNull())
    span = values.agg(F.struct(F.min("v").alias("lo"), F.max("v").alias("hi")).alias("span")).scalar()
    placed = values.withColumn("span", span).select(
        (F.col("v") - F.col("span.lo")).cast("double").alias("above"),
        (F.col("span.hi") - F.col("span.lo")).cast("double").alias("width"),
        F.col("span.lo").alias("lo"),
    )
    position = F.coalesce(F.floor(F.try_divide(F.col("above") * bins, F.col("width"))), F.lit(0)) + 1
    placed = placed.withColumn("bin", F.least(position, F.lit(bins)).cast("int"))
    step = F.col("width") / bins
    return (
        placed.groupBy("bin", "lo", "width")
        .agg(F.count("*").alias("n"))
        .select(
            "bin",
            ((F.col("lo") + step * (F.col("bin") - 1)) / 100).alias("bin_start"),
            ((F.col("lo") + step * F.col("bin")) / 100).alias("bin_end"),
            "n",
        )
    )
