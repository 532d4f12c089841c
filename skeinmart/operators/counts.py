"""Row counts over a set of tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``table_name``, ``row_count``: one row per table, counted in one job."""
    out = None
    for name, df in tables.items():
        part = df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise ValueError("no tables given")
    return out


def with_total(counts: DataFrame) -> DataFrame:
    """Append the sum over all tables as ``total``. Counts once: the sum is a rollup level."""
    return (
        counts.rollup("table_name")
        .agg(F.sum("row_count").alias("row_count"), F.grouping_id().alias("lvl"))
        .select(F.when(F.col("lvl") == 1, F.lit("total")).otherwise(F.col("table_name")).alias("table_name"), "row_count")
    )
