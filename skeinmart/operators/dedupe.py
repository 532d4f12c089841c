"""First row per key in ingest order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_RANK = "__first_rank"


def keep_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Keep the earliest row of each key.

    Spark turns the ``row_number() = 1`` filter into a group limit *before* the
    shuffle: each map task sends one row per key, however often a hot key repeats.
    ``order_by`` must be unique within a key; Spark files have no row order of
    their own.
    """
    first = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn(_RANK, F.row_number().over(first)).filter(F.col(_RANK) == 1).drop(_RANK)
