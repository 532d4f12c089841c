"""Exact order statistics without sorting a whole group in one task.

A group is first counted into buckets that follow the sort order. The running
count over the buckets tells which bucket holds the wanted rank; only the rows of
that bucket are then ordered. The number of buckets has a fixed bound, so no task
sees a group whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

_PER_OCTAVE = 1024
_OFFSET = 1 << 21


def value_bucket(v: Column) -> Column:
    """Order-keeping bucket of a finite DOUBLE, 1024 per power of two.

    log2 of a double lies in [-1074, 1024], so there are at most 2 * 2**21 + 1
    buckets, and one bucket spans less than 0.1 % of its value.
    """
    magnitude = F.floor(F.log2(F.abs(v)) * _PER_OCTAVE) + F.lit(_OFFSET)
    return F.when(v == 0, F.lit(0)).when(v > 0, magnitude).otherwise(-magnitude).cast("bigint")


def with_running_total(df: DataFrame, groups: Sequence[str], order_by: str, weight: str) -> DataFrame:
    """Add ``total`` of the group and ``below``, the weight of all earlier rows."""
    whole = Window.partitionBy(*groups)
    upto = whole.orderBy(order_by).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumns(
        {
            "below": F.sum(weight).over(upto) - F.col(weight),
            "total": F.sum(weight).over(whole.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
        }
    )


def weighted_medians(counted: DataFrame, groups: Sequence[str], value: str, weight: str) -> DataFrame:
    """Median per group of a table of (groups, value, weight).

    Equal values of a group are counted together first, so a bucket holds every value
    once, however often it occurs. Returns ``groups`` and ``median``. Null values and
    null groups are left out.
    """
    groups = list(groups)
    rows = (
        counted.na.drop(subset=groups + [value])
        .groupBy(*groups, F.col(value).alias("__v"))
        .agg(F.sum(weight).alias("__w"))
        .withColumn("__bucket", value_bucket(F.col("__v")))
    )
    low = F.floor((F.col("total") + 1) / 2)
    high = F.floor(F.col("total") / 2) + 1

    def covers(rank: Column, below: str, size: str) -> Column:
        return (F.col(below) < rank) & (rank <= F.col(below) + F.col(size))

    buckets = with_running_total(
        rows.groupBy(*groups, "__bucket").agg(F.sum("__w").alias("__bw")), groups, "__bucket", "__bw"
    )
    wanted = buckets.filter(covers(low, "below", "__bw") | covers(high, "below", "__bw")).select(
        *groups, "__bucket", low.alias("__low"), high.alias("__high"), F.col("below").alias("__before")
    )
    inside = Window.partitionBy(*groups, "__bucket").orderBy("__v")
    inside = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = rows.join(wanted, groups + ["__bucket"]).withColumn(
        "__start", F.col("__before") + F.sum("__w").over(inside) - F.col("__w")
    )
    middle = ranked.groupBy(*groups).agg(
        F.max(F.when(covers(F.col("__low"), "__start", "__w"), F.col("__v"))).alias("__lo"),
        F.max(F.when(covers(F.col("__high"), "__start", "__w"), F.col("__v"))).alias("__hi"),
    )
    return middle.select(*groups, ((F.col("__lo") + F.col("__hi")) / 2).alias("median"))


def smallest_ids(df: DataFrame, draw: str, digest: Column, row_id: Column, k: Column) -> DataFrame:
    """The k-th smallest (digest, row id) of each draw.

    ``digest`` is a hexadecimal hash, so its first four digits spread the rows
    over 65,536 even buckets. ``k`` may use ``total``, the row count of the draw.
    Returns ``draw``, ``cut`` (a struct of digest and row id); no row when k = 0. Runs a job.
    """
    rows = df.select(draw, digest.alias("__h"), row_id.alias("__id")).withColumn(
        "__bucket", F.substring("__h", 1, 4)
    )
    buckets = with_running_total(
        rows.groupBy(draw, "__bucket").agg(F.count("*").alias("__bw")), [draw], "__bucket", "__bw"
    )
    # One row per draw. Written first, so that its size is known and the rows below
    # are filtered by a broadcast instead of being shuffled to meet it.
    wanted = materialize(
        buckets.withColumn("__k", k)
        .filter((F.col("below") < F.col("__k")) & (F.col("__k") <= F.col("below") + F.col("__bw")))
        .select(draw, "__bucket", (F.col("__k") - F.col("below")).alias("__rest")),
        "wanted-buckets",
    )
    inside = Window.partitionBy(draw, "__bucket").orderBy("__h", "__id")
    return (
        rows.join(wanted, [draw, "__bucket"])
        .withColumn("__rank", F.row_number().over(inside))
        .filter(F.col("__rank") == F.col("__rest"))
        .select(draw, F.struct(F.col("__h").alias("h"), F.col("__id").alias("id")).alias("cut"))
    )
