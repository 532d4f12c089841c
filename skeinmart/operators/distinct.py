"""Exact distinct counts that add up: bitmaps of dense keys, merged from month to quarter to year."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize

LEVELS = (("month", ["year", "quarter", "month"]), ("quarter", ["year", "quarter"]), ("year", ["year"]))


def monthly_bitmaps(fact: DataFrame, key: str) -> DataFrame:
    """year, quarter, month, bucket, bits: which keys a month has, 32,768 of them a bitmap of 4 KB.

    Built where the rows are and merged by month and bucket; a hot month is at most as many
    bitmaps as the keys have buckets. For whole-number keys that lie close together: a key that is alone in its bucket
    costs a bitmap. Null keys count for nothing.
    """
    month = F.floor(F.col("date_id") / 100).cast("int")
    return (
        fact.where(F.col(key).isNotNull())
        .groupBy(
            F.floor(month / 100).cast("int").alias("year"), F.ceil((month % 100) / 3).cast("int").alias("quarter"),
            (month % 100).alias("month"), F.bitmap_bucket_number(key).alias("bucket"),
        )
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(key)).alias("bits"))
    )


def merged(bitmaps: DataFrame, by: list[str]) -> DataFrame:
    """Bitmaps of coarser groups. No key is read or shuffled again, only bitmaps."""
    return bitmaps.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def counted(bitmaps: DataFrame, by: list[str]) -> DataFrame:
    return bitmaps.groupBy(*by).agg(F.sum(F.bitmap_count("bits")).alias("keys"))


def calendar_rollup(monthly: DataFrame) -> DataFrame:
    """level, year, quarter, month, keys: exact distinct counts of every month, quarter and year."""
    bitmaps, out = materialize(monthly, "bitmaps"), None
    for level, by in LEVELS:
        if level != "month":
            bitmaps = merged(bitmaps, by)
        part = counted(bitmaps, by)
        absent = {c: F.lit(None).cast("int") for c in ("quarter", "month") if c not in by}
        part = part.withColumns(absent).select(F.lit(level).alias("level"), "year", "quarter", "month", "keys")
        out = part if out is None else out.unionByName(part)
    return out
