"""Repeatable damage to a table: nulls in cells, repeated rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .rank_select import smallest_ids


def _digest(seed: str, draw: Column, row_id: Column) -> Column:
    return F.md5(F.concat_ws("|", F.lit(seed), draw, row_id))


def _cut(cuts: DataFrame, draw: str) -> Column:
    return cuts.filter(F.col("draw") == draw).select("cut").scalar()


def inject_nulls(df: DataFrame, rate: float, columns: Sequence[str], row_id: Column, seed: str = "42") -> DataFrame:
    """Set exactly ``int(rows * rate)`` cells to null in each column, drawn apart per column.

    The cells are those with the smallest md5 of (seed, column, row id). ``row_id``
    is unique text per row. The cut-off digests come from one counting pass, so no
    rank over the whole table is needed.
    """
    identified = df.select(row_id.cast("string").alias("__rid"))
    draws = identified.select("__rid", F.explode(F.array(*[F.lit(c) for c in columns])).alias("draw"))
    k = F.floor(F.col("total") * F.lit(float(rate)))
    # One row per column, used once per column: written so that it is drawn once.
    cuts = materialize(
        smallest_ids(draws, "draw", _digest(seed, F.col("draw"), F.col("__rid")), F.col("__rid"), k), "null-cuts"
    )
    rid = row_id.cast("string")

    def hit(name: str) -> Column:
        me = F.struct(_digest(seed, F.lit(name), rid).alias("h"), rid.alias("id"))
        return F.coalesce(me <= _cut(cuts, name), F.lit(False))

    return df.select(
        *[F.when(~hit(c), F.col(c)).alias(c) if c in set(columns) else F.col(c) for c in df.columns]
    )


def inject_duplicates(
    df: DataFrame, rate: float, row_id: Column, sequence: str, seed: str = "42"
) -> DataFrame:
    """Append copies of exactly ``int(rows * rate)`` rows; copies sort after every original row.

    ``sequence`` is the numeric ingest order: copies continue above its maximum.
    """
    rid = row_id.cast("string")
    draws = df.select(rid.alias("__rid")).withColumn("draw", F.lit("rows"))
    k = F.floor(F.col("total") * F.lit(float(rate)))
    cuts = smallest_ids(draws, "draw", _digest(seed, F.col("draw"), F.col("__rid")), F.col("__rid"), k)
    me = F.struct(_digest(seed, F.lit("rows"), rid).alias("h"), rid.alias("id"))
    top = df.agg(F.max(sequence)).scalar()
    copies = df.filter(F.coalesce(me <= _cut(cuts, "rows"), F.lit(False))).withColumn(
        sequence, F.col(sequence) + top + 1
    )
    return df.unionByName(copies)
