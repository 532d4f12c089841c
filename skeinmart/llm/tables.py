"""Reading the corpus tables, and small helpers that several operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(id_col: str, folds: int) -> Column:
    """Remainder of crc32 of the id as text; null for a null id."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(folds))


def whole_text(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def row_keys(id_col: str = "doc_id", text_col: str = "text") -> list[Column]:
    """Identity of a row through a shuffle: its id (never null) and a hash of its text.

    Rows that agree in both are repeats of each other, and get equal results.
    """
    return [
        F.coalesce(F.col(id_col).cast("long"), F.lit(-(2**63))).alias("k_id"),
        F.xxhash64(whole_text(text_col)).alias("k_text"),
    ]


def unused_name(df: DataFrame, base: str) -> str:
    """A column name that the frame doesn't have (names differ by more than case)."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def quoted(df: DataFrame) -> list[Column]:
    """The frame's columns by name, whatever signs the names hold."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def binary_list(column: pa.Array) -> list[bytes]:
    return column.cast(pa.binary()).to_pylist()


def slices(sizes: list[int], limit: int) -> Iterator[tuple[int, int]]:
    """Consecutive index ranges whose sizes sum to about ``limit``; a larger item stands alone."""
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def map_arrow(df: DataFrame, f: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """Apply ``f`` to every Arrow batch on the executors."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield from f(batch)

    return df.mapInArrow(run, schema)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str], rows: int = 100_000) -> Iterator[pa.Table]:
    """Regroup the batches of a sorted partition so that no group of equal keys is cut.

    A table has about ``rows`` rows, more only where one group is larger; the caller
    bounds the groups.
    """
    held: list[pa.RecordBatch] = []
    count = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        count += batch.num_rows
        if count < rows:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        same = np.ones(table.num_rows, bool)
        for k in keys:
            column = table.column(k).to_numpy()
            same &= column == column[-1]
        cut = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
        if cut:
            yield table.slice(0, cut)
        held = table.slice(cut).combine_chunks().to_batches()
        count = table.num_rows - cut
    if count:
        yield pa.Table.from_batches(held).combine_chunks()


def starts(*columns: np.ndarray) -> np.ndarray:
    """First index of each run of rows that agree in all columns."""
    change = np.zeros(len(columns[0]), bool)
    if len(change):
        change[0] = True
    for c in columns:
        change[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(change)


def union(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the trees of a[i] and b[i]; every node ends pointing at its root, the least index."""
    while True:
        ra, rb = parent[a], parent[b]
        apart = ra != rb
        if not apart.any():
            return
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(parent, np.maximum(ra, rb), np.minimum(ra, rb))
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent[:] = up
