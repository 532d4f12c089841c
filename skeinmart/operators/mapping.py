"""Mapping an uploaded table onto a raw contract."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import UPLOAD_COLUMNS


def default_mapping(df: DataFrame, table: str) -> dict[str, str]:
    """Contract column -> uploaded column: the one of the same name, else the first."""
    return {c: c if c in df.columns else df.columns[0] for c in UPLOAD_COLUMNS[table]}


def map_columns(df: DataFrame, table: str, mapping: Mapping[str, str] | None = None) -> DataFrame:
    """Select and rename the mapped columns in contract order.

    ``mapping`` overrides single defaults. One source column may serve only once.
    """
    chosen = {**default_mapping(df, table), **(mapping or {})}
    unknown = [c for c in (mapping or {}) if c not in UPLOAD_COLUMNS[table]]
    if unknown:
        raise ValueError(f"not columns of {table}: {unknown}")
    sources = [chosen[c] for c in UPLOAD_COLUMNS[table]]
    repeated = sorted({s for s in sources if sources.count(s) > 1})
    if repeated:
        raise ValueError(f"source columns mapped more than once: {repeated}")
    return df.select(*[F.col(f"`{chosen[c]}`").alias(c) for c in UPLOAD_COLUMNS[table]])
