"""The raw and the star zone of a test-table folder, written once and then read by every query.

The raw zone stands for the files a shop would deliver: the source tables mapped to
dirty text. The star zone is the pipeline's transform of it.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession

from ..operators.star import StarTables
from ..session import fresh_dir, limit_splits, shared_dir, size_shuffles
from ..sources import testbed
from ..sources.files import files_state, read_star
from ..sources.warehouse import write_table
from .pipeline import transform_to_zone

# Bytes that a byte of the packed source tables takes up as rows that are sorted: about 14 bytes of
# Parquet make one raw order of 150 and more, and a sort must not fill a task's memory.
_UNPACKED = 32

_lock = threading.RLock()
_zones: dict[tuple, str] = {}


def _state(spark: SparkSession, sf_dir: str) -> tuple:
    """Changes when the session or a source file changes."""
    paths = [f"{sf_dir}/{t}.parquet" for t in testbed.SOURCE_TABLES]
    files = files_state(spark, paths)
    size_shuffles(spark, files.size * _UNPACKED)
    limit_splits(spark)
    return spark.sparkContext.applicationId, sf_dir, files


def _raw_zone(spark: SparkSession, sf_dir: str, state: tuple) -> str:
    with _lock:
        key = ("raw", shared_dir(spark), *state)
        if key not in _zones:
            zone = fresh_dir(spark, "raw")
            for name, df in testbed.raw_tables(spark, sf_dir).items():
                write_table(df, f"{zone}/{name}")
            _zones[key] = zone
        return _zones[key]


def _star_zone(spark: SparkSession, sf_dir: str, state: tuple) -> str:
    with _lock:
        key = ("star", shared_dir(spark), *state)
        if key not in _zones:
            raw = _read_raw(spark, _raw_zone(spark, sf_dir, state))
            zone = fresh_dir(spark, "star")
            transform_to_zone(spark, raw, zone, testbed.ORDER_BY)
            _zones[key] = zone
        return _zones[key]


def _read_raw(spark: SparkSession, zone: str) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{zone}/{name}") for name in testbed.RAW_SQL}


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return _read_raw(spark, _raw_zone(spark, sf_dir, _state(spark, sf_dir)))


def star_tables(spark: SparkSession, sf_dir: str) -> StarTables:
    """The transform keeps one row per key, so the tables are read as such."""
    return read_star(spark, _star_zone(spark, sf_dir, _state(spark, sf_dir)), unique_keys=True)
