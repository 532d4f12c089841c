"""Loading the star schema into a warehouse, and checking what arrived."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.counts import row_counts
from ..schemas import PRIMARY_KEYS, STAR_SCHEMAS
from .published import load_published

_WRITE_MODE = {"full": "overwrite", "incremental": "append"}
TARGETS = ("catalog", "path", "connector", "published")


def _write_mode(mode: str) -> str:
    if mode not in _WRITE_MODE:
        raise ValueError(f"unknown load mode {mode!r}, use 'full' or 'incremental'")
    return _WRITE_MODE[mode]


def write_table(df: DataFrame, path: str, mode: str = "overwrite", fmt: str = "parquet") -> None:
    """One table directory. CSV gets a header and doubled quotes."""
    writer = df.write.format(fmt).mode(mode)
    if fmt == "csv":
        writer = writer.option("header", True).option("escape", '"')
    writer.save(path)


def write_star(star: Mapping[str, DataFrame], zone: str, mode: str = "overwrite", fmt: str = "parquet") -> None:
    """The star tables as directories of a zone."""
    for name, df in star.items():
        write_table(df, f"{zone}/{name}", mode, fmt)


def create_tables(spark: SparkSession, database: str = "default", fmt: str = "parquet") -> None:
    """Empty star tables where they do not exist yet. Keys are checked by the quality suite."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, schema in STAR_SCHEMAS.items():
        columns = ", ".join(
            f"{f.name} {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}" for f in schema.fields
        )
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) USING {fmt}")


def drop_known(df: DataFrame, existing: DataFrame | None, pk: str) -> DataFrame:
    """Rows whose key the warehouse does not hold yet: a repeated append adds nothing."""
    return df if existing is None else df.join(existing.select(pk), pk, "left_anti").select(*df.columns)


def _existing(read) -> DataFrame | None:
    try:
        return read()
    except AnalysisException as e:
        if e.getCondition() in ("TABLE_OR_VIEW_NOT_FOUND", "PATH_NOT_FOUND"):
            return None
        raise


def load_catalog(
    star: Mapping[str, DataFrame],
    mode: str = "full",
    database: str = "default",
    fmt: str = "parquet",
    skip_known: bool = False,
) -> dict[str, DataFrame]:
    """Catalog tables: full replaces, incremental appends every row again (or only new keys)."""
    how = _write_mode(mode)
    out = {}
    for name, df in star.items():
        spark, table = df.sparkSession, f"{database}.{name}"
        if mode == "incremental" and skip_known:
            df = drop_known(df, _existing(lambda t=table, s=spark: s.table(t)), PRIMARY_KEYS[name])
        df.write.format(fmt).mode(how).saveAsTable(table)
        out[name] = spark.table(table)
    return out


def load_path(
    star: Mapping[str, DataFrame],
    warehouse: str,
    mode: str = "full",
    fmt: str = "parquet",
    skip_known: bool = False,
) -> dict[str, DataFrame]:
    """The same for table directories, where no catalog is at hand."""
    how = _write_mode(mode)
    out = {}
    for name, df in star.items():
        spark, path = df.sparkSession, f"{warehouse}/{name}"
        read = spark.read.schema(STAR_SCHEMAS[name]).format(fmt)
        if fmt == "csv":
            read = read.option("header", True).option("escape", '"')
        if mode == "incremental" and skip_known:
            df = drop_known(df, _existing(lambda r=read, p=path: r.load(p)), PRIMARY_KEYS[name])
        write_table(df, path, how, fmt)
        out[name] = read.load(path)
    return out


def load_connector(
    star: Mapping[str, DataFrame], mode: str = "full", fmt: str = "jdbc", table_option: str = "dbtable",
    prefix: str = "", options: Mapping[str, str] | None = None,
) -> dict[str, DataFrame]:
    """Any Spark data source, such as JDBC or a cloud warehouse connector on the class path."""
    how = _write_mode(mode)
    out = {}
    for name, df in star.items():
        settings = {**(options or {}), table_option: f"{prefix}{name}"}
        df.write.format(fmt).options(**settings).mode(how).save()
        out[name] = df.sparkSession.read.format(fmt).options(**settings).load()
    return out


def load_all(
    star: Mapping[str, DataFrame], target: str | None = None, mode: str | None = None, **options
) -> dict[str, DataFrame]:
    """Load into a target, by default the catalog in full mode. Returns the loaded tables."""
    target, mode = target or "catalog", mode or "full"
    if target == "catalog":
        return load_catalog(star, mode, **options)
    if target == "path":
        return load_path(star, mode=mode, **options)
    if target == "connector":
        return load_connector(star, mode, **options)
    if target == "published":
        return load_published(star, mode, **options)
    raise ValueError(f"unknown target {target!r}, use one of {', '.join(TARGETS)}")


def verify_load(loaded: Mapping[str, DataFrame], expected: Mapping[str, DataFrame]) -> DataFrame:
    """Rows in the warehouse next to rows expected, per table."""
    have = row_counts(loaded).withColumnRenamed("row_count", "loaded_rows")
    want = row_counts(expected).withColumnRenamed("row_count", "expected_rows")
    return have.join(want, "table_name").select(
        "table_name", "loaded_rows", "expected_rows", (F.col("loaded_rows") == F.col("expected_rows")).alias("matches")
    )


def save_upload(df: DataFrame, path: str, mode: str = "replace") -> None:
    """A mapped upload as raw CSV: replace the data, or append (creating it when absent)."""
    if mode not in ("replace", "append"):
        raise ValueError(f"unknown save mode {mode!r}, use 'replace' or 'append'")
    write_table(df, path, "overwrite" if mode == "replace" else "append", "csv")
