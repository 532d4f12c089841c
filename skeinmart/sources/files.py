"""CSV and Parquet readers for the raw and star zones."""

from __future__ import annotations

import csv
import hashlib
import os
from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce
from glob import glob
from multiprocessing.pool import ThreadPool

from py4j.protocol import Py4JError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import null_tokens_to_null
from ..operators.clean import INGEST_ORDER
from ..operators.star import StarTables
from ..schemas import RAW_SCHEMAS, STAR_SCHEMAS, STAR_TABLES, all_string
from ..session import fresh_dir

_NO_PATH = "PATH_NOT_FOUND"


def _or_empty(read, empty, on_missing: str, on_error: str) -> DataFrame:
    """Run a reader; a missing path or an unreadable file raises or gives an empty frame."""
    for name, value in (("on_missing", on_missing), ("on_error", on_error)):
        if value not in ("empty", "raise"):
            raise ValueError(f"{name} must be 'empty' or 'raise', not {value!r}")
    try:
        df = read()
        if on_error == "empty":
            # Reading is lazy, so a damaged file only shows when its rows are read.
            df.write.format("noop").mode("overwrite").save()
        return df
    except AnalysisException as e:
        if e.getCondition() != _NO_PATH and on_error == "raise":
            raise
        if e.getCondition() == _NO_PATH and on_missing == "raise":
            raise FileNotFoundError(str(e)) from e
        return empty()
    except (PySparkException, Py4JError):  # a failing task surfaces as the latter
        if on_error == "raise":
            raise
        return empty()


def with_ingest_order(df: DataFrame) -> DataFrame:
    """Add the order of rows on disk: file time, file, offset of the split, row in the split.

    Stable for a fixed set of files however they are packed into tasks. Files
    appended later sort after the earlier ones.
    """
    time, path, offset, row = INGEST_ORDER
    return df.select(
        *df.columns,
        F.col("_metadata.file_modification_time").alias(time),
        F.col("_metadata.file_path").alias(path),
        F.col("_metadata.file_block_start").alias(offset),
        F.monotonically_increasing_id().alias(row),
    )


def _by_header(spark: SparkSession, path: str) -> list[tuple[list[str], T.StructType | None]]:
    """The files of a path in groups of one header each, with its columns, so that every column is read under its own name.

    The first line of each file is read through the file system, many at a time: no Spark job a
    file. Fails if a header lacks all the others' names.
    """
    files = sorted(spark.read.text(path).inputFiles())
    if len(files) < 2:
        return [([path], None)]
    lines = _first_lines(spark, files)
    groups: dict[tuple, list[str]] = {}
    for file, line in zip(files, lines):
        if line:  # an empty file has none
            groups.setdefault(tuple(next(csv.reader([line]))), []).append(file)
    if not groups:
        return [([path], None)]
    for header in groups:
        if not any(set(header) & set(other) for other in groups if other != header) and len(groups) > 1:
            raise ValueError(f"a file of {path} has a header that shares no column with the others: {list(header)}")
    if len(groups) == 1 and all(lines):
        return [([path], _text_schema(next(iter(groups))))]  # one listing of a folder, not one look at each file
    return [([_decoded(spark, f) for f in found], _text_schema(header)) for header, found in groups.items()]


def _text_schema(header: tuple[str, ...]) -> T.StructType | None:
    """The header's columns as text; None where Spark would rename one (it then reads the header itself)."""
    plain = all(header) and len({h.lower() for h in header}) == len(header) and not header[0].startswith("\ufeff")
    return all_string(list(header)) if plain else None


def _decoded(spark: SparkSession, uri: str) -> str:
    jvm = spark._jvm
    return jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(uri)).toString()


def _first_lines(spark: SparkSession, files: list[str]) -> list[str]:
    """The first line of each file that is not blank, unpacked where its name says so; empty if there is none."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)

    def first(uri: str) -> str:
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(uri))
        codec, stream = codecs.getCodec(path), path.getFileSystem(conf).open(path)
        try:
            lines = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, "UTF-8"))
            line = lines.readLine()
            while line is not None and (not line.strip() or line.count('"') % 2):
                more = lines.readLine()
                if more is None:
                    break
                line = more if not line.strip() else f"{line}\n{more}"
            return line or ""
        finally:
            stream.close()

    with ThreadPool(min(16, len(files))) as pool:
        return pool.map(first, files)


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    dtype_overrides: Mapping[str, str] | None = None,
    null_tokens: bool = True,
    ingest_order: bool = False,
    multi_line: bool = False,
    on_missing: str = "empty",
    on_error: str = "raise",
    empty_order: bool = True,
) -> DataFrame:
    """CSV with a header row. Every column is text unless ``dtype_overrides`` names a type.

    Column names come from the header, so optional columns may be absent and the
    order is free; there is no inference pass. ``schema`` is the shape of the
    empty frame given back for a missing file. ``multi_line`` allows line breaks in
    quoted fields, at the price that one file is then read by one task.
    """

    # escape='"': quotes inside a quoted field are doubled. enforceSchema=False: a file whose
    # header is not the one it is read with is an error, never a shift of its columns.
    options = {"header": True, "escape": '"', "multiLine": multi_line, "enforceSchema": False}

    def read() -> DataFrame:
        parts = []
        for found, columns in _by_header(spark, path):
            reader = spark.read.options(**options)
            parts.append((reader.schema(columns) if columns is not None else reader).csv(found))
        if ingest_order:
            parts = [with_ingest_order(df) for df in parts]
        df = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
        if null_tokens:
            df = null_tokens_to_null(df)
        for name, dtype in (dtype_overrides or {}).items():
            df = df.withColumn(name, F.col(name).cast(dtype))
        return df

    fields = list(schema or [])
    if ingest_order and empty_order:
        kinds = (T.TimestampType(), T.StringType(), T.LongType(), T.LongType())
        fields += [T.StructField(name, kind) for name, kind in zip(INGEST_ORDER, kinds)]
    return _or_empty(read, lambda: spark.createDataFrame([], T.StructType(fields)), on_missing, on_error)


def read_csv_checked(
    spark: SparkSession, path: str, schema: T.StructType | None = None, null_tokens: bool = True, skip_unreadable: bool = True
) -> tuple[DataFrame, DataFrame]:
    """The good rows of a CSV path, as :func:`read_csv` gives them, and the damaged ones as (file_path, line).

    A row is damaged if it does not have as many fields as its file's header. One scan writes both
    to the shared folder; the damaged lines stay there as quarantine. ``skip_unreadable``: of a
    file that cannot be read on, such as a torn archive, the rows before that place stay and no
    other file is lost.
    """
    bad = "__line"
    options = {"header": True, "escape": '"', "enforceSchema": False, "columnNameOfCorruptRecord": bad, "ignoreCorruptFiles": skip_unreadable}
    parts = []
    for found, columns in _by_header(spark, path):
        columns = columns or spark.read.options(header=True, escape='"').csv(found).schema
        part = spark.read.options(**options).schema(T.StructType([*columns, T.StructField(bad, T.StringType())])).csv(found)
        parts.append(with_ingest_order(part))
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    folder = fresh_dir(spark, "checked-csv")
    rows.withColumn("__damaged", F.col(bad).isNotNull()).write.partitionBy("__damaged").parquet(folder)
    back = spark.read.schema(T.StructType([*rows.schema, T.StructField("__damaged", T.BooleanType())])).parquet(folder)
    good = back.where(~F.col("__damaged")).drop(bad, "__damaged")
    good = null_tokens_to_null(good) if null_tokens else good
    absent = [f for f in schema or [] if f.name not in good.columns and f.name != bad]
    good = good.withColumns({f.name: F.lit(None).cast(f.dataType) for f in absent}) if absent else good
    return good, back.where("__damaged").select(F.col(INGEST_ORDER[1]).alias("file_path"), F.col(bad).alias("line"))


def read_table(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    schema: T.StructType | None = None,
    on_missing: str = "empty",
    on_error: str = "raise",
) -> DataFrame:
    """A stored table directory; columns and types are in the files (or in ``schema``)."""

    def read() -> DataFrame:
        reader = spark.read.format(fmt)
        if schema is not None:
            reader = reader.schema(schema)
        if fmt == "csv":
            reader = reader.option("header", True).option("escape", '"')
        return reader.load(path)

    return _or_empty(read, lambda: spark.createDataFrame([], schema or T.StructType([])), on_missing, on_error)


def extract_raw(
    spark: SparkSession,
    raw_dir: str,
    table: str,
    files: Mapping[str, str] | None = None,
    on_missing: str = "empty",
    on_error: str = "raise",
) -> DataFrame:
    """One raw table with its ingest order. The path defaults to ``<raw_dir>/<table>.csv``.

    A missing table is empty. Missing orders come without an ingest order, so that
    cleaning them is an error and no run ends with an empty fact.
    """
    name = (files or {}).get(table, f"{table}.csv")
    return read_csv(
        spark, f"{raw_dir}/{name}", RAW_SCHEMAS[table], ingest_order=True, on_missing=on_missing, on_error=on_error,
        empty_order=table != "orders",
    )


def extract_orders(spark: SparkSession, raw_dir: str, **options) -> DataFrame:
    return extract_raw(spark, raw_dir, "orders", **options)


def extract_customers(spark: SparkSession, raw_dir: str, **options) -> DataFrame:
    return extract_raw(spark, raw_dir, "customers", **options)


def extract_products(spark: SparkSession, raw_dir: str, **options) -> DataFrame:
    return extract_raw(spark, raw_dir, "products", **options)


def extract_all(spark: SparkSession, raw_dir: str, **options) -> dict[str, DataFrame]:
    return {
        "orders": extract_orders(spark, raw_dir, **options),
        "customers": extract_customers(spark, raw_dir, **options),
        "products": extract_products(spark, raw_dir, **options),
    }


def read_star_table(spark: SparkSession, zone: str, name: str, fmt: str = "parquet") -> DataFrame:
    """One star table of a zone with its contract schema; a missing one raises."""
    return read_table(spark, f"{zone}/{name}", fmt, STAR_SCHEMAS[name], on_missing="raise")


def read_star(spark: SparkSession, zone: str, fmt: str = "parquet", unique_keys: bool = False) -> StarTables:
    """The four star tables. For ``unique_keys`` see :class:`StarTables`."""
    return StarTables({name: read_star_table(spark, zone, name, fmt) for name in STAR_TABLES}, unique_keys)


def register_views(tables: Mapping[str, DataFrame]) -> None:
    """Make tables available to ``spark.sql`` under their own names."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def get_table(spark: SparkSession, table: str, zone: str, fmt: str = "parquet") -> DataFrame | None:
    """A table by name and zone folder, or None when it does not exist."""
    try:
        return read_table(spark, f"{zone}/{table}", fmt, STAR_SCHEMAS.get(table), on_missing="raise")
    except FileNotFoundError:
        return None


def preview(df: DataFrame, n: int = 100) -> DataFrame:
    """The first rows, for looking at a table."""
    return df.limit(n)


@dataclass(frozen=True)
class FilesState:
    """What a listing says about some files; equal states mean unchanged files."""

    files: int
    size: int
    digest: str  # of every file's path, size and time of change


def _on_this_disk(spark: SparkSession, path: str) -> bool:
    default = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///")
    return path.startswith("/") and default.startswith("file:") and os.path.exists(path)


def files_state(spark: SparkSession, paths: list[str]) -> FilesState:
    """Count, bytes and a digest of the files under some paths. Lists them, reads none."""
    if all(_on_this_disk(spark, p) for p in paths):  # local folders need no job
        found = [f for p in paths for f in ([p] if os.path.isfile(p) else glob(f"{p}/**/*", recursive=True))]
        stats = sorted((f, os.stat(f)) for f in found if os.path.isfile(f))
        each = "\n".join(f"{f} {s.st_size} {s.st_mtime_ns}" for f, s in stats)
        return FilesState(len(stats), sum(s.st_size for _, s in stats), hashlib.sha256(each.encode()).hexdigest())
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths)
    each = F.xxhash64("path", "length", "modificationTime")
    row = listing.agg(F.count("*"), F.sum("length"), F.bit_xor(each).cast("string")).first()
    return FilesState(row[0], row[1] or 0, row[2] or "")
