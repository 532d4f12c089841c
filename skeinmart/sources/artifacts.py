"""Reports, manifests and log files."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import level_filter
from ..schemas import LOG_LEVELS, MANIFEST_DDL, NESTED_REPORT_DDL, REPORT_SCHEMA
from .files import read_table


def write_report(report: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Replace the stored report. A handful of rows: one file."""
    writer = report.coalesce(1).write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True).option("escape", '"')
    writer.save(path)


def read_report(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame | None:
    """A stored report, or None when there is none."""
    try:
        return read_table(spark, path, fmt, REPORT_SCHEMA, on_missing="raise")
    except FileNotFoundError:
        return None


def read_manifests(spark: SparkSession, path: str) -> DataFrame:
    """Run manifests, one JSON object per file, with the name of the file."""
    return (
        spark.read.schema(MANIFEST_DDL)
        .option("recursiveFileLookup", True)
        .json(path, multiLine=True)
        .withColumn("file_name", F.col("_metadata.file_name"))
    )


def manifest_steps(manifests: DataFrame) -> DataFrame:
    """One row per run and step."""
    return manifests.select("timestamp", "status", "mode", F.explode("steps").alias("step", "s")).select(
        "timestamp",
        F.col("status").alias("run_status"),
        "mode",
        "step",
        F.col("s.status").alias("step_status"),
        F.col("s.duration").alias("duration"),
        F.col("s.row_counts").alias("row_counts"),
    )


def manifest_row_counts(manifests: DataFrame) -> DataFrame:
    """One row per run, step and table."""
    return manifest_steps(manifests).select(
        "timestamp", "step", F.explode("row_counts").alias("table_name", "row_count")
    )


def read_nested_report(spark: SparkSession, path: str) -> DataFrame:
    """A nested quality report as one row per check. The tables are the keys of the object."""
    whole = spark.read.text(path, wholetext=True).select(F.from_json("value", NESTED_REPORT_DDL).alias("r"))
    tables = whole.select(F.explode("r").alias("table", "t"))
    checks = tables.select(
        "table",
        F.col("t.success").alias("table_success"),
        "t.statistics.success_percent",
        F.explode("t.results").alias("c"),
    )
    return checks.select(
        "table",
        F.col("c.check").alias("check"),
        F.col("c.success").alias("success"),
        F.col("c.message").alias("message"),
        "table_success",
        "success_percent",
    )


def read_logs(spark: SparkSession, path: str, names: str = "*.log", recursive: bool = False) -> DataFrame:
    """Lines of all log files: ``file_name``, ``file_path``, ``line_no`` (from 1, in its file), ``value``.

    Lines are counted in each split of a file, and a split's first number follows from the counts
    of the splits before it: no task needs more than one split of a file.
    """
    reader = spark.read.option("pathGlobFilter", names).option("recursiveFileLookup", recursive)
    meta = [F.col(f"_metadata.{c}") for c in ("file_name", "file_path", "file_block_start")]
    lines = reader.text(path).select(*meta, F.monotonically_increasing_id().alias("nth"), "value")
    split = ["file_path", "file_block_start"]
    earlier = Window.partitionBy("file_path").orderBy("file_block_start").rowsBetween(Window.unboundedPreceding, -1)
    counts = lines.groupBy(*split).agg(F.count("*").alias("n"))
    before = counts.select(*split, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    here = F.row_number().over(Window.partitionBy(*split).orderBy("nth"))
    numbered = lines.withColumn("here", here).join(before, split)
    return numbered.select("file_name", "file_path", (F.col("before") + F.col("here")).alias("line_no"), "value")


def put_note(spark: SparkSession, path: str, note: dict) -> None:
    """A small JSON file on any file system that Spark reaches, replaced if it is there."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = at.getFileSystem(spark._jsc.hadoopConfiguration()).create(at, True)
    stream.write(bytearray(json.dumps(note).encode()))
    stream.close()


def get_note(spark: SparkSession, path: str) -> dict | None:
    """The note at a path; None if there is none, or one that was not written to its end."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(at):
        return None
    stream = fs.open(at)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    except json.JSONDecodeError:
        return None
    finally:
        stream.close()


def log_files(logs: DataFrame) -> DataFrame:
    """Log file names, newest name first."""
    return logs.select("file_name").distinct().orderBy(F.desc("file_name"))


def filter_logs(logs: DataFrame, levels: list[str] | None = None) -> DataFrame:
    """Lines that name any of the levels (all known levels by default)."""
    return logs.filter(level_filter(F.col("value"), LOG_LEVELS if levels is None else levels))
