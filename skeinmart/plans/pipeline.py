"""The batch pipeline and its stages."""

from __future__ import annotations

import hashlib
import logging
import time
import traceback
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime, timezone
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import ISO_FORMATS
from ..operators import clean, star
from ..operators.counts import row_counts
from ..operators.quality import gate, validate_star
from ..schemas import MANIFEST_DDL, STAR_TABLES
from ..session import size_shuffles
from ..sources.artifacts import get_note, put_note, write_report
from ..sources.files import extract_all, files_state, read_star, read_star_table
from ..sources.warehouse import load_all, write_table

log = logging.getLogger(__name__)

OrderBy = Mapping[str, list[str]]


@dataclass
class Zones:
    """Folders of the layered zones."""

    raw: str
    transformed: str
    validated: str
    manifests: str | None = None


@dataclass(frozen=True)
class Cleaning:
    """How raw text is read: the accepted date formats per table, and the price of products without a category."""

    order_dates: str | Sequence[str] = ISO_FORMATS
    signup_dates: str | Sequence[str] = ISO_FORMATS
    keep_price_for_null_category: bool = False

    def orders(self, raw: Mapping[str, DataFrame], by: OrderBy) -> DataFrame:
        return clean.clean_orders(raw["orders"], by.get("orders"), self.order_dates)

    def customers(self, raw: Mapping[str, DataFrame], by: OrderBy) -> DataFrame:
        return clean.clean_customers(raw["customers"], by.get("customers"), self.signup_dates)

    def products(self, raw: Mapping[str, DataFrame], by: OrderBy) -> DataFrame:
        return clean.clean_products(raw["products"], by.get("products"), self.keep_price_for_null_category)


@dataclass
class RunResult:
    status: str
    steps: dict[str, dict[str, Any]] = field(default_factory=dict)
    total_duration: float = 0.0
    failed_checks: int = 0
    error: str | None = None


# --- transform ------------------------------------------------------------------


def clean_tables(
    raw: Mapping[str, DataFrame], order_by: OrderBy | None = None, cleaning: Cleaning = Cleaning()
) -> dict[str, DataFrame]:
    by = order_by or {}
    return {
        "orders": cleaning.orders(raw, by),
        "customers": cleaning.customers(raw, by),
        "products": cleaning.products(raw, by),
    }


def transform_all(
    raw: Mapping[str, DataFrame], order_by: OrderBy | None = None, cleaning: Cleaning = Cleaning()
) -> dict[str, DataFrame]:
    """The star tables as lazy frames."""
    cleaned = clean_tables(raw, order_by, cleaning)
    return {
        "dim_date": star.build_dim_date(cleaned["orders"]),
        "dim_customers": star.build_dim_customers(cleaned["customers"]),
        "dim_products": star.build_dim_products(cleaned["products"]),
        "fact_orders": star.build_fact_orders(cleaned["orders"], cleaned["products"]),
    }


def _write_counted(df: DataFrame, path: str, fmt: str) -> int:
    """Write a table; its row count comes from the same job."""
    seen = Observation()
    write_table(df.observe(seen, F.count("*").alias("n")), path, "overwrite", fmt)
    return seen.get["n"]


def transform_to_zone(
    spark: SparkSession,
    raw: Mapping[str, DataFrame],
    zone: str,
    order_by: OrderBy | None = None,
    fmt: str = "parquet",
    cleaning: Cleaning = Cleaning(),
) -> dict[str, int]:
    """Write the star tables; returns rows per table.

    Each table is computed once. The fact joins the *written* product table, whose
    file size decides between broadcast and shuffle, and the date dimension comes
    from the date keys of the written fact. The two dimensions are independent of
    each other and are written side by side.
    """
    by = order_by or {}
    counts: dict[str, int] = {}

    def customers() -> int:
        df = cleaning.customers(raw, by)
        return _write_counted(star.build_dim_customers(df), f"{zone}/dim_customers", fmt)

    def products() -> int:
        df = cleaning.products(raw, by)
        return _write_counted(star.build_dim_products(df), f"{zone}/dim_products", fmt)

    with ThreadPoolExecutor(max_workers=2) as pool:
        jobs = {"dim_customers": pool.submit(customers), "dim_products": pool.submit(products)}
        counts.update({name: job.result() for name, job in jobs.items()})

    def stored(name: str) -> DataFrame:
        return read_star_table(spark, zone, name, fmt)

    fact = star.build_fact_orders(cleaning.orders(raw, by), stored("dim_products"))
    counts["fact_orders"] = _write_counted(fact, f"{zone}/fact_orders", fmt)
    dates = star.build_dim_date_from_fact(stored("fact_orders"))
    counts["dim_date"] = _write_counted(dates, f"{zone}/dim_date", fmt)
    return {name: counts[name] for name in STAR_TABLES}


# --- stages ---------------------------------------------------------------------
# Each stage reads what the one before wrote, so a scheduler may run them apart.


def stage_extract(spark: SparkSession, zones: Zones, **options) -> dict[str, int]:
    """Rows per raw table."""
    return _counted(extract_all(spark, zones.raw, **options))


def _counted(tables: Mapping[str, DataFrame]) -> dict[str, int]:
    return {r["table_name"]: r["row_count"] for r in row_counts(tables).collect()}  # one row per table


def stage_transform(
    spark: SparkSession,
    zones: Zones,
    raw: Mapping[str, DataFrame] | None = None,
    order_by: OrderBy | None = None,
    fmt: str = "parquet",
    cleaning: Cleaning = Cleaning(),
) -> dict[str, int]:
    return transform_to_zone(spark, raw or extract_all(spark, zones.raw), zones.transformed, order_by, fmt, cleaning)


def stage_validate(spark: SparkSession, zones: Zones, gate_mode: str = "fail", fmt: str = "parquet") -> int:
    """Write the report, then apply the gate to the written report. Returns the failed checks."""
    path = f"{zones.validated}/validation_report"
    write_report(validate_star(read_star(spark, zones.transformed, fmt)), path)
    return gate(spark.read.parquet(path), gate_mode)


def stage_load(
    spark: SparkSession,
    zones: Zones,
    target: str | None = None,
    mode: str | None = None,
    fmt: str = "parquet",
    **options,
) -> dict[str, DataFrame]:
    return load_all(read_star(spark, zones.transformed, fmt), target, mode, **options)


# --- the whole run --------------------------------------------------------------


class StageNotes:
    """What stages have done, by the digest of their input: a note a stage, beside the validation report."""

    def __init__(self, spark: SparkSession, zones: Zones, cleaning: Cleaning, input_key: str | None):
        self._spark, self._zones = spark, zones
        self._input = input_key or files_state(spark, [zones.raw]).digest
        self._cleaning = repr(cleaning)

    def _stage(self, name: str) -> tuple[str, list[str]] | None:
        """Path of a stage's note, and what it writes; None for stages that are always run."""
        tables = [f"{self._zones.transformed}/{t}" for t in STAR_TABLES]
        if name == "transform":
            of, out = f"{self._input}|{self._cleaning}", tables
        elif name == "validate":
            of, out = files_state(self._spark, tables).digest, [f"{self._zones.validated}/validation_report"]
        else:
            return None
        return f"{self._zones.validated}/stages/{name}-{hashlib.sha256(of.encode()).hexdigest()[:24]}.json", out

    def find(self, name: str) -> dict | None:
        """The note of a stage that need not run again."""
        if name == "validate" or name == "transform":
            try:
                path, out = self._stage(name)
                note = get_note(self._spark, path)
                return note if note and note["output"] == files_state(self._spark, out).digest else None
            except AnalysisException:  # what it wrote is gone
                return None
        return None

    def add(self, name: str, row_counts: dict[str, int] | None, failed_checks: int) -> None:
        stage = self._stage(name)
        if stage:
            path, out = stage
            note = {"row_counts": row_counts, "failed_checks": failed_checks, "output": files_state(self._spark, out).digest}
            put_note(self._spark, path, note)


def run_pipeline(
    spark: SparkSession,
    zones: Zones,
    raw: Mapping[str, DataFrame] | None = None,
    order_by: OrderBy | None = None,
    target: str = "catalog",
    mode: str = "full",
    gate_mode: str = "warn",
    env: str = "development",
    load_options: Mapping[str, Any] | None = None,
    cleaning: Cleaning = Cleaning(),
    resume: bool = False,
    input_key: str | None = None,
) -> RunResult:
    """Extract, transform, validate, load; every step is timed and noted in a manifest.

    With ``resume`` a transform or validation that was done before, by this or an earlier run, with
    the same input files and cleaning, is skipped if the files it wrote are still as it left
    them. Frames given as ``raw`` name their content by ``input_key``.

    The load step notes the rows that the warehouse then holds. After a full load they
    must be those of the transform, otherwise the run fails.

    ``gate_mode``: ``warn`` goes on after failed checks, ``fail`` stops, ``off``
    ignores them. An error is written to the manifest and raised again.
    """
    result = RunResult("RUNNING")
    began = time.perf_counter()
    if resume and raw is not None and input_key is None:
        raise ValueError("a resumed run over frames needs input_key")
    done = StageNotes(spark, zones, cleaning, input_key) if resume else None

    def step(name: str, action: Callable[[], dict[str, int] | None]) -> None:
        start = time.perf_counter()
        note: dict[str, Any] = {"status": "FAIL", "duration": 0.0, "row_counts": None}
        result.steps[name] = note
        try:
            known = done.find(name) if done else None
            if known and not (known["failed_checks"] and gate_mode == "fail"):
                note["row_counts"], result.failed_checks = known["row_counts"], known["failed_checks"]
                note["status"] = "SKIPPED"
                return
            note["row_counts"] = action()
            note["status"] = "PASS"
            if done:
                done.add(name, note["row_counts"], result.failed_checks)
        finally:
            note["duration"] = round(time.perf_counter() - start, 2)
            log.info("%s %s in %.2f s", name, note["status"], note["duration"])

    def extract() -> None:
        nonlocal raw
        if raw is None:
            raw = extract_all(spark, zones.raw)
            size_shuffles(spark, files_state(spark, [zones.raw]).size)

    def transform() -> dict[str, int]:
        return transform_to_zone(spark, raw, zones.transformed, order_by, cleaning=cleaning)

    def validate() -> None:
        result.failed_checks = stage_validate(spark, zones, gate_mode)

    def load() -> dict[str, int]:
        loaded = _counted(stage_load(spark, zones, target, mode, **(load_options or {})))
        expected = result.steps["transform"]["row_counts"]
        if mode == "full" and loaded != expected:
            raise ValueError(f"the warehouse holds {loaded} rows after a full load of {expected}")
        return loaded

    trace = None
    try:
        step("extract", extract)
        step("transform", transform)
        step("validate", validate)
        step("load", load)
        result.status = "SUCCESS"
    except Exception as e:
        result.status, result.error, trace = "FAILED", str(e), traceback.format_exc()
        raise
    finally:
        result.total_duration = round(time.perf_counter() - began, 2)
        if zones.manifests:
            write_manifest(spark, result, zones.manifests, mode, env, trace)
    return result


def write_manifest(
    spark: SparkSession, result: RunResult, path: str, mode: str, env: str, trace: str | None = None
) -> None:
    """Append the run to the manifest folder: one JSON object in a file of its own."""
    row = (
        result.status,
        mode,
        env,
        datetime.now(timezone.utc).isoformat(),
        result.steps,
        result.error,
        trace,
        result.total_duration,
    )
    spark.createDataFrame([row], MANIFEST_DDL).coalesce(1).write.mode("append").json(path)
