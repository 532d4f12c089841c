"""Data-quality checks. Every check is a report row: check, table, passed, details."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import (
    CATEGORIES, DEFAULT_CATEGORY, FOREIGN_KEYS, MIN_ROWS, ORDER_STATUSES, PRIMARY_KEYS, STAR_SCHEMAS,
)

log = logging.getLogger(__name__)


# --- one aggregate per table, one report row per check ------------------------


def _row(check: str, table: str, passed: Column, details: Column) -> Column:
    return F.struct(
        F.lit(check).alias("check"), F.lit(table).alias("table"), passed.alias("passed"), details.alias("details")
    )


def _text(n: Column, suffix: str) -> Column:
    return F.concat(n.cast("string"), F.lit(suffix))


def _zero_check(check: str, table: str, n: Column, failure: str, success: str) -> Column:
    return _row(check, table, n == 0, F.when(n == 0, F.lit(success)).otherwise(_text(n, failure)))


def _null_row(table: str, pk: str) -> Column:
    return _zero_check(f"null_pk({pk})", table, F.col("nulls"), " nulls found", "No nulls")


def _duplicate_row(table: str, pk: str) -> Column:
    # Null keys count as one more key value.
    extra = F.col("n_rows") - F.col("n_keys") - F.when(F.col("nulls") > 0, 1).otherwise(0)
    return _zero_check(f"duplicate_pk({pk})", table, extra, " duplicates found", "No duplicates")


def _count_row(table: str, min_rows: int) -> Column:
    return _row(
        "row_count", table, F.col("n_rows") >= min_rows, _text(F.col("n_rows"), f" rows (min: {min_rows})")
    )


def _revenue_row() -> Column:
    return _zero_check("revenue_positive", "fact_orders", F.col("negative"), " negative values", "All positive")


def _aggregates(pk: str | None, distinct: bool = False, revenue: bool = False) -> list[Column]:
    out = [F.count("*").alias("n_rows")]
    if pk:
        out.append(F.count_if(F.col(pk).isNull()).alias("nulls"))
    if distinct:
        out.append(F.count_distinct(F.col(pk)).alias("n_keys"))
    if revenue:
        out.append(F.count_if(F.col("revenue") < 0).alias("negative"))
    return out


def _report(df: DataFrame, aggregates: list[Column], rows: list[Column]) -> DataFrame:
    return df.agg(*aggregates).select(F.inline(F.array(*rows)))


def check_null_pks(df: DataFrame, table: str, pk: str) -> DataFrame:
    return _report(df, _aggregates(pk), [_null_row(table, pk)])


def check_pct_limits(df: DataFrame, table: str, pk: str, max_null_pct: float = 0.0, max_duplicate_pct: float = 0.0) -> DataFrame:
    """Null keys, and rows beyond the first of each key, as shares of all rows against limits in percent. An empty table passes."""
    extra = F.col("n_rows") - F.col("n_keys") - F.when(F.col("nulls") > 0, 1).otherwise(0)

    def row(kind: str, n: Column, limit: float) -> Column:
        details = F.concat(n.cast("string"), F.lit(" of "), F.col("n_rows").cast("string"), F.lit(" rows"))
        return _row(f"{kind}_pct({pk}) <= {limit:g}", table, n * 100.0 <= F.lit(limit) * F.col("n_rows"), details)

    rows = [row("null", F.col("nulls"), max_null_pct), row("duplicate", extra, max_duplicate_pct)]
    return _report(df, _aggregates(pk, distinct=True), rows)


def check_duplicate_pks(df: DataFrame, table: str, pk: str) -> DataFrame:
    """Rows beyond the first of each key; null keys equal each other."""
    return _report(df, _aggregates(pk, distinct=True), [_duplicate_row(table, pk)])


def check_row_count(df: DataFrame, table: str, min_rows: int = 1) -> DataFrame:
    return _report(df, _aggregates(None), [_count_row(table, min_rows)])


def check_revenue_positive(fact: DataFrame) -> DataFrame:
    """A null revenue is not negative."""
    return _report(fact, _aggregates(None, revenue=True), [_revenue_row()])


def orphan_keys(fact: DataFrame, dim: DataFrame, fk: str) -> DataFrame:
    """Distinct fact keys without a dimension row. A null key is one orphan."""
    return fact.select(fk).distinct().join(dim.select(fk), fk, "left_anti")


def check_referential_integrity(fact: DataFrame, dim: DataFrame, fk: str, dim_table: str) -> DataFrame:
    row = _zero_check(
        f"ref_integrity({fk})", f"fact_orders->{dim_table}", F.col("n_rows"), " orphan keys", "All FKs valid"
    )
    return _report(orphan_keys(fact, dim, fk), _aggregates(None), [row])


def check_table(df: DataFrame, table: str, pk: str, min_rows: int) -> DataFrame:
    """All single-table checks of one star table in one pass."""
    is_fact = table == "fact_orders"
    rows = [_null_row(table, pk), _duplicate_row(table, pk), _count_row(table, min_rows)]
    if is_fact:
        rows.append(_revenue_row())
    return _report(df, _aggregates(pk, distinct=True, revenue=is_fact), rows)


def validate_star(star: Mapping[str, DataFrame]) -> DataFrame:
    """The suite of 16: null, duplicate and count checks per table, three foreign keys, revenue."""
    report = None
    for table, pk in PRIMARY_KEYS.items():
        part = check_table(star[table], table, pk, MIN_ROWS[table])
        report = part if report is None else report.unionByName(part)
    for fk, dim_table in FOREIGN_KEYS.items():
        report = report.unionByName(check_referential_integrity(star["fact_orders"], star[dim_table], fk, dim_table))
    return report


# --- what to do with a report -------------------------------------------------


class QualityError(ValueError):
    """Raised by the strict gate."""


def gate(report: DataFrame, mode: str = "warn") -> int:
    """Act on the failed checks: ``off`` ignores, ``warn`` logs, ``fail`` raises. Returns how many failed."""
    if mode not in ("off", "warn", "fail"):
        raise ValueError(f"unknown gate mode {mode!r}")
    if mode == "off":
        return 0
    failed = report.filter(~F.col("passed")).collect()  # at most one row per check
    for r in failed:
        log.warning("FAIL %s.%s: %s", r["table"], r["check"], r["details"])
    if failed and mode == "fail":
        raise QualityError(f"data validation failed: {len(failed)} checks failed")
    return len(failed)


def keys_are_unique(report: DataFrame) -> bool:
    """Whether the null and duplicate checks of all primary keys are in the report and passed."""
    wanted = [f"{kind}({pk})" for pk in PRIMARY_KEYS.values() for kind in ("null_pk", "duplicate_pk")]
    good = report.filter(F.col("check").isin(*wanted) & F.col("table").isin(*PRIMARY_KEYS) & F.col("passed"))
    return good.select("check", "table").distinct().count() == len(wanted)


def tally(report: DataFrame) -> DataFrame:
    """Checks passed and failed."""
    return report.agg(
        F.count_if(F.col("passed")).alias("passed"), F.count_if(~F.col("passed")).alias("failed")
    )


def quality_score(report: DataFrame | None) -> DataFrame | int:
    """Passed checks in percent, cut to a whole number; 0 for an empty or a missing report."""
    if report is None:
        return 0
    share = F.try_divide(F.count_if(F.col("passed")).cast("double"), F.count("*").cast("double")) * 100
    return report.agg(F.coalesce(F.floor(share), F.lit(0)).cast("int").alias("score"))


# --- expectations on columns ---------------------------------------------------


@dataclass(frozen=True)
class Expectation:
    """A named rule on one column. ``kind`` is not_null, unique, regex, range or set."""

    kind: str
    column: str
    pattern: str | None = None
    low: float | None = None
    high: float | None = None
    values: tuple | None = None

    @property
    def name(self) -> str:
        return f"{self.kind}_{self.column}"

    def unexpected(self) -> Column:
        """Aggregate: how many rows break the rule. Nulls only break not_null."""
        c = F.col(self.column)
        if self.kind == "not_null":
            return F.count_if(c.isNull())
        if self.kind == "unique":
            return F.count(c) - F.count_distinct(c)
        if self.kind == "regex":
            return F.count_if(~c.rlike(self.pattern))
        if self.kind == "set":
            return F.count_if(~c.isin(*self.values))
        if self.kind == "range":
            broken = F.lit(False)
            if self.low is not None:
                broken = broken | (c < self.low)
            if self.high is not None:
                broken = broken | (c > self.high)
            return F.count_if(broken)
        raise ValueError(f"unknown expectation kind {self.kind!r}")


EMAIL_PATTERN = r"^[^@\s]+@[^@\s]+\.[^@\s]+$"

STAR_EXPECTATIONS = {
    "dim_customers": [
        Expectation("not_null", "customer_id"),
        Expectation("unique", "customer_id"),
        Expectation("not_null", "email"),
        Expectation("regex", "email", pattern=EMAIL_PATTERN),
    ],
    "dim_products": [
        Expectation("not_null", "product_id"),
        Expectation("unique", "product_id"),
        Expectation("range", "price", low=0),
        Expectation("set", "category", values=(*CATEGORIES, DEFAULT_CATEGORY)),
    ],
    "dim_date": [
        Expectation("not_null", "date_id"),
        Expectation("unique", "date_id"),
        Expectation("range", "month", low=1, high=12),
        Expectation("range", "quarter", low=1, high=4),
    ],
    "fact_orders": [
        Expectation("not_null", "order_id"),
        Expectation("unique", "order_id"),
        Expectation("range", "revenue", low=0),
        Expectation("not_null", "customer_id"),
        Expectation("not_null", "product_id"),
        Expectation("set", "order_status", values=tuple(ORDER_STATUSES)),
    ],
}


def evaluate(df: DataFrame, table: str, expectations: Sequence[Expectation]) -> DataFrame:
    """All expectations of a table in one pass."""
    rows = [
        _zero_check(e.name, table, F.col(f"e{i}"), " unexpected values", "")
        for i, e in enumerate(expectations)
    ]
    return _report(df, [e.unexpected().alias(f"e{i}") for i, e in enumerate(expectations)], rows)


def evaluate_star(star: Mapping[str, DataFrame], suites: Mapping[str, Sequence[Expectation]] = STAR_EXPECTATIONS):
    out = None
    for table, expectations in suites.items():
        part = evaluate(star[table], table, expectations)
        out = part if out is None else out.unionByName(part)
    return out


def statistics_by_table(report: DataFrame) -> DataFrame:
    """Checks evaluated, passed and failed per table, and the share passed."""
    good = F.count_if(F.col("passed"))
    return report.groupBy("table").agg(
        F.count("*").alias("evaluated_expectations"),
        good.alias("successful_expectations"),
        (F.count("*") - good).alias("unsuccessful_expectations"),
        (F.lit(100.0) * good.cast("double") / F.count("*").cast("double")).alias("success_percent"),
    )


def nested_report(report: DataFrame) -> DataFrame:
    """The report as one JSON object ``table -> {success, statistics, results}``, in column ``value``.

    A report has one row per check, so the object is small whatever the data size.
    """
    result = F.struct(
        F.col("check"), F.col("passed").alias("success"), F.col("details").alias("message")
    )
    per_table = report.groupBy("table").agg(
        F.array_sort(F.collect_list(result)).alias("results"),
        F.count("*").alias("n"),
        F.count_if(F.col("passed")).alias("good"),
    )
    entry = F.struct(
        (F.col("n") == F.col("good")).alias("success"),
        F.struct(
            F.col("n").alias("evaluated_expectations"),
            F.col("good").alias("successful_expectations"),
            (F.col("n") - F.col("good")).alias("unsuccessful_expectations"),
            (F.lit(100.0) * F.col("good") / F.col("n")).alias("success_percent"),
        ).alias("statistics"),
        F.col("results"),
    )
    pairs = per_table.select(F.struct(F.col("table"), entry.alias("entry")).alias("pair"))
    return pairs.agg(F.to_json(F.map_from_entries(F.collect_list("pair"))).alias("value"))


# --- schema and row-count tolerance --------------------------------------------


def check_schema(df: DataFrame, table: str, expected: T.StructType | None = None) -> DataFrame:
    """Column names, order and types against the contract. Looks at the schema only."""
    expected = expected or STAR_SCHEMAS[table]
    have = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    want = [(f.name, f.dataType.simpleString()) for f in expected.fields]
    wrong = sorted({n for n, t in have if (n, t) not in want} | {n for n, t in want if (n, t) not in have})
    ok = have == want
    details = "Types as declared" if ok else f"differing columns: {', '.join(wrong) or 'order'}"
    return df.sparkSession.createDataFrame(
        [("schema", table, ok, details)], "check string, table string, passed boolean, details string"
    )


def check_row_tolerance(source: DataFrame, target: DataFrame, table: str, tolerance: float = 0.05) -> DataFrame:
    """|source - target| rows within a share of the source rows."""
    counts = target.agg(F.count("*").alias("t")).withColumn("s", source.agg(F.count("*").alias("s")).scalar())
    ok = F.abs(F.col("s") - F.col("t")) <= F.lit(tolerance) * F.col("s")
    details = F.concat_ws(" ", F.col("s").cast("string"), F.lit("source rows,"), F.col("t").cast("string"), F.lit("target rows"))
    return counts.select(F.inline(F.array(_row("row_tolerance", table, ok, details))))
