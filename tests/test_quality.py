"""Checks, gates, reports and expectations."""

import json
import logging

import pytest

import helpers as H
from skeinmart.operators import quality as Q


def ids(spark, *values, name="id"):
    return spark.createDataFrame([(v,) for v in values], f"{name} bigint")


@pytest.mark.parametrize("values,row", [
    ((1, 2, 3), ("null_pk(id)", "t", True, "No nulls")),
    ((1, None, 3), ("null_pk(id)", "t", False, "1 nulls found")),
])
def test_null_pks(spark, values, row):
    assert H.rows(Q.check_null_pks(ids(spark, *values), "t", "id")) == [row]


@pytest.mark.parametrize("values,row", [
    ((1, 2, 3), ("duplicate_pk(id)", "t", True, "No duplicates")),
    ((1, 2, 2), ("duplicate_pk(id)", "t", False, "1 duplicates found")),
    ((1, None, None, None), ("duplicate_pk(id)", "t", False, "2 duplicates found")),
    ((None,), ("duplicate_pk(id)", "t", True, "No duplicates")),
])
def test_duplicate_pks(spark, values, row):
    assert H.rows(Q.check_duplicate_pks(ids(spark, *values), "t", "id")) == [row]


@pytest.mark.parametrize("fact,dim,details", [
    ((1, 2), (1, 2, 3), "All FKs valid"),
    ((1, 2, 99), (1, 2), "1 orphan keys"),
    ((99, 99, 98), (1,), "2 orphan keys"),
    ((1, None, None), (1,), "1 orphan keys"),
])
def test_referential_integrity(spark, fact, dim, details):
    got = Q.check_referential_integrity(ids(spark, *fact, name="fk"), ids(spark, *dim, name="fk"), "fk", "dim")
    assert H.rows(got) == [("ref_integrity(fk)", "fact_orders->dim", details == "All FKs valid", details)]


def test_row_count_and_revenue(spark):
    assert H.rows(Q.check_row_count(ids(spark, 1, 2), "t", 3)) == [("row_count", "t", False, "2 rows (min: 3)")]
    assert H.rows(Q.check_row_count(ids(spark), "t")) == [("row_count", "t", False, "0 rows (min: 1)")]
    money = spark.createDataFrame([(10.0,), (None,), (-1.0,)], "revenue double")
    assert H.rows(Q.check_revenue_positive(money)) == [("revenue_positive", "fact_orders", False, "1 negative values")]
    assert Q.check_revenue_positive(money.filter("revenue > 0")).first()["details"] == "All positive"


@pytest.fixture(scope="module")
def report(spark):
    rows = [("a", "t", True, "x"), ("b", "t", False, "y"), ("c", "u", True, "z")]
    return spark.createDataFrame(rows, "check string, table string, passed boolean, details string")


def test_gates(report, caplog):
    with caplog.at_level(logging.WARNING):
        assert Q.gate(report, "warn") == 1
    assert "t.b: y" in caplog.text
    assert Q.gate(report, "off") == 0
    with pytest.raises(Q.QualityError, match="1 checks failed"):
        Q.gate(report, "fail")
    assert Q.gate(report.filter("passed"), "fail") == 0
    with pytest.raises(ValueError):
        Q.gate(report, "maybe")


def test_score_and_tally(report):
    assert Q.quality_score(report).first()[0] == 66
    assert Q.quality_score(report.filter("false")).first()[0] == 0
    assert Q.quality_score(None) == 0
    assert tuple(Q.tally(report).first()) == (2, 1)


def test_statistics(report):
    assert H.rows(Q.statistics_by_table(report)) == [("t", 2, 1, 1, 50.0), ("u", 1, 1, 0, 100.0)]


def test_nested_report(report):
    nested = json.loads(Q.nested_report(report).first()["value"])
    assert nested["u"] == {
        "success": True,
        "statistics": {
            "evaluated_expectations": 1, "successful_expectations": 1, "unsuccessful_expectations": 0,
            "success_percent": 100.0,
        },
        "results": [{"check": "c", "success": True, "message": "z"}],
    }
    assert not nested["t"]["success"]


def test_suite_has_16_checks_in_few_passes(spark):
    from test_star import fixture_star

    star = fixture_star(spark)
    report = Q.validate_star(star)
    got = {(r["table"], r["check"]): r for r in report.collect()}
    assert len(got) == 16
    assert got["fact_orders->dim_products", "ref_integrity(product_id)"]["passed"]
    assert got["fact_orders", "row_count"]["details"] == "3 rows (min: 100)"


def test_expectations(spark):
    df = spark.createDataFrame([("a@b.c", 1), ("bad", 5), (None, 1)], "email string, n int")
    suite = [
        Q.Expectation("regex", "email", pattern=Q.EMAIL_PATTERN),
        Q.Expectation("not_null", "email"),
        Q.Expectation("unique", "n"),
        Q.Expectation("range", "n", low=2, high=4),
        Q.Expectation("set", "n", values=(1, 5)),
    ]
    got = [tuple(r)[2:] for r in Q.evaluate(df, "t", suite).collect()]
    assert got == [
        (False, "1 unexpected values"), (False, "1 unexpected values"), (False, "1 unexpected values"),
        (False, "3 unexpected values"), (True, ""),
    ]
    assert sum(len(s) for s in Q.STAR_EXPECTATIONS.values()) == 18


def test_schema_and_tolerance(spark):
    from test_star import fixture_star

    fact = fixture_star(spark)["fact_orders"]
    assert Q.check_schema(fact, "fact_orders").first()["passed"]
    wrong = Q.check_schema(fact.withColumn("quantity", fact["quantity"].cast("int")), "fact_orders").first()
    assert not wrong["passed"] and "quantity" in wrong["details"]
    assert Q.check_row_tolerance(spark.range(100), spark.range(95), "t").first()["passed"]
    assert not Q.check_row_tolerance(spark.range(100), spark.range(94), "t").first()["passed"]
