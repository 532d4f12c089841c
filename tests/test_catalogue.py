"""Registered queries against their DuckDB statements on the small test tables.

Plans over the star alone are covered by test_star_queries.
"""

import os

import pytest

import __spark_entry__ as entry
from compare import compare, oracle
from skeinmart.oracle import statements
from skeinmart.plans.catalogue import STAR_PLANS, registry

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables here")


def test_every_query_has_a_statement():
    assert registry() and set(registry()) == set(statements())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[:3] == ["year", "month", "month_name"] and df.count() > 0


@pytest.fixture(scope="module")
def duck():
    return oracle(SF_DIR)


@pytest.mark.parametrize("name", [n for n in registry() if n not in STAR_PLANS])
def test_query(spark, duck, name):
    assert compare(spark, duck, SF_DIR, name, registry()[name], statements()[name]) is None
