"""Every registered query against its DuckDB SQL on the smallest data set."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as spark_entry
from runlens.plans.oracle import ORACLE
from runlens.plans.queries import QUERIES
from tests.oracle_check import connect, differences

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
needs_data = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not there")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@needs_data
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    df = spark_entry.queries()[name](spark, SF_DIR)
    assert differences(df, duck, spark_entry.oracle_sql()[name]) is None


@needs_data
def test_entry(spark):
    assert spark_entry.entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


def test_all_are_registered():
    assert set(QUERIES) <= set(spark_entry.queries())
    assert set(ORACLE) <= set(spark_entry.oracle_sql())
