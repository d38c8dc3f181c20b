"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as driver
from policy_mart.catalogue import ORACLES, QUERIES

from .compare import duck, duck_rows, spark_rows

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(driver.oracle_sql()))
def test_query_matches_sql(spark, con, name):
    result = spark_rows(driver.queries()[name](spark, SF_DIR))
    assert result == duck_rows(con, driver.oracle_sql()[name])


def test_every_query_of_the_mart_has_sql():
    assert set(QUERIES) == set(ORACLES) and set(QUERIES) <= set(driver.queries())


def test_every_query_has_rows_somewhere(spark):
    columns, rows = spark_rows(driver.entry(spark))
    assert rows and "persona_key" in columns
