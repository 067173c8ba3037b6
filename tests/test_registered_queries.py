"""Every registered query against its SQL equivalent, exactly."""

import __spark_entry__ as driver
import pytest
from oracle_check import connect, difference
from wayfare.plans.oracle import ORACLE_SQL
from wayfare.plans.queries import QUERIES


@pytest.fixture(scope="module")
def db(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf_dir, db, name):
    result = driver.queries()[name](spark, sf_dir)
    assert difference(result, db, driver.oracle_sql()[name]) is None


def test_entry_is_the_daily_summary(spark):
    assert driver.entry(spark).columns[:2] == ["date", "total_trips"]
