"""Every registered query over whole tables; against SQL wherever SQL can say it."""

import pytest

import __spark_entry__ as driver
from tests.oracle import connect, differences


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(driver.oracle_sql()))
def test_matches_sql(spark, sf_dir, con, name):
    assert differences(driver.queries()[name](spark, sf_dir), driver.oracle_sql()[name], con) == []


def test_every_oracle_has_a_query():
    assert set(driver.oracle_sql()) <= set(driver.queries())
