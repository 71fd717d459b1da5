"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as driver
import oracle
from spendlake.queries import registry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return oracle.connect(SF)


@pytest.mark.parametrize("name", sorted(registry()))
def test_query(spark, db, name):
    rows, problems = oracle.compare(spark, db, SF, registry()[name])
    assert not problems


def test_entry(spark):
    assert driver.entry(spark).count() > 0
    assert set(registry()) <= set(driver.oracle_sql()) <= set(driver.queries())
