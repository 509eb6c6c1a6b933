"""Every registered query against its SQL; those without SQL must give rows."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.parity import compare, connect


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_same_rows_as_sql(spark, sf_dir, con, name):
    assert compare(queries()[name](spark, sf_dir), con, oracle_sql()[name]) == []


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql())))
def test_gives_rows(spark, sf_dir, name):
    assert queries()[name](spark, sf_dir).count() > 0


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    df = entry(spark)
    assert df.columns[:3] == ["area", "year", "value_tonnes"] and df.count() > 0
