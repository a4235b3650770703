"""Registered queries against their SQL on the smallest data."""

import comparing
import pytest

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return comparing.connect(SF_DIR)


@pytest.mark.parametrize("name", list(SQL))
def test_same_result(spark, duck, name):
    mine = entry.queries()[name](spark, SF_DIR).toPandas()
    assert comparing.differences(mine, duck.execute(SQL[name]).df()) == []


def test_entry_gives_rows(spark):
    assert entry.entry(spark).count() > 0


def test_every_sql_has_its_query():
    assert set(SQL) <= set(entry.queries())
