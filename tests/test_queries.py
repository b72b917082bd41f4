"""Every registered query against its SQL."""

import os

import check
import pytest

import __spark_entry__ as registry
from feed_queries import REGISTRY

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return check.connect(SMALL)


def test_every_query_has_sql():
    assert REGISTRY.keys() <= registry.queries().keys()
    assert REGISTRY.keys() <= registry.oracle_sql().keys() <= registry.queries().keys()


@pytest.mark.parametrize("name", REGISTRY)
def test_query_equals_sql(spark, con, name):
    good, note = check.compare(spark, con, SMALL, name)
    assert good, note


def test_entry(spark):
    frame = registry.entry(spark)
    assert len(frame.columns) == 31
    assert frame.count() == 1000


def test_given_tables_are_there():
    assert sorted(os.listdir(SMALL)) == sorted(f"{name}.parquet" for name in check.TABLES)
