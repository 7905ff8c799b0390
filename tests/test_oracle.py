"""Every query against its SQL text in DuckDB."""

import os

import pytest

import __spark_entry__
from workload.compare import connect, differences
from workload.oracle import all_sql
from workload.queries import all_queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(all_queries()) == set(all_sql())
    assert set(all_queries()) <= set(__spark_entry__.queries())


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query_agrees_with_sql(spark, duck, name):
    assert differences(spark, duck, SF_DIR, name) == []


def test_entry_has_rows(spark):
    assert __spark_entry__.entry(spark).limit(1).count() == 1
