"""Every registered query against its SQL, and the contract of the entry file."""

import pytest

import __spark_entry__ as entry
import oracle_sql
from compare import differences, oracle_connection
from tidemark import workload

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    with oracle_connection(SF) as connection:
        yield connection


def test_every_query_has_sql():
    assert set(workload.queries()) == set(oracle_sql.oracle_sql())
    assert set(workload.queries()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(workload.queries()))
def test_query_agrees_with_sql(spark, oracle, name):
    assert differences(spark, oracle, SF, name) is None


def test_entry_returns_rows(spark):
    assert entry.entry(spark).count() == 1_500
