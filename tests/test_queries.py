"""Every registered query against its SQL on DuckDB."""

import pytest

import __spark_entry__ as entry_module
from tallybrook.plans.oracle import BATCH_ORACLE, STREAM_ORACLE
from tallybrook.plans.queries import BATCH_QUERIES
from tallybrook.plans.streams import STREAM_QUERIES
from tests.conftest import DATA
from tools.check import compare, connect


@pytest.fixture(scope="module")
def duck():
    return connect(DATA)


@pytest.mark.parametrize("name", sorted({**BATCH_QUERIES, **STREAM_QUERIES}))
def test_equals_sql(spark, duck, name):
    assert compare(spark, duck, name, DATA) == ""


def test_every_query_has_sql():
    assert {*BATCH_QUERIES, *STREAM_QUERIES} == {*BATCH_ORACLE, *STREAM_ORACLE}
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.columns == ["stat_time", "tm_id", "tm_name", "amount"]
    assert df.count() > 0
