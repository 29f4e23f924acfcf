"""Every registered query against its reference SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from check import compare, connect
from quayside.plans import ORACLES, QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database():
    return connect(SMALL)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query(spark, database, key):
    assert compare(spark, database, SMALL, key) is None


def test_every_query_has_reference_sql():
    assert set(QUERIES) == set(ORACLES) <= set(entry.oracle_sql())


def test_entry(spark):
    rows = entry.entry(spark).orderBy("file_name").collect()
    assert rows[0].file_name == "orders_000.parquet"
    assert {r.rows for r in rows[:-1]} == {250} and 0 < rows[-1].rows <= 250
